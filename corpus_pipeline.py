"""A corpus from documents to a training mix, in five stages.

Every stage works on all rows its predecessor kept.  Its result is written to the
shared folder and read again, so a lost executor costs one stage's work at most.
All stages but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlens.llm.common import keep, table
from postlens.llm.decontaminate import drop_contaminated
from postlens.llm.lines import dedup_lines
from postlens.llm.mixing import mix
from postlens.llm.quality import keep_good
from postlens.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out of the texts."""
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mix(docs)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("SimHash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("mixing sources", mixture)]

#: The classifier cannot be put into SQL; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
