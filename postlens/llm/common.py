"""Shared helpers: table access, reliable materialisation, row keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share: ``spark.checkpoint.dir``.  Only a local session
    that names none (tests) takes a scratch folder; on a cluster it must be named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        named = tempfile.mkdtemp(prefix="postlens-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: the lineage
    ends there, and a lost executor costs no more than a re-read."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id, _th, text)``: rows of one id with one text share a key (they get
    the same result); rows of one id, or of none, with other texts do not."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text)).alias("_id"),
                       F.hash(text).alias("_th"), text.alias("text"))


def bounded_sample(df: DataFrame, key: Column, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows, twice that at most, by a hash of ``key``: the same
    rows in every run, from the whole table."""
    n = df.count()
    if n > max_rows:
        df = df.filter(F.pmod(F.xxhash64(key), F.lit(1 << 32)) < F.lit(int(max_rows / n * (1 << 32))))
    return df.limit(2 * max_rows)


def crc32_sql(text: str) -> str:
    """DuckDB expression: the unsigned CRC-32 of a string's UTF-8 bytes."""
    row = "list_reduce(list_prepend(i::BIGINT, [0::BIGINT for z in range(8)]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    codes = f"list_transform(range(256), lambda i: {row})"
    of = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"(SELECT xor(list_reduce(list_prepend(4294967295::BIGINT, {of}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) FROM (SELECT {codes} AS t))"
