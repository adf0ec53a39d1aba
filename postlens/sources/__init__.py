"""Scans and sinks: posts, feature matrices, metric JSON, training logs,
prediction CSVs (fitted models: ``models``).  Schemas are declared, never inferred
from data at scale."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POST_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("label", T.StringType()),  # raw: may hold stray header rows
    T.StructField("post", T.StringType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("post"), "lang", "source")
    return docs


def train_posts(spark: SparkSession, sf_dir: str, label_col: str = "toxic") -> DataFrame:
    """Labelled posts ``(id, label, post)``: documents JOIN labels."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("post"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col(label_col).alias("label"))
    return docs.join(labels, "id").select("id", "label", "post")


def test_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled posts ``(id, post)``: documents LEFT ANTI labels."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("post"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return docs.join(labels, "id", "left_anti")


def load_posts(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = POST_SCHEMA) -> DataFrame:
    """Read a post file with a declared schema (CSV with header or Parquet)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return reader.format(fmt).load(path)


def load_feature_matrix(df: DataFrame, id_col: str = "id", label_col: str | None = "label",
                        feature_cols: list[str] | None = None, array_col: str | None = None) -> DataFrame:
    """Wide numeric columns (or one array column) -> ``features`` vector.

    NaN / null become 0.0 first (``impute_zero``); id and label are split
    off and never used as features."""
    keep = [id_col] + ([label_col] if label_col else [])
    if array_col is not None:
        arr = F.transform(F.col(array_col), lambda x: F.coalesce(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0)))
    else:
        cols = feature_cols or [c for c in df.columns if c not in keep]
        arr = F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in cols])
    return df.select(*keep, array_to_vector(arr).alias("features"))


def attach_labels(features: DataFrame, labels: DataFrame, id_col: str = "id") -> DataFrame:
    """Row identity is the id, never the position: inner equi-join."""
    return features.join(labels, id_col)


def check_row_alignment(left: DataFrame, right: DataFrame, id_col: str = "id") -> DataFrame:
    """Counts of ids only left, only right, both (full outer join)."""
    l_ = left.select(F.col(id_col).alias("_id")).distinct().withColumn("_l", F.lit(1))
    r_ = right.select(F.col(id_col).alias("_id")).distinct().withColumn("_r", F.lit(1))
    j = l_.join(r_, "_id", "full_outer")
    return j.agg(
        F.sum(F.when(F.col("_r").isNull(), 1).otherwise(0)).cast("long").alias("only_left"),
        F.sum(F.when(F.col("_l").isNull(), 1).otherwise(0)).cast("long").alias("only_right"),
        F.sum(F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), 1).otherwise(0)).cast("long").alias("matched"),
    )


def assert_aligned(left: DataFrame, right: DataFrame, id_col: str = "id") -> None:
    row = check_row_alignment(left, right, id_col).first()
    if row["only_left"] or row["only_right"]:
        raise ValueError(f"row alignment failed: {row.asDict()}")


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """Many metric records with differing fields -> one merged table."""
    return spark.read.option("multiLine", True).json(path)


def read_training_log(spark: SparkSession, path: str, fmt: str = "tsv") -> DataFrame:
    """TSV ``iter<TAB>metric..`` or JSON with an ``iterations`` array."""
    if fmt == "tsv":
        return spark.read.option("header", True).option("sep", "\t").option("inferSchema", True).csv(path)
    raw = spark.read.option("multiLine", True).json(path)
    return raw.select(F.explode("iterations").alias("it")).select("it.*")


def write_predictions(pred: DataFrame, path: str, id_col: str = "id", label_col: str = "prediction",
                      out_id: str = "id", out_label: str = "label", sort: bool = True) -> None:
    """``(id,label)`` CSV with header; sorted by id via a range shuffle."""
    out = pred.select(F.col(id_col).alias(out_id), F.col(label_col).cast("int").alias(out_label))
    if sort:
        out = out.orderBy(out_id)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_report(report: DataFrame, path: str, fmt: str = "json") -> None:
    report.write.mode("overwrite").format(fmt).option("header", True).save(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share (``spark.checkpoint.dir``).  Only a local
    session that names none takes a scratch one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="postlens-")
        spark.sparkContext.setCheckpointDir(shared)
    return shared


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, read back: its lineage ends there and
    survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
