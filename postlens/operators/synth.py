"""Synthetic minority rows, truncated SVD of long-form text features, batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.hashing import md5_bucket, md5_uniform
from postlens.operators.models.knn import nearest_neighbors
from postlens.operators.split import random_oversample


def smote(df: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic rows ``id, copy, neighbor, u, x, label`` that make all classes as
    large as the largest: x + u (neighbour - x), with one of the k nearest rows of
    the same class and u uniform, both from hashes of (id, copy); only rows with a copy
    look for neighbours.  Input: (id, x
    array<double>, label).  Rows without a neighbour in their class give none."""
    need = random_oversample(df.select("id", "label"), seed=seed).filter("copy > 0")
    key = F.concat(F.col("id").cast("string"), F.lit("/"), F.col("copy").cast("string"))
    need = need.select("id", "copy", "label", md5_bucket(key, seed, 1 << 16).alias("pick"), md5_uniform(key, seed + 1).alias("u")).persist()
    asked = need.select("id").distinct()
    near = None
    for r in need.select("label").distinct().collect():  # one row per class
        own = df.filter(F.col("label") == r["label"])
        one = nearest_neighbors(own, own.join(asked, "id", "left_semi"), k=k + 1).filter("qid <> nid").select("qid", "nid", "distance")
        near = one if near is None else near.unionByName(one)
    if near is None:
        return df.select("id", F.lit(0).alias("copy"), F.col("id").alias("neighbor"), F.lit(0.0).alias("u"), "x", "label").limit(0)
    ranked = near.groupBy("qid").agg(F.slice(F.sort_array(F.collect_list(F.struct("distance", "nid"))), 1, k).alias("near"))
    x = need.join(ranked, F.col("id") == F.col("qid"))
    x = x.withColumn("neighbor", F.element_at("near", (F.col("pick") % F.size("near") + 1).cast("int"))["nid"]).select("id", "copy", "label", "u", "neighbor")
    x = x.join(df.select("id", F.col("x").alias("x0")), "id").join(df.select(F.col("id").alias("neighbor"), F.col("x").alias("x1")), "neighbor")
    return x.select("id", "copy", "neighbor", "u", F.zip_with("x0", "x1", lambda a, b: a + F.col("u") * (b - a)).alias("x"), "label")


def truncated_svd(vectors: DataFrame, k: int, col: str = "features") -> tuple[list[list[float]], list[float]]:
    """``(V, singular values)`` of the uncentred rows; V has one row per feature and
    is model-sized.  The largest part is a distributed Gram product."""
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils

    # read again at every step: cached in the JVM, where no step turns Python's objects into rows
    rows = MLUtils.convertVectorColumnsFromML(vectors.select(col), col).persist()
    svd = RowMatrix(rows).computeSVD(k)
    rows.unpersist()
    return svd.V.toArray().tolist(), svd.s.toArray().tolist()


def project(values: DataFrame, v: list[list[float]], ids: DataFrame) -> DataFrame:
    """``id, pcs`` of long-form rows ``(id, idx, value)`` on the columns of ``v``;
    every row of ``ids`` comes out, zeros if it has no value."""
    k = len(v[0])
    base = ids.sparkSession.createDataFrame([(i, row) for i, row in enumerate(v)], "idx int, v array<double>")
    x = values.join(base, "idx").groupBy("id").agg(*[F.sum(F.col("value") * F.col("v")[j]).alias(f"c{j}") for j in range(k)])
    return ids.join(x, "id", "left").select("id", F.array(*[F.coalesce(f"c{j}", F.lit(0.0)) for j in range(k)]).alias("pcs"))


def score_batch(df: DataFrame, scorer: Callable, text_col: str = "post", id_col: str = "id") -> DataFrame:
    """``id, prob``: ``scorer`` gets the texts of an Arrow batch (null: empty) and
    returns their probabilities; it travels with the task once, rows stay in place."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({id_col: b[id_col], "prob": scorer(b[text_col].fillna("").tolist())})

    return df.select(id_col, text_col).mapInPandas(run, f"`{id_col}` {kind}, prob double")
