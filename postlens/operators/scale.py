"""Scaling fitted on training rows.  The fitted state is one mean / std
(or max-abs) per feature position -- model-sized, kept on the driver and
applied with ``zip_with`` in a single projection (no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_standard(train: DataFrame, col: str = "x"):
    """Per position mean and population std (std 0 -> 1)."""
    e = train.select(F.posexplode(col).alias("pos", "v"))
    rows = e.groupBy("pos").agg(F.avg("v").alias("mu"), F.stddev_pop("v").alias("sd")).orderBy("pos").collect()
    return [r["mu"] for r in rows], [r["sd"] if r["sd"] else 1.0 for r in rows]


def standard_scale(df: DataFrame, state, col: str = "x", out: str = "x") -> DataFrame:
    mu, sd = state
    params = F.arrays_zip(F.array(*[F.lit(float(m)) for m in mu]).alias("mu"), F.array(*[F.lit(float(s)) for s in sd]).alias("sd"))
    return df.withColumn(out, F.zip_with(F.col(col), params, lambda v, p: (v - p["mu"]) / p["sd"]))


def fit_maxabs(train: DataFrame, col: str = "x"):
    e = train.select(F.posexplode(col).alias("pos", "v"))
    rows = e.groupBy("pos").agg(F.max(F.abs("v")).alias("m")).orderBy("pos").collect()
    return [r["m"] if r["m"] else 1.0 for r in rows]


def maxabs_scale(df: DataFrame, state, col: str = "x", out: str = "x") -> DataFrame:
    m = F.array(*[F.lit(float(v)) for v in state])
    return df.withColumn(out, F.zip_with(F.col(col), m, lambda v, s: v / s))
