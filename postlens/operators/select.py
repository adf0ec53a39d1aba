"""Univariate feature selection as plain aggregations over long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _best(scores: DataFrame, key: str, score: str, k: int) -> DataFrame:
    """The k highest scores (ties: smaller key) with their rank; the window sees k rows."""
    top = scores.orderBy(F.desc(score), F.asc(key)).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), F.asc(key))))


def anova_f(long_df: DataFrame, key: str = "pos", value: str = "value", label: str = "label") -> DataFrame:
    """One-way ANOVA F per feature from counts, sums and sums of squares per
    (feature, class): one shuffle of one row per feature and class.  A feature
    without variance inside the classes has no score (null)."""
    x = F.col(value).cast("double")
    g = long_df.groupBy(key, label).agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q"))
    t = g.groupBy(key).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum("s").alias("s"), F.sum("q").alias("q"),
                           F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"))
    between = (F.col("b") - F.col("s") * F.col("s") / F.col("n")) / (F.col("k") - 1)
    within = (F.col("q") - F.col("b")) / (F.col("n") - F.col("k"))
    return t.filter("k > 1 and n > k").select(key, F.when(within > 0, between / within).alias("f"))


def select_k_best_f(long_df: DataFrame, k: int, key: str = "pos", value: str = "value", label: str = "label") -> DataFrame:
    return _best(anova_f(long_df, key, value, label).filter("f is not null"), key, "f", k)


def chi2(long_df: DataFrame, classes: DataFrame, key: str = "term", value: str = "tf", label: str = "label") -> DataFrame:
    """Chi-square of each feature's mass per class against the class priors;
    ``classes`` is ``(label, prior)``, one row per class.  Classes in which the
    feature does not occur count with mass 0: their share is what the others lack."""
    seen = long_df.groupBy(key, label).agg(F.sum(value).cast("double").alias("o"))
    total = Window.partitionBy(key)
    g = seen.join(classes, label).withColumn("e", F.sum("o").over(total) * F.col("prior"))
    # (0 - e)^2 / e of the absent classes sums to total - sum of the present e
    own = g.groupBy(key).agg(F.sum((F.col("o") - F.col("e")) * (F.col("o") - F.col("e")) / F.col("e")).alias("c"),
                             F.sum("o").alias("t"), F.sum("e").alias("se"))
    return own.select(key, (F.col("c") + F.col("t") - F.col("se")).alias("chi2"))


def select_k_best_chi2(long_df: DataFrame, classes: DataFrame, k: int, key: str = "term", value: str = "tf", label: str = "label") -> DataFrame:
    return _best(chi2(long_df, classes, key, value, label), key, "chi2", k)
