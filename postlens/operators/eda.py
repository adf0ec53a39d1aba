"""Exploratory aggregations: distributions, crosstabs, top tags and words,
per-class feature means, summary statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.operators.ranking import exact_medians
from postlens.sources import written


def class_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    c = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    # the window runs over the per-class table (one row per class)
    return c.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def category_distribution(df: DataFrame, cat_col: str) -> DataFrame:
    return df.groupBy(cat_col).agg(F.count(F.lit(1)).alias("n"))


def positives_by_category(df: DataFrame, cat_col: str, label_col: str = "label") -> DataFrame:
    return df.groupBy(cat_col).agg(F.sum(label_col).cast("long").alias("n_pos"))


def distinct_count(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    f = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    return df.agg(f.alias("n_distinct"))


def symbol_histogram(counts: DataFrame, col: str) -> DataFrame:
    return counts.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def crosstab_percent(df: DataFrame, a: str, label_col: str = "label", labels=(0, 1)) -> DataFrame:
    """Row percentages of crosstab(a, label); raw counts dropped."""
    p = df.groupBy(a).pivot(label_col, list(labels)).agg(F.count(F.lit(1))).fillna(0)
    tot = sum(F.col(str(v)) for v in labels)
    return p.select(a, *[(F.col(str(v)) * 100.0 / tot).alias(f"pct_{v}") for v in labels])


def top_n(df: DataFrame, key: str, n: int = 10, count_col: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col)).orderBy(F.desc(count_col), F.asc(key)).limit(n)


def top_tags(df: DataFrame, tags_col: str, n: int = 10) -> DataFrame:
    """Flatten tag arrays, count, top n (distributed top-k)."""
    return top_n(df.select(F.explode(tags_col).alias("tag")), "tag", n)


def top_per_group(counts: DataFrame, group_col: str, key: str, count_col: str, n: int) -> DataFrame:
    """Top n keys per group; the ``rank <= n`` filter is turned into a
    per-partition group limit before the shuffle (bounded per task)."""
    w = Window.partitionBy(group_col).orderBy(F.desc(count_col), F.asc(key))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def top_tags_by_category(df: DataFrame, tags_col: str, cat_col: str, n: int = 10) -> DataFrame:
    c = (df.select(cat_col, F.explode(tags_col).alias("tag"))
         .groupBy(cat_col, "tag").agg(F.count(F.lit(1)).alias("n")))
    return top_per_group(c, cat_col, "tag", "n", n)


def top_words_by_class(df: DataFrame, tokens_col: str, class_col: str, n: int = 20) -> DataFrame:
    c = (df.select(class_col, F.explode(tokens_col).alias("word"))
         .groupBy(class_col, "word").agg(F.count(F.lit(1)).alias("n")))
    return top_per_group(c, class_col, "word", "n", n)


def class_feature_means(df: DataFrame, array_col: str, label_col: str = "label", first: int | None = None) -> DataFrame:
    e = df.select(label_col, F.posexplode(array_col).alias("pos", "v"))
    if first is not None:
        e = e.filter(F.col("pos") < first)
    return e.groupBy(label_col, "pos").agg(F.avg("v").alias("mean"))


def vector_stats(df: DataFrame, col: str, by=()) -> DataFrame:
    """Summary of a score column, one row per group; the median is exact, found by
    buckets."""
    x = F.col("_x")
    values = written(df.select(*by, F.col(col).cast("double").alias("_x")))
    aggs = [F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
            F.sum(F.abs(x)).alias("l1"), F.sqrt(F.sum(x * x)).alias("l2")]
    return exact_medians(values, "_x", by, aggs).select(*by, "mean", "std", "median", "min", "max", "l1", "l2")


def experiment_summary(results: DataFrame, by: str = "algorithm") -> DataFrame:
    return results.groupBy(by).agg(F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std"),
                                   F.avg("seconds").alias("seconds_mean"), F.stddev_pop("seconds").alias("seconds_std"))


def cv_summary(fold_scores: DataFrame, by=("model",), score_col: str = "score") -> DataFrame:
    s = F.col(score_col)
    return fold_scores.groupBy(*by).agg(F.avg(s).alias("mean"), F.stddev_pop(s).alias("std")).withColumn(
        "lo", F.col("mean") - 2 * F.col("std")).withColumn("hi", F.col("mean") + 2 * F.col("std"))
