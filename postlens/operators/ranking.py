"""Distributed ranks and prefix sums.

A plain ``Window.partitionBy(label).orderBy(..)`` puts a whole class --
possibly a third of all rows -- into one task.  These helpers split the
ordering into buckets first (md5 prefixes, or score quantiles), count per
bucket (a small table), turn the counts into offsets with a window over
the *small* table, and finish with a window per (group, bucket), whose
size is bounded by rows / buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.session import default_buckets
from postlens.sources import written


def rank_by_hash(df: DataFrame, group_cols: list[str], hash_col: str, id_col: str,
                 hex_chars: int = 4, out: str = "rank0", total: str | None = "group_n") -> DataFrame:
    """0-based rank of each row within ``group_cols`` ordered by
    ``(hash_col, id_col)``; ``hash_col`` is an md5 hex string, so its
    first ``hex_chars`` characters are contiguous, uniform buckets."""
    b = "_hb"
    x = df.withColumn(b, F.substring(F.col(hash_col), 1, hex_chars))
    cnt = x.groupBy(*group_cols, b).agg(F.count(F.lit(1)).alias("_bn"))
    w = Window.partitionBy(*group_cols).orderBy(b)
    off = cnt.select(*group_cols, b,
                     F.coalesce(F.sum("_bn").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
                     F.sum("_bn").over(Window.partitionBy(*group_cols)).alias("_gn"))
    y = x.join(off, group_cols + [b])
    wr = Window.partitionBy(*group_cols, b).orderBy(hash_col, id_col)
    y = y.withColumn(out, (F.col("_off") + F.row_number().over(wr) - 1).cast("long"))
    if total:
        y = y.withColumnRenamed("_gn", total)
    else:
        y = y.drop("_gn")
    return y.drop(b, "_off")


def global_rank(df: DataFrame, order: list[Column], out: str = "rank0") -> DataFrame:
    """0-based rank of every row by ``order``, which must tell all rows apart.

    Rows are range-partitioned and sorted; a row's partition and place in it are
    stamped on it and written, and the sizes of the partitions before its own are
    added.  Range bounds come from a sample, so the stamps are read back, never
    computed twice.  A task holds one range."""
    bits = 33  # of monotonically_increasing_id: the place inside the partition
    x = (df.repartitionByRange(default_buckets(df.sparkSession), *order).sortWithinPartitions(*order)
         .withColumn("_at", F.monotonically_increasing_id()))
    x = written(x).withColumn("_part", F.shiftright("_at", bits))
    sizes = x.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row a range
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    x = x.join(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_off")), "_part")
    return x.withColumn(out, F.col("_off") + F.col("_at").bitwiseAND(F.lit((1 << bits) - 1))).drop("_part", "_off", "_at")


def exact_medians(df: DataFrame, col: str, by=(), aggs=(), buckets: int = 4096, small: int = 1 << 16) -> DataFrame:
    """``*by, *aggs, median``, one row per group, as ``F.median`` has it (nulls do not
    count, NaN is the largest), without a group in one task.

    The two middle ranks are sought in equal-width buckets between the group's least
    and largest value; the bucket that holds a rank becomes the next range, until it
    has ``small`` rows or one value.  Only what is left is sorted.  A range shrinks
    ``buckets`` times a round, so one or two rounds do for scores; the driver reads one
    flag a round.  ``df`` is read every round: hand in a written table."""
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    value = F.col(col).cast("double")
    finite = F.when(F.abs(value) < float("inf"), value)
    groups = written(df.groupBy(*by).agg(*aggs, F.count(value).alias("_n"), F.min(finite).alias("_lo"), F.max(finite).alias("_hi")).withColumn("_g", key))
    v = df.select(key.alias("_g"), value.alias("_v")).filter("_v IS NOT NULL")

    # one row per group and middle rank; ``rank`` counts inside the range, whole: all values
    state = groups.filter("_n > 0").select("_g", F.explode(F.array(F.lit(0), F.lit(1))).alias("_half"), F.coalesce("_lo", F.lit(0.0)).alias("lo"), F.coalesce("_hi", F.lit(0.0)).alias("hi"),
                                           "_n", F.lit(True).alias("whole")).select("_g", "_half", "lo", "hi", F.col("_n").alias("size"), F.floor((F.col("_n") - 1 + F.col("_half")) / 2).alias("rank"), "whole")
    open_ = (F.col("size") > small) & (F.col("whole") | (F.col("lo") < F.col("hi")))
    inside = F.col("whole") | F.col("_v").between(F.col("lo"), F.col("hi"))
    half = F.when((F.abs("lo") > 1e300) | (F.abs("hi") > 1e300), 0.5).otherwise(1.0)  # hi - lo must not overflow
    place = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("_v") * half - F.col("lo") * half) / (F.col("hi") * half - F.col("lo") * half) * buckets)).otherwise(0)
    bucket = (F.when(F.isnan("_v"), buckets + 1).when(F.col("_v") < F.col("lo"), -1).when(F.col("_v") > F.col("hi"), buckets)
              .otherwise(F.least(place, F.lit(buckets - 1))))
    while True:
        state = written(state)
        if state.filter(open_).isEmpty():
            break
        counts = (v.join(state.filter(open_), "_g").filter(inside).groupBy("_g", "_half", "rank", bucket.cast("int").alias("_b"))
                  .agg(F.count(F.lit(1)).alias("size"), F.min("_v").alias("lo"), F.max("_v").alias("hi")))
        to = F.sum("size").over(Window.partitionBy("_g", "_half").orderBy("_b"))  # at most buckets + 3 rows a group
        narrower = (counts.withColumn("_to", to).filter((F.col("rank") < F.col("_to")) & (F.col("rank") >= F.col("_to") - F.col("size")))
                    .select("_g", "_half", "lo", "hi", "size", (F.col("rank") - F.col("_to") + F.col("size")).alias("rank"), F.lit(False).alias("whole")))
        state = state.filter(~open_).unionByName(narrower)
    rest = v.join(state.filter(F.col("whole") | (F.col("lo") < F.col("hi"))), "_g").filter(inside)
    rest = rest.withColumn("_r", F.row_number().over(Window.partitionBy("_g", "_half").orderBy("_v")) - 1).filter("_r = rank").select("_g", "_v")
    found = rest.unionByName(state.filter(~F.col("whole") & ~(F.col("lo") < F.col("hi"))).select("_g", F.col("lo").alias("_v")))
    a, b = F.min("_v"), F.max("_v")
    middle = found.groupBy("_g").agg(F.when(a == b, a).otherwise(a + (b - a) * 0.5).alias("median"))
    return groups.join(middle, "_g", "left").drop("_g", "_n", "_lo", "_hi")


def score_buckets(df: DataFrame, score_col: str, n_buckets: int | None = None, rel_err: float | None = None):
    """Quantile split points of a score column (one distributed pass;
    the driver keeps ``n_buckets`` doubles)."""
    spark = df.sparkSession
    n = n_buckets or default_buckets(spark)
    probs = [i / n for i in range(1, n)]
    qs = df.approxQuantile(score_col, probs, rel_err if rel_err is not None else 1.0 / (4 * n))
    return sorted(set(q for q in qs if q is not None))


def bucket_expr(score_col: str, splits: list[float]):
    """Bucket index = number of split points strictly below the score."""
    if not splits:
        return F.lit(0)
    return sum((F.col(score_col) > F.lit(float(s))).cast("int") for s in splits) if len(splits) <= 64 else \
        F.expr(f"size(filter(array({','.join(repr(float(s)) for s in splits)}), s -> s < `{score_col}`))")


def auc_by_group(scored: DataFrame, group_cols: list[str], score_col: str = "prob", label_col: str = "label",
                 n_buckets: int | None = None, unit_interval: bool = True) -> DataFrame:
    """Rank-statistic AUC (ties count 1/2) per group, without a window
    over all rows of a group.  Scores known to lie in [0, 1] use
    fixed-width buckets; others get quantile split points (one extra
    pass)."""
    agg = (scored.groupBy(*group_cols, score_col)
           .agg(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).cast("double").alias("_pos"),
                F.sum(F.when(F.col(label_col) == 1, 0).otherwise(1)).cast("double").alias("_neg")))
    if unit_interval:
        nb = n_buckets or default_buckets(scored.sparkSession)
        bexpr = F.least(F.greatest(F.floor(F.col(score_col) * nb), F.lit(0)), F.lit(nb - 1))
    else:
        bexpr = bucket_expr(score_col, score_buckets(scored.select(score_col), score_col, n_buckets))
    agg = agg.withColumn("_b", bexpr)
    bt = agg.groupBy(*group_cols, "_b").agg(F.sum("_neg").alias("_bneg"))
    wb = Window.partitionBy(*group_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.withColumn("_boff", F.coalesce(F.sum("_bneg").over(wb), F.lit(0.0))).drop("_bneg")
    x = agg.join(bt, group_cols + ["_b"])
    wi = Window.partitionBy(*group_cols, "_b").orderBy(score_col).rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_below", F.col("_boff") + F.coalesce(F.sum("_neg").over(wi), F.lit(0.0)))
    res = x.groupBy(*group_cols).agg(
        F.sum(F.col("_pos") * (F.col("_below") + 0.5 * F.col("_neg"))).alias("_u"),
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    return res.select(*group_cols, F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                                          F.col("_u") / (F.col("_p") * F.col("_n"))).alias("auc"))
