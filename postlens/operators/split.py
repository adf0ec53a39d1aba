"""Splits, folds, subsamples, bootstrap bags, resampling and weights.

All randomness is an md5 of ``id:seed`` (reproducible, engine-neutral,
safe under task retries).  Per-class quotas use ``rank_by_hash`` so that
no class ever sits in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.hashing import md5_bucket, md5_key, md5_uniform
from postlens.operators.ranking import rank_by_hash


def train_val_split(df: DataFrame, frac: float = 0.2, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Random split by hash threshold: ``split`` = 'val' or 'train'."""
    return df.withColumn("split", F.when(md5_uniform(id_col, seed) < frac, "val").otherwise("train"))


def stratified_split(df: DataFrame, frac: float = 0.2, seed: int = 42, id_col: str = "id",
                     label_col: str = "label") -> DataFrame:
    """Per class, the first floor(n_c * frac) rows in md5 order go to 'val'."""
    x = df.withColumn("_h", md5_key(id_col, seed))
    x = rank_by_hash(x, [label_col], "_h", id_col)
    quota = F.floor(F.col("group_n") * F.lit(float(frac)))
    return x.withColumn("split", F.when(F.col("rank0") < quota, "val").otherwise("train")).drop("_h", "rank0", "group_n")


def kfold(df: DataFrame, k: int = 5, seed: int = 42, id_col: str = "id") -> DataFrame:
    return df.withColumn("fold", md5_bucket(id_col, seed, k))


def stratified_kfold(df: DataFrame, k: int = 5, seed: int = 42, id_col: str = "id", label_col: str = "label") -> DataFrame:
    """(rank within class in md5 order) mod k: every fold holds each class
    in proportion."""
    x = df.withColumn("_h", md5_key(id_col, seed))
    x = rank_by_hash(x, [label_col], "_h", id_col, total=None)
    return x.withColumn("fold", (F.col("rank0") % k).cast("int")).drop("_h", "rank0")


def group_kfold(df: DataFrame, group_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """All rows of one group share a fold."""
    return df.withColumn("fold", md5_bucket(group_col, seed, k))


def stratified_subsample(df: DataFrame, n: int, seed: int = 42, id_col: str = "id", label_col: str = "label") -> DataFrame:
    """Class-proportional subset of about ``n`` rows: floor(n * n_c / N) per class."""
    x = df.withColumn("_h", md5_key(id_col, seed))
    x = rank_by_hash(x, [label_col], "_h", id_col)
    n_all = df.count()
    quota = F.floor(F.lit(float(n)) * F.col("group_n") / F.lit(float(max(n_all, 1))))
    return x.filter(F.col("rank0") < quota).drop("_h", "rank0", "group_n")


def random_subsample_n(df: DataFrame, n: int, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Exactly ``n`` rows without replacement: top-n by md5 (distributed top-k)."""
    return df.withColumn("_h", md5_key(id_col, seed)).orderBy("_h", id_col).limit(n).drop("_h")


def _poisson1(u):
    """Inverse-CDF Poisson(1) draw from a uniform u (multiplicity 0..7)."""
    import math

    cdf, acc, p = [], 0.0, math.exp(-1.0)
    for k in range(8):
        acc += p
        cdf.append(acc)
        p = p / (k + 1)
    expr = F.lit(8)
    for k in reversed(range(8)):
        expr = F.when(u < F.lit(cdf[k]), F.lit(k)).otherwise(expr)
    return expr


def bootstrap_bags(df: DataFrame, n_bags: int = 10, seed: int = 42, id_col: str = "id") -> DataFrame:
    """One row per (row, bag) with a Poisson(1) multiplicity ``weight``
    (the distributed form of sampling n rows with replacement)."""
    bags = F.sequence(F.lit(0), F.lit(n_bags - 1))
    x = df.withColumn("bag", F.explode(bags))
    u = md5_uniform(F.concat(F.col(id_col).cast("string"), F.lit("/"), F.col("bag").cast("string")), seed)
    return x.withColumn("weight", _poisson1(u).cast("int"))


def out_of_bag(bagged: DataFrame) -> DataFrame:
    return bagged.filter(F.col("weight") == 0)


def random_oversample(df: DataFrame, label_col: str = "label", seed: int = 42, id_col: str = "id") -> DataFrame:
    """Replicate minority rows until classes are equal.  Each row gets
    floor(r) or ceil(r) copies (r = n_max/n_c), the extra copies chosen
    by md5 rank so the class hits n_max exactly."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    n_max = counts.agg(F.max("_n")).first()[0]
    x = df.withColumn("_h", md5_key(id_col, seed))
    x = rank_by_hash(x, [label_col], "_h", id_col)
    base = F.floor(F.lit(n_max) / F.col("group_n"))
    extra = F.lit(n_max) - base * F.col("group_n")
    copies = base + F.when(F.col("rank0") < extra, 1).otherwise(0)
    x = x.withColumn("copy", F.explode(F.sequence(F.lit(0), (copies - 1).cast("int"))))
    return x.drop("_h", "rank0", "group_n")


def class_weights_balanced(df: DataFrame, label_col: str = "label") -> DataFrame:
    """``(label, class_weight)`` = n / (2 n_c); 1,1 if a class is empty."""
    c = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy()  # over the per-class table: a handful of rows
    c = c.withColumn("n", F.sum("n_c").over(w)).withColumn("k", F.count(F.lit(1)).over(w))
    return c.select(
        label_col, F.when(F.col("k") < 2, F.lit(1.0)).otherwise(F.col("n") / (2.0 * F.col("n_c"))).alias("class_weight"))


def sample_weights(df: DataFrame, mode="balanced", label_col: str = "label") -> DataFrame:
    """Per-row ``weight``: 'balanced', a dict {label: w} (default 1.0) or None."""
    if mode is None:
        return df.withColumn("weight", F.lit(1.0))
    if mode == "balanced":
        w = class_weights_balanced(df, label_col)
        return df.join(w, label_col, "left").withColumnRenamed("class_weight", "weight")
    expr = F.lit(1.0)
    for k, v in mode.items():
        expr = F.when(F.col(label_col) == k, F.lit(float(v))).otherwise(expr)
    return df.withColumn("weight", expr)


def positive_weight(df: DataFrame, w: float, label_col: str = "label") -> DataFrame:
    return df.withColumn("weight", F.when(F.col(label_col) == 1, F.lit(float(w))).otherwise(F.lit(1.0)))


def balanced_subsample_weights(bagged: DataFrame, label_col: str = "label") -> DataFrame:
    """Class weights recomputed inside each bag: n_bag / (classes * n_bag_class),
    counting every row with its multiplicity.  One row per (bag, label)."""
    g = bagged.groupBy("bag", label_col).agg(F.sum("weight").cast("long").alias("n")).filter("n > 0")
    bag = Window.partitionBy("bag")  # a bag's classes
    return g.withColumn("class_weight", F.sum("n").over(bag) / (F.count(F.lit(1)).over(bag) * F.col("n")))
