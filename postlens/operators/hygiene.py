"""Label / text hygiene and per-post scalar features."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions import text as TX


def clean_labels(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Drop stray header rows and non-numeric labels, cast to int."""
    num = F.expr(f"try_cast(try_cast(`{label_col}` AS DOUBLE) AS INT)")  # null for 'NaN', 'inf', '1e20'
    return df.withColumn(label_col, num).filter(F.col(label_col).isNotNull())


def fill_or_drop_blank_posts(df: DataFrame, text_col: str = "post", mode: str = "fill") -> DataFrame:
    if mode == "fill":
        return df.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
    return df.filter(F.col(text_col).isNotNull() & F.col(text_col).rlike("[^\\s\\u000b\\u001c-\\u001f\\u0085\\p{Z}]"))


def rename_drop_columns(df: DataFrame, drop=(), rename=None) -> DataFrame:
    out = df.drop(*drop)
    for a, b in (rename or {}).items():
        out = out.withColumnRenamed(a, b)
    return out


def count_missing(df: DataFrame, cols) -> DataFrame:
    """``(column_name, n_missing)``: null (or NaN for doubles) per column."""
    parts = []
    for c in cols:
        dt = dict(df.dtypes)[c]
        miss = F.col(c).isNull() | (F.isnan(c) if dt in ("double", "float") else F.lit(False))
        parts.append(df.agg(F.lit(c).alias("column_name"), F.sum(miss.cast("long")).cast("long").alias("n_missing")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_missing_array(df: DataFrame, col: str) -> DataFrame:
    m = F.size(F.filter(F.col(col), lambda x: x.isNull() | F.isnan(x)))
    return df.agg(F.lit(col).alias("column_name"), F.sum(m).cast("long").alias("n_missing"))


def impute_zero(df: DataFrame, array_col: str) -> DataFrame:
    """NaN / null -> 0.0 inside a feature array."""
    return df.withColumn(array_col, F.transform(
        F.col(array_col), lambda x: F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(x.cast("double"))))


def count_symbols(df: DataFrame, text_col: str = "post", id_col: str = "id") -> DataFrame:
    t = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(id_col, TX.count_char(t, "#").cast("long").alias("num_hashtags"),
                     TX.count_char(t, "@").cast("long").alias("num_mentions"))


def sample_rows_per_class(df: DataFrame, class_col: str, order_col: str, nth: int = 1) -> DataFrame:
    """The n-th row (1-based, by ``order_col``) of each class.  The
    ``rn <= nth`` filter lets Spark apply a partial per-partition top-n
    (WindowGroupLimit) before the shuffle, so a big class never lands
    whole in one task."""
    w = Window.partitionBy(class_col).orderBy(order_col)
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= nth)
            .filter(F.col("_rn") == nth).drop("_rn"))


def text_stats(df: DataFrame, text_col: str = "post", names=None) -> DataFrame:
    st = TX.text_stat_columns(text_col)
    names = names or TX.STAT_NAMES
    return df.select("*", *[st[n].alias(n) for n in names])


def text_stat_vector(df: DataFrame, text_col: str = "post", names=None, out: str = "stats") -> DataFrame:
    """All statistics in fixed order as one vector column."""
    names = names or TX.STAT_NAMES
    stats = TX.text_stat_columns(text_col)
    x = df.select("id", *[stats[n].cast("double").alias(n) for n in names])
    return VectorAssembler(inputCols=names, outputCol=out).transform(x).select("id", out)


def lexicon_sentiment(df: DataFrame, lexicon: DataFrame, text_col: str = "post", id_col: str = "id",
                      alpha: float = 15.0) -> DataFrame:
    """Valence sum s of the post's words found in the lexicon (a join on
    the exploded words), compound = s / sqrt(s^2 + alpha); posts with no
    hit get 0."""
    w = df.select(id_col, F.explode(TX.words(text_col, lower=True)).alias("word"))
    w = w.withColumn("word", F.regexp_replace("word", "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", ""))
    s = w.join(lexicon, "word").groupBy(id_col).agg(F.sum("valence").alias("s"),
                                                                  F.count(F.lit(1)).alias("hits"))
    out = df.select(id_col).join(s, id_col, "left").fillna(0, ["s", "hits"])
    return out.withColumn("compound", F.col("s") / F.sqrt(F.col("s") * F.col("s") + F.lit(alpha)))


def sentiment_label(compound_col: str = "compound"):
    return F.when(F.col(compound_col) >= 0, "positive").otherwise("negative")


def dictionary_lemmatize(df: DataFrame, lemmas: DataFrame, text_col: str = "clean", id_col: str = "id",
                         out: str = "lemmatized") -> DataFrame:
    """Replace every word by its dictionary lemma and re-join in order
    (posexplode + left join + ordered collect per post)."""
    w = df.select(id_col, F.posexplode(TX.words(text_col)).alias("pos", "word"))
    j = w.join(lemmas, "word", "left").withColumn("tok", F.coalesce("lemma", "word"))
    g = j.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "tok"))).alias("_s"))
    lem = g.select(id_col, F.array_join(F.transform("_s", lambda s: s["tok"]), " ").alias(out))
    return df.join(lem, id_col, "left").withColumn(out, F.coalesce(F.col(out), F.lit("")))


def one_hot(df: DataFrame, col: str, id_col: str = "id") -> DataFrame:
    """``(id, category, hot)``: one 0/1 row per category that occurs in ``df``; a
    null value has no hot row."""
    cats = sorted(r[0] for r in df.select(col).na.drop().distinct().collect())  # a category column's few values
    each = df.select(id_col, col, F.explode(F.lit(cats)).alias("category"))
    return each.select(id_col, "category", (F.col(col) == F.col("category")).cast("int").alias("hot"))


def binarize(col: str, threshold: float = 0.0):
    return (F.col(col) > threshold).cast("int")
