"""Lexicons learned from the posts themselves: word valences from labelled posts,
suffix lemmas from word frequencies, and what the valences say of each post.

Everything is a join or an aggregation keyed by word or post.  A word of every
post is one row per post (counted before any join), so its rows are bounded by
the posts and Spark may split them as a skewed join."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions import text as TX

#: (suffix, what stands in its place) of English inflection.
SUFFIX_RULES = [("ies", "y"), ("ied", "y"), ("es", ""), ("s", ""), ("ed", ""), ("ed", "e"), ("ing", ""), ("ing", "e"), ("ly", "")]

SENTIMENT_NAMES = ["compound", "pos", "neg", "neu", "polarity", "subjectivity"]

#: The valence scale ends at this on both sides.
SCALE = 4.0


def post_words(df: DataFrame, text_col: str = "post", id_col: str = "id") -> DataFrame:
    """``(id, word, n)``: the words of :func:`word_rows` counted per post.  The posts are
    dealt by id before they are cut, so that a post moves as its text and its words stay."""
    return word_rows(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("post")).repartition("id"), "post", "id").groupBy("id", "word").agg(F.count(F.lit(1)).alias("n"))


def word_rows(df: DataFrame, text_col: str = "post", id_col: str = "id") -> DataFrame:
    """``(id, word)``: lower-cased words without the marks around them, repeats included.
    Null and empty texts have none; words of marks alone are none."""
    w = df.select(F.col(id_col).alias("id"), F.explode(TX.words(text_col, lower=True)).alias("word"))
    w = w.withColumn("word", F.regexp_replace("word", "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", ""))
    return w.filter(F.col("word") != "")


def induce_lexicon(words: DataFrame, labels: DataFrame, prior: float = 1000.0, min_posts: int = 3, z_min: float = 1.96) -> DataFrame:
    """``(word, n_pos, n_neg, z, valence)`` from ``words`` (id, word, n) and ``labels``
    (id, label 0/1; rows with another label or null take no part).

    Log-odds of the posts that hold the word, label 1 against 0, with an informative
    Dirichlet prior of ``prior`` pseudo posts spread as the word is over both classes;
    z is the log-odds over its standard error.  Words in at least ``min_posts`` posts
    with |z| >= ``z_min`` enter; label 1 is the bad side, so valence = -z within +-4.
    A repeated word of a post counts once.  No rows, or a single word: no lexicon."""
    seen = words.join(labels.filter(F.col("label").isin(0, 1)).select("id", "label"), "id")
    c = seen.groupBy("word").agg(F.sum("label").cast("double").alias("p"), F.sum(1 - F.col("label")).cast("double").alias("q")).persist()
    P, Q = (float(v or 0.0) for v in c.agg(F.sum("p"), F.sum("q")).first())
    a = F.lit(prior) * (F.col("p") + F.col("q")) / F.lit(max(P + Q, 1.0))
    odds = [F.ln(F.col(x) + a) - F.ln(F.lit(total + prior) - F.col(x) - a) for x, total in (("p", P), ("q", Q))]
    # nine places: the threshold does not hang on the last bit, and sums of valences do not end on a half
    z = F.round((odds[0] - odds[1]) / F.sqrt(1 / (F.col("p") + a) + 1 / (F.col("q") + a)), 9)
    out = c.filter(F.col("p") + F.col("q") >= min_posts).select("word", F.col("p").cast("long").alias("n_pos"), F.col("q").cast("long").alias("n_neg"), z.alias("z"))
    return out.filter(F.abs("z") >= z_min).withColumn("valence", F.greatest(F.lit(-SCALE), F.least(F.lit(SCALE), -F.col("z"))))


def sentiment_stats(posts: DataFrame, words: DataFrame, lexicon: DataFrame, alpha: float = 15.0) -> DataFrame:
    """``id`` and SENTIMENT_NAMES for every row of ``posts``.

    ``compound`` = s / sqrt(s^2 + alpha) of the valence sum s; ``pos``, ``neg``, ``neu``
    are shares of the words, one of valence v weighing |v| + 1 and one of none 1;
    ``polarity`` is the mean valence of the lexicon words over 4, ``subjectivity``
    their share of all words.  Posts without words, and unknown ones, have zeros."""
    v, n = F.coalesce(F.col("valence"), F.lit(0.0)), F.col("n")
    zero = F.lit(0.0)
    g = words.join(lexicon.select("word", "valence"), "word", "left").groupBy("id").agg(
        F.sum(n * v).alias("s"),
        F.sum(F.when(v > 0, n * (v + 1)).otherwise(zero)).alias("up"),
        F.sum(F.when(v < 0, n * (1 - v)).otherwise(zero)).alias("down"),
        F.sum(F.when(v == 0, n).otherwise(0)).alias("flat"),
        F.sum(n).alias("total"))
    g = g.withColumn("hits", F.col("total") - F.col("flat"))
    mass = F.col("up") + F.col("down") + F.col("flat")
    stats = {
        "compound": F.col("s") / F.sqrt(F.col("s") * F.col("s") + F.lit(alpha)),
        "pos": F.col("up") / mass, "neg": F.col("down") / mass, "neu": F.col("flat") / mass,
        "polarity": F.when(F.col("hits") > 0, F.col("s") / (F.col("hits") * SCALE)).otherwise(zero),
        "subjectivity": F.col("hits") / F.col("total"),
    }
    found = g.select("id", *[stats[k].alias(k) for k in SENTIMENT_NAMES])
    return posts.select("id").join(found, "id", "left").fillna(0.0, SENTIMENT_NAMES)


def full_stat_vector(posts: DataFrame, sentiment: DataFrame, text_col: str = "post", out: str = "stats") -> DataFrame:
    """All 24 statistics of a post, the sentiment ones behind ``repeat_ratio``, as one vector."""
    stats = TX.text_stat_columns(text_col)
    x = posts.select("id", *[stats[k].cast("double").alias(k) for k in TX.STAT_NAMES]).join(sentiment, "id")
    return VectorAssembler(inputCols=full_stat_names(), outputCol=out).transform(x).select("id", out)


def full_stat_names() -> list[str]:
    cut = TX.STAT_NAMES.index("repeat_ratio") + 1
    return TX.STAT_NAMES[:cut] + SENTIMENT_NAMES + TX.STAT_NAMES[cut:]


def sign_test(sentiment: DataFrame, labels: DataFrame) -> DataFrame:
    """``(label, n_posts, n_signed, n_agree, z)``: of the posts of a label those with a
    compound other than zero and those whose sign says the label (1: below zero), and
    the sign test's normal score against a coin; null where no post has a sign."""
    x = sentiment.join(labels.select("id", "label"), "id").withColumn("c", F.round("compound", 9))
    agree = ((F.col("c") < 0) & (F.col("label") == 1)) | ((F.col("c") > 0) & (F.col("label") == 0))
    g = x.groupBy("label").agg(F.count(F.lit(1)).alias("n_posts"), F.count_if(F.col("c") != 0).alias("n_signed"), F.count_if(agree).alias("n_agree"))
    return g.withColumn("z", F.when(F.col("n_signed") > 0, (2 * F.col("n_agree") - F.col("n_signed")) / F.sqrt("n_signed")))


def induce_lemmas(words: DataFrame, rules=None, min_stem: int = 3) -> DataFrame:
    """``(word, lemma, n, lemma_n)`` from ``words`` (word, n), whose counts of a word are summed.

    Each rule offers a word of letters the form with its suffix replaced, where at
    least ``min_stem`` letters stay before it.  The lemma is the offered form that is
    itself a word at least as frequent; among several the most frequent, then the
    first in code-point order.  One step only: a lemma may have one of its own."""
    vocab = words.groupBy("word").agg(F.sum("n").alias("n")).persist()  # read twice
    stem = lambda s, r: F.concat(F.expr(f"substring(word, 1, length(word) - {len(s)})"), F.lit(r))
    offers = F.array(*[F.when(F.endswith("word", F.lit(s)) & (F.length("word") >= len(s) + min_stem), stem(s, r)) for s, r in rules or SUFFIX_RULES])
    offered = vocab.filter(F.col("word").rlike("^\\p{L}+$")).select("word", "n", F.explode(F.array_distinct(offers)).alias("lemma"))
    known = offered.filter(F.col("lemma").isNotNull()).join(vocab.select(F.col("word").alias("lemma"), F.col("n").alias("lemma_n")), "lemma")
    best = known.filter(F.col("lemma_n") >= F.col("n")).groupBy("word").agg(F.first("n").alias("n"), F.min(F.struct((-F.col("lemma_n")).alias("m"), "lemma")).alias("b"))
    return best.select("word", F.col("b.lemma").alias("lemma"), "n", (-F.col("b.m")).alias("lemma_n"))
