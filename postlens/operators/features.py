"""Tokenisation and text features in long form ``(id, term, value)``.

Vocabulary, document frequencies and IDF are plain aggregations; the
long table is turned into MLlib vectors only at the model boundary.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.text import english_stop_words, tokens as tokens_expr
from postlens.operators.ranking import global_rank
from postlens.operators.word_vectors import mean_vectors


def tokenize_words(df: DataFrame, text_col: str = "post", out: str = "tokens",
                   stop_words=None, remove_stop_words: bool = True) -> DataFrame:
    sw = stop_words if stop_words is not None else (english_stop_words() if remove_stop_words else None)
    return df.withColumn(out, tokens_expr(text_col, sw))


def word_ngrams(df: DataFrame, tokens_col: str = "tokens", n_min: int = 1, n_max: int = 2,
                out: str = "ngrams", longest: bool = False) -> DataFrame:
    """n-grams joined by one blank, built after stop-word removal (MLlib
    ``NGram``: the token array is handed over once per row, never
    re-evaluated per position).  With ``longest`` long rows ``w1 .. w<n_max>`` in place of
    the columns of ``df``: the words of the longest n-gram that starts at each place, null
    behind the last word of a post."""
    if longest:
        words = [F.slice(tokens_col, F.lit(n), F.greatest(F.size(tokens_col) - n + 1, F.lit(0))).alias(f"w{n}") for n in range(1, n_max + 1)]
        # outer: for a plain explode Spark would infer a filter on the tokens' size, push it
        # below the join of posts and labels and make the tokens of all documents once more
        x = df.select(tokens_col).select(F.explode_outer(F.arrays_zip(*words)).alias(out))
        return x.select(*[F.col(out)[f"w{n}"].alias(f"w{n}") for n in range(1, n_max + 1)]).filter(F.col("w1").isNotNull())
    from pyspark.ml.feature import NGram

    x = df
    cols = []
    for n in range(n_min, n_max + 1):
        c = f"_ng{n}"
        x = NGram(n=n, inputCol=tokens_col, outputCol=c).transform(x)
        cols.append(c)
    return x.withColumn(out, F.concat(*[F.col(c) for c in cols])).drop(*cols)


def word_ngram_counts(df: DataFrame, tokens_col: str = "tokens", n_min: int = 1, n_max: int = 2) -> DataFrame:
    """``(term, cf)`` of all grams of :func:`word_ngrams`, of tokens that are neither null nor hold
    a blank: the longest gram of each place is counted, then each distinct one hands its count to
    its beginnings, so that the posts give one row a place instead of one a place and length."""
    w = [f"w{n}" for n in range(1, n_max + 1)]
    size = F.aggregate(F.array(*w), F.lit(0), lambda n, x: n + F.when(x.isNotNull(), 1).otherwise(0))
    # the size as an aggregate: as a filter on the words it would be pushed down, and the
    # posts be read once for the whole grams and once for the others
    whole = word_ngrams(df, tokens_col, n_min, n_max, longest=True).groupBy(*w).agg(F.count(F.lit(1)).alias("cf"), F.max(size).alias("n"))
    gram = {n: F.concat(w[0], *[x for c in w[1:n] for x in (F.lit(" "), F.col(c))]) for n in range(n_min, n_max + 1)}
    full = whole.filter(F.col("n") == n_max).select(gram[n_max].alias("term"), "cf")
    if n_min == n_max:
        return full
    heads = F.array(*[F.when(F.col("n") >= n, gram[n]) for n in range(n_min, n_max)])
    rest = whole.select("cf", F.explode(heads).alias("term")).filter(F.col("term").isNotNull()).groupBy("term").agg(F.sum("cf").alias("cf"))
    return full.unionByName(rest)


def char_ngrams(df: DataFrame, text_col: str = "post", n_min: int = 2, n_max: int = 6,
                id_col: str = "id", longest: bool = False) -> DataFrame:
    """Long ``(id, term)`` rows of character n-grams of the lower-cased text
    after runs of two or more whitespace characters become one blank.
    Generators keep the normalised text an attribute, so it is computed
    once per post (not once per position).  With ``longest`` only the longest gram that
    starts at each place, of which the others are the beginnings."""
    t = F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[ \\t\\n\\x0B\\f\\r]{2,}", " ")
    # code points of the post, once per post ((?s). matches any code point)
    x = df.select(id_col, F.regexp_extract_all(t, F.lit("(?s)."), 0).alias("_g1"))
    # an n-gram is an (n-1)-gram and one more code point; every length is a column
    # of its own, used twice, so that none is evaluated again for the next
    for n in range(2, n_max + 1):
        if longest:  # at the end of the text the gram stays as it is
            x = x.withColumn(f"_g{n}", F.zip_with(F.col(f"_g{n - 1}"), F.slice(F.col("_g1"), F.lit(n), F.greatest(F.size("_g1") - n + 1, F.lit(0))), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))))
            continue
        left = F.greatest(F.size("_g1") - n + 1, F.lit(0))
        x = x.withColumn(f"_g{n}", F.zip_with(F.slice(F.col(f"_g{n - 1}"), F.lit(1), left), F.slice(F.col("_g1"), F.lit(n), left), lambda a, b: F.concat(a, b)))
    if longest:
        kept = F.slice(F.col(f"_g{n_max}"), F.lit(1), F.greatest(F.size("_g1") - n_min + 1, F.lit(0)))
        return x.select(id_col, F.explode(kept).alias("term"))
    return x.select(id_col, F.explode(F.concat(*[F.col(f"_g{n}") for n in range(n_min, n_max + 1)])).alias("term"))


def char_ngram_counts(df: DataFrame, text_col: str = "post", n_min: int = 2, n_max: int = 6, id_col: str = "id") -> DataFrame:
    """``(term, cf)`` of all grams of :func:`char_ngrams`: the longest gram of each place is
    counted, then each distinct one hands its count to its beginnings, so that the texts give
    one row a place instead of one a place and length."""
    whole = char_ngrams(df, text_col, n_min, n_max, id_col, longest=True).groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
    heads = F.transform(F.sequence(F.lit(n_min), F.length("term")), lambda n: F.substring(F.col("term"), F.lit(1), n))
    return whole.select("cf", F.explode(heads).alias("term")).groupBy("term").agg(F.sum("cf").alias("cf"))


def term_counts(df: DataFrame, id_col: str = "id", terms_col: str = "tokens") -> DataFrame:
    """Bag of words: ``(id, term, tf)`` (map-side combined)."""
    return (df.select(id_col, F.explode(terms_col).alias("term"))
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def binary_counts(counts: DataFrame) -> DataFrame:
    return counts.withColumn("tf", F.least(F.col("tf"), F.lit(1)).cast("long"))


def build_vocabulary(counts: DataFrame, n_docs: int | None = None, min_df: float = 1, max_df: float = 1.0,
                     max_features: int | None = None, id_col: str = "id") -> DataFrame:
    """``(term, df, cf, idx)``: document / corpus frequency, limited by
    min_df (count if >= 1 else share), max_df (share if <= 1 else count)
    and top ``max_features`` by (cf desc, term asc)."""
    stats = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    if n_docs is None and (min_df < 1 or max_df <= 1.0):
        n_docs = counts.select(id_col).distinct().count()
    lo = min_df if min_df >= 1 else math.ceil(min_df * n_docs)
    hi = max_df if max_df > 1 else math.floor(max_df * n_docs)
    stats = stats.filter((F.col("df") >= lo) & (F.col("df") <= hi))
    if max_features is not None:
        # TakeOrderedAndProject: distributed top-k, then a window over k rows.
        top = stats.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
        w = Window.orderBy(F.desc("cf"), F.asc("term"))
        return top.withColumn("idx", (F.row_number().over(w) - 1).cast("int"))
    return global_rank(stats, [F.desc("cf"), F.asc("term")], "idx").withColumn("idx", F.col("idx").cast("int"))


def tfidf(counts: DataFrame, vocab: DataFrame, n_docs: int, sublinear: bool = False, norm: bool = True,
          id_col: str = "id") -> DataFrame:
    """tf * (ln((1+n)/(1+df)) + 1), optionally sublinear tf = 1+ln(tf),
    L2-normalised per document.  ``vocab`` is model-sized and joined."""
    idf = vocab.select("term", "idx", (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))
    tf = F.col("tf").cast("double")
    if sublinear:
        tf = F.lit(1.0) + F.log(tf)
    x = counts.join(idf, "term").withColumn("value", tf * F.col("idf"))
    if not norm:
        return x.select(id_col, "term", "idx", "value")
    w = Window.partitionBy(id_col)
    return x.select(id_col, "term", "idx", (F.col("value") / F.sqrt(F.sum(F.col("value") * F.col("value")).over(w))).alias("value"))


@F.udf(VectorUDT())
def _sparse(size, idx, vals):
    pairs = sorted(zip(idx, vals))
    return SparseVector(size, [p[0] for p in pairs], [float(p[1]) for p in pairs])


def to_vectors(long_df: DataFrame, size: int, id_col: str = "id", out: str = "features", ids: DataFrame | None = None) -> DataFrame:
    """Long ``(id, idx, value)`` -> one SparseVector per id (per-document
    group, bounded by the vocabulary size); ``ids`` names the rows that must
    come out, empty if nothing is known of them."""
    g = long_df.groupBy(id_col).agg(F.collect_list("idx").alias("_i"), F.collect_list("value").alias("_v"))
    if ids is not None:
        g = ids.join(g, id_col, "left").select(id_col, F.coalesce("_i", F.expr("cast(array() as array<int>)")).alias("_i"),
                                               F.coalesce("_v", F.expr("cast(array() as array<double>)")).alias("_v"))
    return g.select(id_col, _sparse(F.lit(size), "_i", "_v").alias(out))


def hashed_counts(df: DataFrame, terms_col: str = "tokens", n_features: int = 1 << 12, out: str = "hashed") -> DataFrame:
    """Unsigned feature hashing (MLlib HashingTF) + L2 norm."""
    h = HashingTF(inputCol=terms_col, outputCol="_h", numFeatures=n_features).transform(df)
    return Normalizer(inputCol="_h", outputCol=out, p=2.0).transform(h).drop("_h")


def token_index(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """1-based integer id per token by descending frequency (ties: token)."""
    c = df.select(F.explode(tokens_col).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    return global_rank(c, [F.desc("freq"), F.asc("token")], "token_id").withColumn("token_id", (F.col("token_id") + 1).cast("int"))


def pad_sequences(seq_col: str, length: int = 40):
    """Keep the last ``length`` ids, left-pad with 0."""
    s = F.col(seq_col)
    kept = F.when(F.size(s) > length, F.slice(s, -length, length)).otherwise(s)
    return F.concat(F.array_repeat(F.lit(0), F.greatest(F.lit(0), F.lit(length) - F.size(kept))), kept)


def embedding_lookup(vocab: DataFrame, vectors: DataFrame, dim: int, word_col: str = "term") -> DataFrame:
    """Vocabulary left-joined to word vectors; zeros where missing."""
    v = vectors.select(F.col("word").alias(word_col), F.col("vec"))
    return vocab.join(v, word_col, "left").select(
        "*", F.col("vec").isNotNull().cast("int").alias("known")).withColumn(
        "vec", F.coalesce(F.col("vec"), F.array_repeat(F.lit(0.0), dim)))


#: Documents whose words meet their vectors in one task, about.
POOL_DOCS = 8192


def mean_pool_embeddings(doc_terms: DataFrame, vectors: DataFrame, id_col: str = "id", n_docs: int | None = None) -> DataFrame:
    """Average of the known-token vectors of each document (no row if it has none).

    The vectors go to the documents: those are dealt by id into parts of about
    ``POOL_DOCS`` (of ``n_docs``, counted if not given), a part gets each vector it has a
    word of once, and sums them in a task.  So a vector moves once per part, not once per
    word of a document, in float32 where that holds it; the words of a document are one
    row.  A word with several vectors counts with each; at a place a null adds nothing to
    the sum."""
    t = doc_terms.select(F.col(id_col).alias("id"), F.col("term").alias("word"), F.col("tf").cast("double").alias("tf")).filter("word IS NOT NULL")
    kind = t.schema["id"].dataType.simpleString()
    docs = t.agg(F.approx_count_distinct("id")).first()[0] if n_docs is None else n_docs
    parts = max(1, -(-docs // POOL_DOCS))
    # one row a document; where the terms are dealt by id already, nothing moves for it
    t = t.groupBy("id").agg(F.collect_list(F.struct("word", "tf")).alias("_t"))
    t = t.select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "id", F.col("_t.word").alias("word"), F.col("_t.tf").alias("tf"))
    asked = t.select(F.col("part").alias("to"), F.explode("word").alias("asked")).distinct()
    t = t.select("part", "id", F.array_join("word", "").cast("binary").alias("words"), F.transform("word", lambda w: F.octet_length(w)).alias("size"), "tf")
    wide = F.transform("vec", lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))
    known = vectors.select(F.col("word").alias("name"), wide.alias("wide"), F.transform("vec", lambda x: x.isNull()).alias("gaps"))
    known = known.withColumn("gaps", F.when(F.array_contains("gaps", True), F.col("gaps"))).filter(F.size("wide") > 0)
    single = F.col("wide").cast("array<float>")
    known = known.withColumn("vec", F.when(F.forall(F.zip_with("wide", single.cast("array<double>"), lambda a, b: a == b), lambda same: same), single))
    known = known.withColumn("wide", F.when(F.col("vec").isNull(), F.col("wide")))
    sent = asked.join(known, F.col("asked") == F.col("name")).select("to", "name", "vec", "wide", "gaps")

    def pool(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({id_col: docs["id"][:0], "embedding": pd.Series(dtype=object)})
        if not (len(docs) and len(words)):
            return none
        number, names = pd.factorize(words["name"])
        vecs = [v if v is not None else w for v, w in zip(words["vec"], words["wide"])]
        size, longest = np.array([len(v) for v in vecs]), max(map(len, vecs))
        plain, times = words["gaps"].isna().all() and (size == longest).all(), np.bincount(number)
        # a word's vectors summed: values, and unless they are all alike vectors that have the place, those that have a value there
        single = plain and (times == 1).all() and words["vec"].notna().all()
        total = np.zeros((1 if plain else 3, len(names), longest), np.float32 if single else float)
        for i, v, gaps in zip(number, vecs, words["gaps"]):
            total[0, i, :len(v)] += v
            if not plain:
                total[1, i, :len(v)] += 1
                total[2, i, :len(v)] += 1 if gaps is None else ~np.asarray(gaps, bool)
        vecs, names, out = None, pa.array(names, pa.string()), []
        for lo in range(0, len(docs), 256):  # whole documents a slice
            some = docs.iloc[lo:lo + 256]
            ends = np.cumsum(np.concatenate([[0], *some["size"]]))
            text = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(b"".join(some["words"]))])
            at = pc.fill_null(pc.index_in(text, names.cast(pa.large_string())), -1).to_numpy()
            doc, tf = np.repeat(np.arange(len(some)), some["size"].map(len)), np.concatenate(some["tf"].to_numpy())
            doc, at, tf = doc[at >= 0], at[at >= 0], tf[at >= 0]
            first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, int)
            sums = np.zeros((len(total), len(first), longest))
            for i, (start, end) in enumerate(zip(first, np.append(first[1:], len(doc)))):
                for s in range(start, end, 20_000):
                    part = slice(s, min(end, s + 20_000))
                    sums[:, i] += (total[:, at[part]] * tf[part, None]).sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                if plain and len(first):
                    rows = (sums[0] / np.add.reduceat(tf * times[at], first)[:, None]).tolist()
                else:
                    rows = [[v if n > 0 else None for v, n, d in zip(m, known, every) if d > 0] for m, known, every in zip(sums[0] / sums[-2], sums[-1], sums[-2])] if len(first) else []
            out.append(pd.DataFrame({id_col: some["id"].to_numpy()[doc[first]], "embedding": pd.Series(rows, dtype=object)}))
        return pd.concat(out, ignore_index=True)

    return t.groupBy("part").cogroup(sent.groupBy("to")).applyInPandas(pool, f"`{id_col}` {kind}, embedding array<double>")


def word2vec_mean(df: DataFrame, size: int = 300, passes: int = 5, seed: int = 42, id_col: str = "id", tokens_col: str = "tokens",
                  window: int = 5, negative: int = 5, part_tokens: int | None = None) -> DataFrame:
    """``id, embedding``: mean of the word vectors of a row's tokens, trained on these
    rows; every token has a vector (min count 1), a row without tokens gets null.
    CBOW with negative samples; rows are dealt to parts of about ``part_tokens`` tokens,
    each trained in a task that holds the vectors of its own words; those of a word met in
    several parts are averaged by its counts after the last pass."""
    return mean_vectors(df, size, passes, window, negative, seed, id_col, tokens_col, part_tokens)
