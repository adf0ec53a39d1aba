"""Exact top-k by inner product: exhaustive term-at-a-time accumulation in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import keep, table

SCALE, TOP, EVERY = 256, 5, 50
QUERY_BLOCK, ROW_BLOCK = 512, 4096


def scaled(vec: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as double; null where the vector, or
    any component, is null or not finite."""
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(ok, F.transform(vec, lambda x: F.floor(scale * x.cast("double")).cast("long")))


def accumulate(queries: list[np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
    """Scores (queries x rows) term at a time: a term's posting list holds the rows
    with a weight other than zero; every query that has the term scatters its
    weighted postings into its own dense score array.  Missing components are zero."""
    scores = np.zeros((len(queries), len(rows)), np.int64)
    width = max((len(x) for x in [*queries, *rows]), default=0)

    def matrix(xs):
        m = np.zeros((width, len(xs)), np.int64)
        for i, x in enumerate(xs):
            m[:len(x), i] = x
        return m

    q, r = matrix(queries), matrix(rows)
    for term in range(width):
        post = np.flatnonzero(r[term])
        ask = np.flatnonzero(q[term])
        if not len(post) or not len(ask):
            continue
        weights = r[term, post]
        whole = len(post) == len(rows)
        for i in ask:
            if whole:
                scores[i] += q[term, i] * weights
            else:
                scores[i, post] += q[term, i] * weights
    return scores


def best(scores: np.ndarray, query_ids: np.ndarray, row_ids: np.ndarray, k: int) -> pd.DataFrame:
    """The k highest of every query in this block, ties to the smaller id, without
    the query's own row: partition selection at the k-th score, then a sort of
    what is at or above it."""
    out = []
    for i, own in enumerate(query_ids):
        at = np.flatnonzero(row_ids != own)
        s = scores[i, at]
        if len(s) > k:
            at = at[s >= np.partition(s, len(s) - k)[len(s) - k]]
            s = scores[i, at]
        order = np.lexsort((row_ids[at], -s))[:k]
        out.append((np.full(len(order), own), row_ids[at][order], s[order]))
    cols = [np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else ([], [], []))]
    return pd.DataFrame({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE, id_col: str = "vec_id",
          vec_col: str = "embedding", query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest inner products
    of the scaled integer vectors over every other row (all, if fewer).

    Rows and queries are dealt into blocks of bounded size by a hash of the id; a
    task scores one query block against one row block, and the blocks' best are
    merged by query.  Null vectors, vectors with null or non-finite components and
    null ids take no part.  Rows that repeat an id count once, with the least
    vector.  Vectors of other lengths: missing components are zero.  Scores wrap
    at 64 bits.  Empty table: no rows.  Other columns are not read."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vec_col), scale).alias("v")).filter("vec_id is not null and v is not null")
    v = keep(v.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    queries = v.filter(is_query)
    n, m = v.count(), queries.count()
    nr, nq = max(1, -(-n // row_block)), max(1, -(-m // query_block))
    deal = lambda blocks, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(blocks)).cast("int")
    rows = v.select(deal(nr, 1).alias("rb"), F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qb"), "vec_id", "v")
    asks = queries.select(F.explode(F.sequence(F.lit(0), F.lit(nr - 1))).alias("rb"), deal(nq, 2).alias("qb"), F.col("vec_id").alias("query_id"), F.col("v").alias("w"))

    def score(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asks):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        s = accumulate(list(asks["w"]), list(rows["v"]))
        return best(s, asks["query_id"].to_numpy(), rows["vec_id"].to_numpy(), k)

    part = rows.groupBy("rb", "qb").cogroup(asks.groupBy("rb", "qb")).applyInPandas(score, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
   FROM v q JOIN v r ON q.vec_id % {EVERY} = 0 AND q.vec_id <> r.vec_id)
SELECT query_id, rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s) WHERE rank <= {TOP}
"""
