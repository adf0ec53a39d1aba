"""Exact k nearest neighbours, block against block.

Training rows and query rows are dealt into blocks of bounded size by a hash of
their id; a task compares one query block with one training block and keeps the k
best of each query, and the blocks' bests are merged by query.  Nothing passes
through the driver, and a task holds one block of each and the distances of 256 queries.  Ties are
broken by the smaller train id, also at the k-th place."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OUT_SCHEMA = "qid long, nid long, distance double, nlabel int"


#: Queries compared at once inside a task; bounds the matrix of their distances.
SLICE = 256


def _distances(tx: np.ndarray, x: np.ndarray, p: int) -> np.ndarray:
    gap = tx - x
    return np.sqrt((gap * gap).sum(axis=1)) if p == 2 else np.abs(gap).sum(axis=1)


def _best(tid, d, k):
    at = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
    return at[np.lexsort((tid[at], d[at]))[:k]]


def _compare(k: int, p: int):
    """The k best of each query.  Euclidean distances are first bounded by a matrix product
    (squared norms less twice the product, its rounding error added), and only rows that may
    be among the k best get the exact distance."""
    def fn(train: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        if not (len(train) and len(query)):
            return pd.DataFrame({"qid": [], "nid": [], "distance": [], "nlabel": []})
        tid, ty = train["tid"].to_numpy(), train["ty"].to_numpy()
        tx, qx, qid = np.stack(list(train["tx"])).astype(np.float64), np.stack(list(query["qx"])).astype(np.float64), query["qid"].to_numpy()
        out = []
        norm = (tx * tx).sum(axis=1)
        for s in range(0, len(qx), SLICE):
            xs = qx[s:s + SLICE]
            rough = None
            if p == 2 and len(tx) > k:
                own = (xs * xs).sum(axis=1)
                rough = norm - 2.0 * (xs @ tx.T) + own[:, None]
                # a product of m terms is off by at most about m rounding errors of the norms' sum
                slack = 4 * (tx.shape[1] + 4) * np.finfo(float).eps * (own + norm.max())
                reach = _kth(rough, k) + 2 * slack
            for i, x in enumerate(xs):
                if rough is None or not np.isfinite(reach[i]):
                    near = np.arange(len(tx))
                else:
                    near = np.flatnonzero(rough[i] <= reach[i])
                d = _distances(tx[near], x, p)
                at = _best(tid[near], d, k)
                out.append((np.full(len(at), qid[s + i]), tid[near][at], d[at], ty[near][at]))
        return pd.DataFrame({c: np.concatenate(v) for c, v in zip(("qid", "nid", "distance", "nlabel"), zip(*out))})
    return fn


def _kth(rough: np.ndarray, k: int) -> np.ndarray:
    """A bound on each row's k-th least value: the k-th least of the least values of k or
    more strips, which costs one look at each value."""
    strips = max(k, min(64, rough.shape[1] // 16))
    if rough.shape[1] < 16 * strips:
        return np.partition(rough, k - 1, axis=1)[:, k - 1]
    least = np.minimum.reduceat(rough, np.arange(strips) * (rough.shape[1] // strips), axis=1)
    return np.partition(least, k - 1, axis=1)[:, k - 1]


def nearest_neighbors(train: DataFrame, query: DataFrame, k: int = 5, p: int = 2,
                      train_block: int = 32768, query_block: int = 8192) -> DataFrame:
    """``(qid, nid, distance, nlabel, rank)`` for the k nearest train rows (all, if
    fewer).  Both inputs: (id, x array<double>, label); a query that is itself a
    training row finds itself."""
    nt = max(1, -(-train.count() // train_block))
    nq = max(1, -(-query.count() // query_block))
    deal = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    t = train.select(deal(nt, 1).alias("tb"), F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qb"), F.col("id").alias("tid"), F.col("x").alias("tx"), F.col("label").cast("int").alias("ty"))
    q = query.select(F.explode(F.sequence(F.lit(0), F.lit(nt - 1))).alias("tb"), deal(nq, 2).alias("qb"), F.col("id").alias("qid"), F.col("x").alias("qx"))
    cand = t.groupBy("tb", "qb").cogroup(q.groupBy("tb", "qb")).applyInPandas(_compare(k, p), OUT_SCHEMA)
    w = Window.partitionBy("qid").orderBy("distance", "nid")
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_classify(neighbors: DataFrame, weights: str = "uniform") -> DataFrame:
    """Vote of the k neighbours (uniform or 1/d); ties -> smaller class."""
    wcol = F.lit(1.0) if weights == "uniform" else F.when(F.col("distance") > 0, 1.0 / F.col("distance")).otherwise(F.lit(1e12))
    v = neighbors.groupBy("qid", "nlabel").agg(F.sum(wcol).alias("_v"))
    w = Window.partitionBy("qid").orderBy(F.desc("_v"), F.asc("nlabel"))
    tot = neighbors.groupBy("qid").agg(F.sum(wcol).alias("_t"))
    best = v.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("qid", F.col("nlabel").alias("prediction"))
    p1 = v.filter(F.col("nlabel") == 1).select("qid", "_v")
    return (best.join(tot, "qid").join(p1, "qid", "left")
            .select(F.col("qid").alias("id"), "prediction", (F.coalesce("_v", F.lit(0.0)) / F.col("_t")).alias("prob")))
