"""What the two substring operators share: which windows of W symbols occur twice.

Of the k-symbol grams of a window the one with the least hash is its anchor, so
equal windows have equal anchors.  Neighbouring windows with one anchor form a run,
whose text from the first window's start to the last one's end is its context.

* An anchor met once ends there: none of its windows can occur twice.
* A context met twice (128 hash bits) marks all its windows wherever it occurs.
* Where an anchor has several contexts, those met once are compared symbol by
  symbol with the others of their anchor: the operators' own methods.  Anchors with
  more than ``crowd`` contexts are split by longer prefixes, the whole windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import keep, shuffle_partitions, with_row_key

CHUNK = 1 << 18  # windows of a long text that are hashed at once
CROWD, PACK_BYTES = 20_000, 1 << 17
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd
_LOW = np.uint64(0xFFFFFFFF)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i < n, kept between texts."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[base] = np.cumprod(up), np.cumprod(down)
    return _powers[base]


class Hashes:
    """Hashes of all substrings of a symbol sequence, by prefix sums."""

    def __init__(self, symbols: np.ndarray, base: int):
        up, self.down = _power(base, len(symbols) + 1)
        self.sum = np.concatenate((np.zeros(1, np.uint64), np.cumsum(symbols * up[:len(symbols)], dtype=np.uint64)))

    def of(self, a, b) -> np.ndarray:
        return mix((self.sum[b] - self.sum[a]) * self.down[a])


def least_positions(h: np.ndarray, w: int) -> np.ndarray:
    """For every window of ``w`` values the position of its least one (by 32 bits,
    ties: the first)."""
    m = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while 2 * span <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < w:
        m = np.minimum(m[:len(m) - (w - span)], m[w - span:])
    return (m & _LOW).astype(np.int64)


def runs(symbols: np.ndarray, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``h`` (anchor), ``c`` (context), first and last window start of every run, in
    chunks of bounded size; a run may end at a chunk's end."""
    for at in range(0, len(symbols) - window + 1, CHUNK):
        s = symbols[at:at + CHUNK + window - 1]
        one, two = Hashes(s, _BASES[0]), Hashes(s, _BASES[1])
        first = np.arange(len(s) - gram + 1)
        g = one.of(first, first + gram)
        pos = least_positions(g, window - gram + 1)
        lo = np.flatnonzero(np.concatenate(([True], pos[1:] != pos[:-1])))
        hi = np.append(lo[1:], len(pos)) - 1
        c = mix(two.of(lo, hi + window) + (hi - lo).astype(np.uint64) * np.uint64(_BASES[0]))
        yield g[pos[lo]].view(np.int64), c.view(np.int64), lo + at, hi + at


def window_keys(symbols: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """128 hash bits of every window."""
    a = np.arange(max(0, len(symbols) - window + 1))
    return tuple(Hashes(symbols, b).of(a, a + window).view(np.int64) for b in _BASES)


def spans_of(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """The union of the windows at ``starts`` (sorted), as spans."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] > starts[:-1] + window)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + window).tolist()))


def repeated_spans(docs: DataFrame, window: int, gram: int, symbols: Callable[[bytes], np.ndarray], part: Callable[[bytes, list[tuple[int, int]]], list[bytes]],
                   solve: Callable[[list[bytes], np.ndarray, int], list[np.ndarray]], crowd: int = CROWD, name: str = "repeats") -> DataFrame:
    """``(_id, _th, spans)``: spans of symbols covered by a window that also starts
    anywhere else.  ``docs`` as of :func:`with_row_key`.  ``symbols``: 64-bit values
    of a text's symbols; ``part``: contexts as bytes; ``solve``: of a list of contexts
    with their numbers of occurrences, the window starts in each that occur twice."""
    spark = docs.sparkSession
    text = docs.select("_id", "_th", F.col("text").cast("binary").alias("t"))
    key = "_id long, _th int"

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, size = [], 0
            for i, th, t in zip(b["_id"], b["_th"], b["t"]):
                for h, c, lo, hi in runs(symbols(t), window, gram):
                    out.append((np.full(len(h), i), np.full(len(h), th, np.int32), h, c, lo.astype(np.int32), hi.astype(np.int32)))
                    size += len(h)
                if size > 200_000:
                    yield pd.DataFrame(dict(zip(("_id", "_th", "h", "c", "lo", "hi"), map(np.concatenate, zip(*out)))))
                    out, size = [], 0
            if out:
                yield pd.DataFrame(dict(zip(("_id", "_th", "h", "c", "lo", "hi"), map(np.concatenate, zip(*out)))))

    # hashed twice rather than stored: the anchors of all texts take as much room as the texts
    anchors = text.mapInPandas(find, f"{key}, h long, c long, lo int, hi int")
    # a table of its own, so that a hot anchor's partition of the join can be split
    twice = keep(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), f"{name}-twice")
    met = keep(anchors.join(twice, "h"), f"{name}-anchors")
    contexts = met.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_id", "_th", "lo", "hi")).alias("at"))
    contexts = keep(contexts.select("h", "c", "n", "at.*"), f"{name}-contexts")
    known = (met.join(contexts.filter("n > 1").select("h", "c"), ["h", "c"])
             .select("_id", "_th", F.col("lo").alias("a"), (F.col("hi") + window).alias("b")))
    open_ = contexts.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).filter("k > 1 and least = 1").select("h", "k")
    asked = contexts.join(open_, "h")
    wanted = asked.groupBy("_id", "_th").agg(F.collect_list(F.struct("h", F.least("n", F.lit(2)).cast("int").alias("n"), "lo", "hi", (F.col("k") > crowd).alias("crowded"))).alias("w"))
    # a repeated row would only bring its contexts twice, which are known to be met twice
    fetched = wanted.join(text, ["_id", "_th"])

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["_id", "_th", "h", "z", "n", "lo", "c"]
        for b in batches:
            rows = []
            for i, th, t, w in zip(b["_id"], b["_th"], b["t"], b["w"]):
                texts = part(t, [(x["lo"], x["hi"] + window) for x in w])
                for x, c in zip(w, texts):
                    if not x["crowded"]:
                        rows.append((i, th, x["h"], 0, x["n"], x["lo"], c))
                    else:
                        rows += [(i, th, a, z, x["n"], x["lo"] + k, None) for k, (a, z) in enumerate(zip(*map(np.ndarray.tolist, window_keys(symbols(c), window))))]
                if len(rows) > 10_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    found = keep(fetched.mapInPandas(fetch, f"{key}, h long, z long, n int, lo int, c binary"), f"{name}-texts")
    whole = found.filter("c is null").select("_id", "_th", "h", "z", "n", "lo")
    again = whole.groupBy("h", "z").agg(F.sum("n").alias("m")).filter("m > 1").select("h", "z")
    crowded = whole.join(again, ["h", "z"]).filter("n = 1").select("_id", "_th", F.col("lo").alias("a"), (F.col("lo") + window).alias("b"))
    grouped = found.filter("c is not null").select("_id", "_th", "h", "n", "lo", "c").repartition(shuffle_partitions(spark), "h").sortWithinPartitions("h")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        n = rows["n"].to_numpy()
        out = []
        for i, th, lo, one, starts in zip(rows["_id"], rows["_th"], rows["lo"], n, solve(list(rows["c"]), n, window)):
            if one == 1:
                out += [(i, th, lo + a, lo + b) for a, b in spans_of(starts, window)]
        return pd.DataFrame(out, columns=["_id", "_th", "a", "b"])

    def packs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole groups, a few at a time: ``PACK_BYTES`` of contexts or one group."""
        held = pd.DataFrame()
        for b in batches:
            held = pd.concat([held, b], ignore_index=True) if len(held) else b
            h = held["h"].to_numpy()
            ends = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, len(h)) if len(h) else np.zeros(0, int)
            size = np.concatenate(([0], np.cumsum(held["c"].map(len).to_numpy())))
            at = 0
            for k, e in enumerate(ends[:-1]):  # the last group may go on
                if size[e] - size[at] > PACK_BYTES or k == len(ends) - 2:
                    yield compare(held.iloc[at:e])
                    at = e
            held = held.iloc[at:].reset_index(drop=True)
        if len(held):
            yield compare(held)

    solved = grouped.mapInPandas(packs, f"{key}, a int, b int")
    marks = known.unionByName(crowded).unionByName(solved)
    return marks.groupBy("_id", "_th").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def covered(n: int, spans) -> np.ndarray:
    """Which of ``n`` symbols lie in one of ``spans``."""
    step = np.zeros(n + 1, np.int64)
    for s in spans if spans is not None else ():
        step[s["a"]] += 1
        step[s["b"]] -= 1
    return np.cumsum(step[:-1]) > 0


def cut(docs: DataFrame, spans: DataFrame, split: Callable, columns: str) -> DataFrame:
    """``split(text, spans)`` of every row of ``docs`` (:func:`with_row_key`):
    ``doc_id`` and ``columns``."""
    d = docs.select("doc_id", "_id", "_th", F.col("text").cast("binary").alias("t")).join(spans, ["_id", "_th"], "left").select("doc_id", "t", "spans")
    names = [c.split()[0] for c in columns.split(", ")]

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [split(t, s) for t, s in zip(b["t"], b["spans"])]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", b["doc_id"].astype("Int64").to_numpy())
            yield out

    return d.mapInPandas(apply, f"doc_id long, {columns}")


__all__ = ["covered", "cut", "mix", "repeated_spans", "with_row_key"]
