"""SimHash near-dedup: fingerprints, Hamming self-join over a binary trie, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import keep, shuffle_partitions, table

SHINGLE, MAX_BITS, HOT_GROUP, FRONTIER = 3, 3, 200_000, 1 << 19


# ------------------------------------------------------------- fingerprints
def text_fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of one UTF-8 text: bit b is set where over half of
    the shingle hashes have it; no words: zero."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        h = [xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[at:min(n, at + (1 << 15))].tolist(), last[at:at + (1 << 15)].tolist())]
        bits = np.unpackbits(np.array(h, np.dtype(">u8")).view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n).view(">i8")[0])


def fingerprint_column(text_col, shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_fingerprint(t or b"", shingle) for t in texts], dtype="int64")

    return fingerprint(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


# ---------------------------------------------------------------- trie join
def _union(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Least index reachable over the links u-v, starting from ``label``."""
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def trie_links(values: np.ndarray, roots: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """``values``: sorted uint64, in runs that begin at ``roots``; a run shares its
    first ``depth`` bits and is the leaves of one trie node.  Starting from the
    pairs (root, root), node pairs descend together; a pair whose paths differ in
    more than ``budget`` bits is dropped.  Returns for every value the least index
    of its component."""
    label = np.arange(len(values))
    ends = np.append(roots[1:], len(values))
    zero = np.zeros(len(roots), np.int64)
    work = [(depth, roots, ends, roots, ends, zero)]
    while work:
        depth, alo, ahi, blo, bhi, diff = work.pop()
        if len(alo) > FRONTIER:  # bounded memory: half of the pairs wait
            half = len(alo) // 2
            work.append((depth, *(x[half:] for x in (alo, ahi, blo, bhi, diff))))
            work.append((depth, *(x[:half] for x in (alo, ahi, blo, bhi, diff))))
            continue
        leaf = (ahi - alo == 1) & (bhi - blo == 1)
        if depth == 64:
            leaf[:] = True
        if leaf.any():
            u, v = alo[leaf], blo[leaf]
            near = (u != v) & (np.bitwise_count(values[u] ^ values[v]) <= budget)
            if near.any():
                label = _union(label, u[near], v[near])
            alo, ahi, blo, bhi, diff = (x[~leaf] for x in (alo, ahi, blo, bhi, diff))
        if not len(alo):
            continue
        bit = np.uint64(63 - depth)

        def middle(lo, hi):
            # the first leaf of the node whose next bit is 1
            first = (values[lo] >> bit | np.uint64(1)) << bit
            return np.clip(np.searchsorted(values, first), lo, hi)

        amid, bmid = middle(alo, ahi), middle(blo, bhi)
        other = (alo != blo) & True
        kids = [(alo, amid, blo, bmid, diff), (amid, ahi, bmid, bhi, diff), (alo, amid, bmid, bhi, diff + 1),
                tuple(x[other] for x in (amid, ahi, blo, bmid, diff + 1))]
        alo, ahi, blo, bhi, diff = (np.concatenate(x) for x in zip(*kids))
        live = (diff <= budget) & (alo < ahi) & (blo < bhi) & ((ahi - alo > 1) | (alo != blo) | (bhi - blo > 1))
        work.append((depth + 1, *(x[live] for x in (alo, ahi, blo, bhi, diff))))
    return label


def _rotate(fp, block: int):
    """Bits of 16-bit block ``block`` first, cyclically: a trie in that bit order."""
    return F.expr(f"(shiftleft({fp}, {16 * block}) | shiftrightunsigned({fp}, {64 - 16 * block}))") if block else F.col(fp)


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_GROUP) -> DataFrame:
    """``(u, v)``, u > v: links that connect all of ``fps.fp`` (distinct) that lie
    within ``max_bits`` (3 at most) of each other, transitively.

    Of four 16-bit blocks two such fingerprints share one whole, so the trie is
    cut below every block value, in each of the four bit rotations; a task joins
    its tries with themselves.  A block value with more than ``hot`` fingerprints
    is cut again by four 12-bit blocks of its other bits, by the same argument."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3: four blocks find no more")
    spark = fps.sparkSession
    rot = fps.select(F.explode(F.array(*[F.struct(F.lit(b).alias("block"), _rotate("fp", b).alias("x")) for b in range(4)])).alias("s")).select("s.*")
    rot = rot.withColumn("head", F.shiftrightunsigned("x", 48))
    crowd = rot.groupBy("block", "head").count().filter(F.col("count") > hot).select("block", "head")
    calm = rot.join(crowd, ["block", "head"], "left_anti").select("block", F.lit(-1).alias("sub"), "head", "x")
    # the 48 other bits, turned by 12 within themselves, so that sub-block s comes next
    rest = F.expr("x & 281474976710655")
    turned = [F.expr(f"shiftleft(head, 48) | ((shiftleft(rest, {12 * s}) | shiftrightunsigned(rest, {48 - 12 * s})) & 281474976710655)") for s in range(4)]
    crowded = (rot.join(crowd, ["block", "head"]).withColumn("rest", rest)
               .select("block", "head", F.explode(F.array(*[F.struct(F.lit(s).alias("sub"), t.alias("x")) for s, t in enumerate(turned)])).alias("s"))
               .select("block", "s.sub", F.shiftrightunsigned("s.x", 36).alias("head"), "s.x"))
    groups = calm.unionByName(crowded).repartition(shuffle_partitions(spark), "block", "sub", "head").sortWithinPartitions("block", "sub", "head")

    def back(x: np.ndarray, block: np.ndarray, sub: np.ndarray) -> np.ndarray:
        """The fingerprint again: both turns undone."""
        low, k = x & np.uint64((1 << 48) - 1), np.uint64(12) * np.maximum(sub, 0).astype(np.uint64)
        turn = ((low >> k) | (low << (np.uint64(48) - k) % np.uint64(64))) & np.uint64((1 << 48) - 1)
        x = np.where(k > 0, (x & ~np.uint64((1 << 48) - 1)) | turn, x)
        k = np.uint64(16) * block.astype(np.uint64)
        return np.where(k > 0, (x >> k) | (x << (np.uint64(64) - k) % np.uint64(64)), x)

    def solve(parts: list[pd.DataFrame]) -> pd.DataFrame:
        g = pd.concat(parts, ignore_index=True)
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for (block, sub), one in g.groupby(["block", "sub"], sort=False):
            depth = 16 if sub < 0 else 28
            x = np.unique(one["x"].to_numpy().astype(np.int64).view(np.uint64))
            head = x >> np.uint64(64 - depth)
            roots = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1])))
            size = np.diff(np.append(roots, len(x)))
            use = np.repeat(size > 1, size)
            x = x[use]
            if not len(x):
                continue
            head = x >> np.uint64(64 - depth)
            roots = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1])))
            label = trie_links(x, roots, depth, max_bits)
            moved = label != np.arange(len(x))
            b, s = np.full(moved.sum(), block), np.full(moved.sum(), sub)
            ends = [back(y, b, s).view(np.int64) for y in (x[moved], x[label[moved]])]
            out[0].append(np.maximum(*ends))
            out[1].append(np.minimum(*ends))
        return pd.DataFrame({"u": np.concatenate(out[0]), "v": np.concatenate(out[1])})

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for b in batches:
            if len(b):  # the last group may go on in the next batch
                tail = b[["block", "sub", "head"]].to_numpy()
                same = (tail == tail[-1]).all(axis=1)
                cut = len(b) - int(np.argmin(same[::-1])) if not same.all() else 0
                held.append(b.iloc[:cut])
                if cut and sum(map(len, held)) > 50_000:
                    yield solve(held)
                    held = []
                held.append(b.iloc[cut:])
        if held:
            yield solve(held)

    return groups.mapInPandas(join, "u long, v long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(u, root)``: the least member of every linked value's component, by
    large-star and small-star rounds; each round is written to the shared folder."""
    e = keep(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    mark = lambda d: d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = mark(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        star = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        small = star.join(low, "u").select("u", "v", "m")
        e = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s")).select("s.*").filter("u <> v").distinct()
        e = keep(e, "links")
        now = mark(e)
        if now == seen:
            break
        seen = now
    return e.select("u", F.col("v").alias("root"))


def _linked(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, th, fp, least`` for every row: the text's hash, the fingerprint, and of
    its component the least (id is null, id, text hash)."""
    th = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    fp = keep(docs.select(F.col(id_col).cast("long").alias("doc_id"), th.alias("th"), fingerprint_column(text_col, shingle).alias("fp")), "fingerprints")
    classes = keep(fp.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("least")), "classes")
    root = components(near_links(classes.select("fp"), max_bits))
    member = classes.join(root.withColumnRenamed("u", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("least").alias("least"))
    return fp.join(member.select("fp", "root").join(least, "root").select("fp", "least"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Equal fingerprints are one trie leaf; only distinct ones are joined.
    ``component_id`` is the least doc_id reachable over links of ``max_bits`` or
    fewer bits.  Null and empty texts have fingerprint zero and link like any
    other.  Repeated rows are rows of one component.  A null id takes part in
    links but is nobody's ``component_id`` unless all ids of the component are
    null.  Empty table: no rows.  Other columns are not read."""
    return _linked(docs, shingle, max_bits, id_col, text_col).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``docs``, unchanged: that of the least (id, text
    hash), rows without an id last.  Other texts of one id are documents of their own;
    of rows that repeat id and text the one with the least other columns stays."""
    at = F.col("least")
    first = _linked(docs, shingle, max_bits, id_col, text_col).filter(F.col("doc_id").eqNullSafe(at["doc_id"]) & (F.col("th") == at["th"]))
    first = keep(first.select(F.col("doc_id").alias("__first"), F.col("th").alias("__th")).distinct(), "first")
    named = docs.withColumn("__id", F.col(id_col).cast("long")).withColumn("__key", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    named = named.join(first, named["__id"].eqNullSafe(first["__first"]) & (named["__key"] == first["__th"]), "left_semi")
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]))
    one = named.groupBy("__id", "__key").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), rest).alias("__row"))
    return one.select(*[F.col("__row")[c].alias(c) for c in docs.columns])


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
