"""Trees grown level by level: extremely randomised trees and second-order boosting.

A level of all trees (or of one boosted tree) is one or two passes over the rows: tasks
walk the trees grown so far, sum what the open nodes ask for into one array, and the
arrays meet in a few partial sums before the driver reads one of them.  The driver
holds boosted trees; those of a forest stay in a table (:class:`Forest`), as unlimited
depth makes them as large as the rows.  Rows stay in the tasks."""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Partial sums that reach the driver; rows of a partition at least.
FAN, LOCAL_ROWS = 16, 50_000

#: Numbers a table has at most of which a task grows whole trees: 512 MB as float64, half of it as float32.
WHOLE = 1 << 26


def uniform(*what) -> float:
    """A number in [0, 1) by md5 of its arguments."""
    return int.from_bytes(md5(":".join(map(str, what)).encode()).digest()[:6], "big") / 2.0 ** 48


@dataclass
class Tree:
    """Nodes by number: feature (-1: a leaf), cut (x <= cut goes left), children, value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: float, values: tuple[float, float]) -> tuple[int, int]:
        kids = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, *kids
        for v in values:
            for column, empty in ((self.feature, -1), (self.cut, 0.0), (self.left, 0), (self.right, 0), (self.value, v)):
                column.append(empty)
        return kids

    def walk(self, x: np.ndarray, which: np.ndarray | None = None, at: np.ndarray | None = None) -> np.ndarray:
        """The node where each row stands; of the rows ``which`` only, on from the nodes ``at``."""
        feature, cut, left, right = (np.array(c) for c in (self.feature, self.cut, self.left, self.right))
        which = np.arange(len(x)) if which is None else which
        at = np.zeros(len(which), np.int64) if at is None else at.copy()
        rows = np.flatnonzero(feature[at] >= 0)
        while len(rows):
            f = feature[at[rows]]
            go = x[which[rows], f] <= cut[at[rows]]
            at[rows] = np.where(go, left[at[rows]], right[at[rows]])
            rows = rows[feature[at[rows]] >= 0]
        return at


def _arrays(b: pd.DataFrame) -> dict[str, np.ndarray]:
    return {"x": np.stack(b["x"].to_numpy()), "y": b["y"].to_numpy(float), "wt": b["wt"].to_numpy(float), "held": b["held"].to_numpy(bool), "rid": b["rid"].to_numpy(np.int64)}


def _single(x: np.ndarray) -> np.ndarray:
    """As float32 where no value changes."""
    with np.errstate(over="ignore"):
        y = x.astype(np.float32)
    return y if (y == x).all() else x


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows as blocks of plain bytes, a block a batch."""
    for b in batches:
        if len(b):
            yield pd.DataFrame({k: [v.tobytes()] for k, v in _arrays(b).items()})


def _unpacked(blocks: pd.DataFrame) -> dict[str, np.ndarray]:
    r = {k: np.concatenate([np.frombuffer(v, kind) for v in blocks[k]]) for k, kind in _KINDS.items() if k in blocks}
    n = len(r["rid"])
    return r | {"x": np.concatenate([np.frombuffer(v, np.float64 if "margin" not in blocks else np.uint16).reshape(len(rid) // 8, -1) for v, rid in zip(blocks["x"], blocks["rid"])]).reshape(n, -1)}


_KINDS = {"y": np.float64, "wt": np.float64, "held": np.bool_, "rid": np.int64, "margin": np.float64}
_BLOCK = "x binary, y binary, wt binary, held binary, rid binary"


class Rows:
    """``x, y, wt, rid`` of a table, dealt by id and cached, in several partitions as
    packed blocks; rows with a null or NaN feature, a null label or weight are left out."""

    def __init__(self, df: DataFrame, features_col: str, label_col: str, weight_col: str | None, held_col: str | None):
        rid = F.xxhash64("id") if "id" in df.columns else F.xxhash64(features_col)
        rows = df.select(F.col(features_col).cast("array<double>").alias("x"), F.col(label_col).cast("double").alias("y"), (F.col(weight_col) if weight_col else F.lit(1.0)).cast("double").alias("wt"),
                         (F.coalesce(F.col(held_col), F.lit(False)) if held_col else F.lit(False)).alias("held"), rid.alias("rid"))
        rows = rows.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("wt").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
        self.rows = n = rows.count()
        self.partitions = max(1, min(df.sparkSession.sparkContext.defaultParallelism * 4, n // LOCAL_ROWS))
        self.base = rows.repartition(self.partitions, "rid").sortWithinPartitions("rid").persist()
        self.blocks = self.base.mapInPandas(_packed, _BLOCK).persist() if self.partitions > 1 else None
        self.binned: tuple[int, DataFrame] | None = None

    def free(self) -> None:
        for held in (self.base, self.blocks, self.binned and self.binned[1]):
            if held is not None:
                held.unpersist()

    def apart(self, fit: Callable[[dict, int], Iterator[pd.DataFrame]], copies: int, schema: str) -> DataFrame:
        """What ``fit(rows, copy)`` gives, a task for each copy of all rows, which are dealt in
        packed blocks, their features in float32 where that holds them."""

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    r = _arrays(b)
                    yield pd.DataFrame({"first": r["rid"][:1], "x": [_single(r["x"]).tobytes()]} | {k: [r[k].tobytes()] for k in ("y", "wt", "rid")})

        def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = list(batches)
            for g, b in pd.concat(held).sort_values("first", kind="stable").groupby("g") if held else ():
                r = {k: np.concatenate([np.frombuffer(v, _KINDS[k]) for v in b[k]]) for k in ("y", "wt", "rid")}
                x = [np.frombuffer(v, np.float32 if 4 * dim * len(rid) // 8 == len(v) else np.float64).reshape(-1, dim) for v, rid in zip(b["x"], b["rid"])]
                held = b = None  # the blocks go before the trees come
                yield from fit(r | {"x": np.concatenate(x)}, int(g))

        dim = (self.base.filter(F.size("x") > 0).select(F.size("x")).first() or [1])[0]
        blocks = self.base.mapInPandas(pack, "first long, x binary, y binary, wt binary, rid binary")
        return blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).repartitionById(copies, "g").mapInPandas(local, schema)

    def alone(self, fit: Callable[[Callable, int], object], copies: int = 1, ready: Callable[[dict], dict] = dict) -> list:
        """``fit(total, copy)`` in one task per copy, for a table of one partition: the same
        passes, without a job for each, over what ``ready`` makes of the rows."""
        rows = self.base.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).repartitionById(copies, "g")

        def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = list(batches)
            for g, b in pd.concat(held).sort_values("rid", kind="stable").groupby("g") if held else ():
                r = ready(_arrays(b))
                yield pd.DataFrame({"g": [int(g)], "v": [pickle.dumps(fit(lambda of, meet=None, r=r: np.ascontiguousarray(of(r), float), int(g)))]})

        return [pickle.loads(r["v"]) for r in rows.mapInPandas(local, "g int, v binary").orderBy("g").collect()]

    def keep(self, version: int, ready: Callable[[dict], dict]) -> None:
        """From now on ``total`` passes over what ``ready`` makes of the rows, with a margin;
        cached in place of an earlier ``version``."""
        if self.binned and self.binned[0] == version:
            return
        old = self.binned

        def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for i in range(len(b)):
                    yield pd.DataFrame({k: [np.ascontiguousarray(v).tobytes()] for k, v in ready(_unpacked(b.iloc[i:i + 1])).items()})

        self.binned = version, self.blocks.mapInPandas(local, _BLOCK + ", margin binary").persist()
        if old:
            old[1].unpersist()

    def total(self, of: Callable[[dict], np.ndarray], meet=np.add) -> np.ndarray | None:
        """``meet`` over all partitions of the array ``of`` gives for one's rows."""
        packed = self.partitions > 1

        def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = list(batches)
            if held and sum(map(len, held)):
                b = pd.concat(held)
                got = of(_unpacked(b) if packed else _arrays(b))
                yield pd.DataFrame({"r": [TaskContext.get().partitionId() % FAN], "v": [np.ascontiguousarray(got, float).tobytes()]})

        got = (self.base if not packed else self.binned[1] if self.binned else self.blocks).mapInPandas(local, "r int, v binary")
        if self.partitions > FAN:
            got = got.groupBy("r").applyInPandas(lambda b: pd.DataFrame({"r": b["r"][:1], "v": [meet.reduce([np.frombuffer(v) for v in b["v"]]).tobytes()]}), "r int, v binary")
        parts = [np.frombuffer(r["v"]) for r in sorted(got.collect(), key=lambda r: r["r"])]
        return meet.reduce(parts) if parts else None


# -------------------------------------------------------------- extremely randomised trees
_NODES = {"feature": np.int32, "cut": np.float64, "left": np.int32, "right": np.int32, "value": np.float64}
_TREE = ", ".join(f"{c} binary" for c in _NODES)


@dataclass(eq=False)
class Forest(Sequence):
    """Trees in a cached table, a row each; the driver sees one when it asks for it.  A tree
    without a row is a leaf of one half."""

    table: DataFrame
    n_trees: int

    def __len__(self) -> int:
        return self.n_trees

    def __getitem__(self, i):
        if isinstance(i, slice):
            return [self[j] for j in range(*i.indices(self.n_trees))]
        i = range(self.n_trees)[i]
        row = self.table.filter(F.col("t") == i).first()
        return Tree(**{c: np.frombuffer(row[c], kind).tolist() for c, kind in _NODES.items()}) if row else Tree(value=[0.5])

    def __eq__(self, other) -> bool:
        return isinstance(other, Sequence) and len(self) == len(other) and all(a == b for a, b in zip(self, other))


def gini_gain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of class weights (..., 2) on both sides, what is to be made as large as possible."""
    side = lambda s: np.divide((s ** 2).sum(-1), s.sum(-1), out=np.zeros(s.shape[:-1]), where=s.sum(-1) > 0)
    return side(left) + side(right)


_SHIFT = np.array([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]])
_SINE = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0 ** 32).astype(np.uint32)


def _md5_uniform(text: np.ndarray) -> np.ndarray:
    """:func:`uniform` of texts of one length, rows of bytes: md5 of all of them at once."""
    n, size = text.shape
    blocks = np.zeros((n, -(-(size + 9) // 64) * 64), np.uint8)
    blocks[:, :size], blocks[:, size] = text, 128
    blocks[:, -8:] = np.frombuffer((8 * size).to_bytes(8, "little"), np.uint8)
    out = np.zeros(n)
    for lo in range(0, n, 1 << 13):
        words = np.ascontiguousarray(blocks[lo:lo + (1 << 13)].view("<u4").T)
        held = [np.full(words.shape[1], v, np.uint32) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
        for at in range(0, len(words), 16):
            a, b, c, d = (h.copy() for h in held)
            for i in range(64):
                turn = i // 16
                if turn == 0:
                    f, g = d ^ (b & (c ^ d)), i
                elif turn == 1:
                    f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
                elif turn == 2:
                    f, g = b ^ c ^ d, (3 * i + 5) % 16
                else:
                    f, g = c ^ (b | ~d), 7 * i % 16
                f += a
                f += _SINE[i]
                f += words[at + g]
                left = np.uint32(_SHIFT[turn, i % 4])
                a = f << left
                a |= f >> np.uint32(32 - left)
                a += b
                a, b, c, d = d, a, b, c
            for h, v in zip(held, (a, b, c, d)):
                h += v
        high, low = held[0].byteswap().astype(np.uint64), held[1].byteswap() >> np.uint32(16)
        out[lo:lo + (1 << 13)] = (high << np.uint64(16) | low) / 2.0 ** 48
    return out


def node_uniform(seed: int, nodes: list[tuple[int, str]], features: np.ndarray, what: str) -> np.ndarray:
    """``uniform(seed, tree, path, f, what)`` of nodes (tree, path) by their own ``features``."""
    out = np.zeros(features.shape)
    heads = [f"{seed}:{t}:{path}:".encode() for t, path in nodes]
    size, digits = np.array([len(h) for h in heads], int), np.searchsorted(10 ** np.arange(1, 18), features, "right") + 1
    for length in np.unique(size):
        at = np.flatnonzero(size == length)
        head = np.frombuffer(b"".join(heads[i] for i in at), np.uint8).reshape(len(at), length)
        for many in np.unique(digits[at]):
            i, j = np.nonzero(digits[at] == many)
            f = features[at[i], j]
            tail = np.frombuffer(f":{what}".encode(), np.uint8)
            number = np.stack([f // 10 ** k % 10 for k in range(many - 1, -1, -1)], axis=1).astype(np.uint8) + np.uint8(48)
            out[at[i], j] = _md5_uniform(np.concatenate([head[i], number, np.broadcast_to(tail, (len(i), len(tail)))], axis=1))
    return out


def candidates(seed: int, tree: int, path: str, dim: int, k: int) -> list[int]:
    """The features a node may split on: the first ``k`` by hash, in ascending order."""
    return _candidates(seed, [(tree, path)], dim, k)[0].tolist()


def _candidates(seed: int, nodes: list[tuple[int, str]], dim: int, k: int) -> np.ndarray:
    out = []
    for lo in range(0, len(nodes), 2048):  # dim hashes a node
        some = nodes[lo:lo + 2048]
        order = node_uniform(seed, some, np.broadcast_to(np.arange(dim), (len(some), dim)), "pick")
        out.append(np.sort(np.argsort(order, axis=1, kind="stable")[:, :k], axis=1))
    return np.concatenate(out)


def _by_node(place: np.ndarray, v: np.ndarray, n: int, how) -> np.ndarray:
    """``how`` (add, minimum, maximum) of the rows of ``v`` by node; ``place`` ascends."""
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, int)
    out = np.full((n, v.shape[1]), {np.add: 0.0, np.minimum: np.inf, np.maximum: -np.inf}[how])
    if len(first):
        out[place[first]] = how.reduceat(v, first)
    return out


def fit_extra_trees(df: DataFrame, dim: int, n_trees: int = 100, max_depth: int | None = None, min_split: float = 2, features: int | None = None, seed: int = 42,
                    features_col: str = "x", label_col: str = "label", weight_col: str | None = None) -> Sequence[Tree]:
    """Trees on all rows (no bootstrap): a node draws ``features`` (default: the root of
    ``dim``) of them by hash, for each one cut point, uniform by hash between its least
    and greatest value in the node, and takes the cut of least Gini impurity (ties: the
    lowest feature).  Pure nodes, nodes of less than ``min_split`` weight, nodes whose
    drawn features are constant and nodes at ``max_depth`` (None: unlimited) are leaves.
    A task grows some of the trees, one after the other, on a copy of the rows (of up to
    ``WHOLE`` numbers); more rows grow all trees at once, in two passes a level, held by the
    driver.  No rows: leaves of probability one half."""
    k = features or max(1, int(dim ** 0.5))
    data = Rows(df, features_col, label_col, weight_col, None)
    if data.rows * dim > WHOLE:
        trees = _grow(data.total, list(range(n_trees)), dim, k, max_depth, min_split, seed)
        data.free()
        return [trees.get(t, Tree(value=[0.5])) for t in range(n_trees)]
    copies = min(n_trees, df.sparkSession.sparkContext.defaultParallelism)

    def some(r: dict, g: int) -> Iterator[pd.DataFrame]:
        for t in range(g, n_trees, copies):
            r.pop("stand", None)
            tree = _grow(lambda of, meet=None: np.ascontiguousarray(of(r), float), [t], dim, k, max_depth, min_split, seed)[t]
            yield pd.DataFrame({"t": [t]} | {c: [np.array(getattr(tree, c), kind).tobytes()] for c, kind in _NODES.items()})

    forest = Forest(data.apart(some, copies, f"t int, {_TREE}").persist(), n_trees)
    forest.table.count()
    data.free()
    return forest


def _grow(total: Callable, numbers: list[int], dim: int, k: int, max_depth: int | None, min_split: float, seed: int) -> dict[int, Tree]:
    trees = {t: Tree(array("q", [-1]), array("d", [0.0]), array("q", [0]), array("q", [0]), array("d", [0.5])) for t in numbers}
    start = total(lambda r: np.array([(r["wt"] * (r["y"] <= 0)).sum(), (r["wt"] * (r["y"] > 0)).sum()]))
    grows = lambda c: c.min() > 0 and c.sum() >= min_split
    open_: list[tuple[int, int, str]] = []
    if start is not None:
        for t in trees.values():
            t.value[0] = float(start[1] / start.sum())
        open_ = [(t, 0, "") for t in numbers] if grows(start) else []
    depth = 0
    while open_ and (max_depth is None or depth < max_depth):
        names = [(t, path) for t, _, path in open_]
        drawn = _candidates(seed, names, dim, k)
        of_tree: dict[int, dict[int, int]] = {}
        for i, (t, node, _) in enumerate(open_):
            of_tree.setdefault(t, {})[node] = i
        now = {t: trees[t] for t in of_tree}

        span = {t: (min(nodes.values()), max(nodes.values()) + 1) for t, nodes in of_tree.items()}  # a tree's open nodes stand together

        def places(r, now=now, of_tree=of_tree, span=span) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
            """By tree: the numbers of its open nodes, of the rows that stand in one the node
            from the first on, and those rows.  Both are kept with the rows where these stay
            between passes, so that a row walks a step a level."""
            stand = r.setdefault("stand", {})
            for t, nodes in of_tree.items():
                rows, node = stand.get(t) or (np.arange(len(r["y"])), np.zeros(len(r["y"]), np.int64))
                node = now[t].walk(r["x"], rows, node)
                first, end = span[t]
                slot = np.full(len(now[t].feature), -1)
                slot[list(nodes)] = np.array(list(nodes.values())) - first
                place = slot[node]
                order = np.argsort(np.where(place < 0, end, place), kind="stable")[:np.count_nonzero(place >= 0)]
                rows, node = rows[order], node[order]
                stand[t] = rows, node
                yield first, end, place[order], rows

        def drawn_of(r, first, place, rows, drawn=drawn) -> np.ndarray:
            return r["x"].ravel().take(rows[:, None] * dim + drawn[first + place])

        def ranges(r, drawn=drawn, places=places, drawn_of=drawn_of):
            out = np.full((len(drawn), 2 * k), np.inf)
            for first, end, place, rows in places(r):
                v = drawn_of(r, first, place, rows)
                out[first:end] = _by_node(place, np.concatenate([v, -v], axis=1), end - first, np.minimum)
            return out.ravel()

        got = total(ranges, np.minimum).reshape(len(open_), 2 * k)
        lo, hi = got[:, :k], -got[:, k:]
        u = node_uniform(seed, names, drawn, "cut")
        cut = np.minimum(lo + u * (hi - lo), np.nextafter(hi, lo))

        def sides(r, drawn=drawn, places=places, cut=cut, drawn_of=drawn_of):
            out = np.zeros((len(drawn), 4 * k))
            exact = (r["wt"] == np.rint(r["wt"])).all() and r["wt"].sum() < 2 ** 53  # a side is what the other leaves
            for first, end, place, rows in places(r):
                go = drawn_of(r, first, place, rows) <= cut[first + place]
                up, wt = (r["y"][rows] > 0)[:, None], r["wt"][rows][:, None]
                low, high = wt * ~up, wt * up
                if exact:
                    got = _by_node(place, np.concatenate([low * go, high * go, low, high], axis=1), end - first, np.add)
                    out[first:end, :2 * k] = got[:, :2 * k]
                    out[first:end, 2 * k:] = np.repeat(got[:, 2 * k:], k, axis=1) - got[:, :2 * k]
                else:
                    out[first:end] = _by_node(place, np.concatenate([low * go, high * go, low * ~go, high * ~go], axis=1), end - first, np.add)
            return out.ravel()

        s = total(sides).reshape(len(open_), 2, 2, k).transpose(0, 3, 1, 2)  # node, feature, side, class
        gain = np.where(lo < hi, np.round(gini_gain(s[:, :, 0], s[:, :, 1]), 9), -1.0)
        best = gain.argmax(axis=1)
        after = []
        for i, (t, node, path) in enumerate(open_):
            j = best[i]
            if gain[i, j] < 0:
                continue
            left, right = s[i, j]
            kids = trees[t].split(node, int(drawn[i, j]), float(cut[i, j]), (float(left[1] / left.sum()), float(right[1] / right.sum())))
            after += [(t, kid, path + mark) for kid, mark, c in zip(kids, "LR", (left, right)) if grows(c)]
        open_, depth = after, depth + 1
    return {t: Tree(*(c.tolist() for c in (tree.feature, tree.cut, tree.left, tree.right, tree.value))) for t, tree in trees.items()}


def score_trees(trees: Sequence[Tree], df: DataFrame, features_col: str = "x", combine: str = "mean", start: float = 0.0, upto: list[int] | None = None) -> DataFrame:
    """``df`` with ``prob``: the mean of the trees' values, or (``sum``) the sigmoid of
    ``start`` plus their sum; with ``upto`` an array, one entry per number of trees.  A
    null vector or one that holds a null has no probability."""
    many = upto is not None
    ends = upto or [len(trees)]
    if isinstance(trees, Forest):
        return _score_forest(trees, df, features_col, combine, start, ends, many)

    @F.pandas_udf("array<double>")
    def apply(xs: pd.Series) -> pd.Series:
        out: list = [None] * len(xs)
        known = np.flatnonzero([x is not None and not any(v is None or v != v for v in x) for x in xs])
        if len(known):
            x = np.stack([np.asarray(xs.iloc[i], float) for i in known])
            total, got = np.full(len(x), start), {0: np.full(len(x), start)}
            for n, t in enumerate(trees, 1):
                total = total + np.array(t.value)[t.walk(x)]
                if n in ends:
                    got[n] = total
            p = np.stack([got[e] / max(e, 1) if combine == "mean" else 1 / (1 + np.exp(-got[e])) for e in ends], axis=1)
            for i, v in zip(known, p):
                out[i] = v.tolist()
        return pd.Series(out, dtype=object)

    return df.withColumn("prob", apply(F.col(features_col).cast("array<double>")) if many else apply(F.col(features_col).cast("array<double>"))[0])


def _score_forest(forest: Forest, df: DataFrame, features_col: str, combine: str, start: float, ends: list[int], many: bool) -> DataFrame:
    """The vectors go to the trees: each distinct one once to each task that holds some of
    them, which gives the sums of their values; these meet by the vector's hash."""
    x = F.col(features_col).cast("array<double>")
    key = [F.xxhash64(x).alias("_h"), F.xxhash64(F.lit(1), x).alias("_i")]
    known = F.when(x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v)), x)
    copies = min(forest.n_trees, df.sparkSession.sparkContext.defaultParallelism)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, c in b.groupby(b["x"].map(len)):
                yield pd.DataFrame({"h": [c["_h"].to_numpy(np.int64).tobytes()], "i": [c["_i"].to_numpy(np.int64).tobytes()], "x": [np.stack(c["x"].to_numpy()).astype(float).tobytes()]})

    def some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = []
        for b in batches:
            for r in b.itertuples(index=False):
                if r.x is None:
                    trees.append((r.t, Tree(**{c: np.frombuffer(getattr(r, c), kind) for c, kind in _NODES.items()})))
                    continue
                h, i = np.frombuffer(r.h, np.int64), np.frombuffer(r.i, np.int64)
                rows, got = np.frombuffer(r.x).reshape(len(h), -1), np.zeros((len(h), len(ends)))
                for t, tree in trees:
                    got += tree.value[tree.walk(rows)][:, None] * (t < np.array(ends))
                yield pd.DataFrame({"_h": h, "_i": i, "g": r.g, "v": got.tolist()})

    rows = df.select(*key, known.alias("x")).filter(F.col("x").isNotNull()).dropDuplicates(["_h", "_i"]).mapInPandas(pack, "h binary, i binary, x binary")
    rows = rows.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    ids = df.sparkSession.range(forest.n_trees).select(F.col("id").cast("int").alias("t"))
    leaf = {c: F.lit(np.array(v, _NODES[c]).tobytes()) for c, v in Tree(value=[0.5]).__dict__.items()}  # of trees without a row
    trees = ids.join(forest.table, "t", "left").select((F.col("t") % copies).alias("g"), "t", *[F.coalesce(F.col(c), leaf[c]).alias(c) for c in _NODES])
    both = trees.unionByName(rows, allowMissingColumns=True).repartitionById(copies, "g").sortWithinPartitions(F.col("t").asc_nulls_last())
    sums = both.mapInPandas(some, "_h long, _i long, g int, v array<double>").groupBy("_h", "_i").agg(F.array_sort(F.collect_list(F.struct("g", "v"))).alias("v"))
    total = [F.aggregate(F.transform("v", lambda p: p["v"][e]), F.lit(float(start)), lambda s, v: s + v) for e in range(len(ends))]
    prob = [t / F.lit(float(max(e, 1))) if combine == "mean" else F.lit(1.0) / (F.lit(1.0) + F.exp(-t)) for t, e in zip(total, ends)]
    sums = sums.select("_h", "_i", (F.array(*prob) if many else prob[0]).alias("prob"))
    return df.drop("prob").select("*", *key).join(sums, ["_h", "_i"], "left").drop("_h", "_i")


# -------------------------------------------------------------- second-order boosting
@dataclass
class Boosted:
    trees: list[Tree]
    start: float
    losses: list[tuple[int, float, float | None]]  # trees, loss of the training rows, of the held rows
    best: int


def _row_uniform(rid: np.ndarray, seed: int, n: int) -> np.ndarray:
    """Of every row a number in [0, 1) that depends on its id, the seed and ``n`` only."""
    z = rid.view(np.uint64) ^ np.uint64(int(uniform(seed, n, "rows") * 2 ** 48) * 0x9E3779B97F4A7C15 % 2 ** 64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0 ** 53


def split_gains(g: np.ndarray, h: np.ndarray, penalty: float, min_weight: float) -> np.ndarray:
    """Of gradients and hessians summed by bin (last axis) the gain of a cut behind each
    bin: what the second-order loss falls by; minus infinity where a side is too light."""
    gl, hl = np.cumsum(g, -1), np.cumsum(h, -1)
    gt, ht = gl[..., -1:], hl[..., -1:]
    gr, hr = gt - gl, ht - hl
    gain = 0.5 * (gl ** 2 / (hl + penalty) + gr ** 2 / (hr + penalty) - gt ** 2 / (ht + penalty))
    return np.where((hl >= min_weight) & (hr >= min_weight), gain, -np.inf)


def fit_boosting(df: DataFrame, dim: int, n_iter: int = 100, rate: float = 0.1, max_depth: int = 6, subsample: float = 1.0, colsample: float = 1.0, penalty: float = 1.0,
                 gamma: float = 0.0, min_weight: float = 1.0, bins: int = 64, patience: int | None = None, seed: int = 42, features_col: str = "x", label_col: str = "label",
                 weight_col: str | None = None, held_col: str | None = None) -> Boosted:
    """Boosted trees on the logistic loss by gradients and hessians over ``bins``
    quantile bins a feature.  A tree sees ``subsample`` of the rows (by a hash of the
    id) and ``colsample`` of the features; a split must lower the loss by more than
    ``gamma`` and leave ``min_weight`` of hessian on both sides; leaves are
    -G / (H + ``penalty``) times ``rate``.  Rows where ``held_col`` is true train
    nothing; after every tree the loss of both kinds is kept.  With ``patience`` the
    fit ends when the held rows' loss has not fallen for so many trees; ``best`` is
    the number of trees of least held loss (all of them where nothing is held).
    One pass a level, the loss with the next tree's first one; in a table of one partition
    all of them in one task.  Rows hold the numbers of their bins and the margin
    of the trees grown, in several partitions up to ``KEEP`` trees ago, so a pass walks few trees."""
    data = Rows(df, features_col, label_col, weight_col, held_col)
    sums = data.total(lambda r: np.array([(r["wt"] * r["y"] * ~r["held"]).sum(), (r["wt"] * ~r["held"]).sum()]))
    if sums is None or sums[1] == 0:
        data.free()
        return Boosted([], 0.0, [], 0)
    p = min(max(sums[0] / sums[1], 1e-6), 1 - 1e-6)
    start = float(np.log(p / (1 - p)))
    # cut points: quantiles by Spark's sketch, the values of a feature at most
    flat = data.base.filter(~F.col("held")).select(*[F.col("x")[i].alias(f"f{i}") for i in range(dim)])
    found = flat.approxQuantile(flat.columns, [i / bins for i in range(1, bins)], 1.0 / (4 * bins))
    edges = [np.unique(q) for q in found]
    said = ([len(e) for e in edges], dim, n_iter, rate, max_depth, subsample, colsample, penalty, gamma, min_weight, bins, patience, seed)

    def ready(r: dict, trees: tuple[Tree, ...] = ()) -> dict:
        """Features as the numbers of their bins, and the margin of ``trees``, whose cuts
        are numbers of bins too: x <= edge b where the bin of x is b at most."""
        x = np.stack([np.searchsorted(e, r["x"][:, f]) for f, e in enumerate(edges)], axis=1).astype(np.uint16)
        return {"x": x, **{k: r[k] for k in ("y", "wt", "held", "rid")}, "margin": margin(x, trees, np.full(len(x), start))}

    if data.partitions > 1:
        out = _boost(data.total, lambda trees: data.keep(len(trees), lambda r: ready(r, trees)), start, *said)
    else:
        out = data.alone(lambda total, g: _boost(total, None, start, *said), ready=ready)[0]
    data.free()
    for tree in out.trees:
        tree.cut = [float(edges[f][int(c)]) if f >= 0 else c for f, c in zip(tree.feature, tree.cut)]
    return out


#: The margins are cached anew after so many trees.
KEEP = 5


def margin(x: np.ndarray, trees, m: np.ndarray) -> np.ndarray:
    for t in trees:
        m = m + np.array(t.value)[t.walk(x)]
    return m


def _boost(total: Callable, keep: Callable | None, start: float, n_edges: list[int], dim: int, n_iter: int, rate: float, max_depth: int, subsample: float, colsample: float, penalty: float,
           gamma: float, min_weight: float, bins: int, patience: int | None, seed: int) -> Boosted:
    trees: list[Tree] = []
    losses: list[tuple[int, float, float | None]] = []
    best, best_loss = 0, np.inf

    def loss_of(r, m):
        q = np.logaddexp(0, m) - r["y"] * m
        return [(r["wt"] * q * ~r["held"]).sum(), (r["wt"] * ~r["held"]).sum(), (r["wt"] * q * r["held"]).sum(), (r["wt"] * r["held"]).sum()]

    done, stay = 0, keep is None  # trees that the margin of the rows holds; one dict of rows for all passes
    for n in range(n_iter + 1):
        tree = Tree()
        if keep and n % KEEP == 0:
            keep(tuple(trees))
            done = n
        cols = sorted(sorted(range(dim), key=lambda f: (uniform(seed, n, f, "column"), f))[:max(1, round(colsample * dim))])
        open_ = [0]
        for depth in range(max_depth):
            def histogram(r, ts=tuple(trees[done:]), tree=tree, open_=tuple(open_), depth=depth):
                m = margin(r["x"], ts, r["margin"])
                if stay and len(ts):  # the rows stay: their margin moves on
                    r["margin"] = m
                told = loss_of(r, m) if depth == 0 else []
                if n == n_iter:
                    return np.array(told)
                use = np.flatnonzero(~r["held"] & (_row_uniform(r["rid"], seed, n) < subsample))
                slot = np.full(len(tree.feature), -1)
                slot[list(open_)] = np.arange(len(open_))
                place = slot[tree.walk(r["x"], use)]
                use, place = use[place >= 0], place[place >= 0] * bins
                q = 1 / (1 + np.exp(-m[use]))
                g, h = r["wt"][use] * (q - r["y"][use]), r["wt"][use] * q * (1 - q)
                x = r["x"][use]
                out = np.zeros((2, len(cols), len(open_), bins))
                for c, f in enumerate(cols):
                    at = place + x[:, f]
                    out[0, c] = np.bincount(at, g, len(open_) * bins).reshape(len(open_), bins)
                    out[1, c] = np.bincount(at, h, len(open_) * bins).reshape(len(open_), bins)
                return np.append(told, out)

            got = total(histogram)
            if stay:
                done = n
            if depth == 0:
                held_loss = got[2] / got[3] if got[3] > 0 else None
                losses.append((n, float(got[0] / got[1]), None if held_loss is None else float(held_loss)))
                if held_loss is None or held_loss < best_loss:
                    best, best_loss = n, np.inf if held_loss is None else held_loss
                if n == n_iter or patience is not None and n - best >= patience:
                    return Boosted(trees, start, losses, best)
                got = got[4:]
            g, h = got.reshape(2, len(cols), len(open_), bins).transpose(0, 2, 1, 3)
            gain = split_gains(g, h, penalty, min_weight)
            # a cut needs an edge behind its bin
            for c, f in enumerate(cols):
                gain[:, c, n_edges[f]:] = -np.inf
            after = []
            leaf = lambda a, b: float(-rate * a / (b + penalty))
            if depth == 0:
                tree.value[0] = leaf(g[0, 0].sum(), h[0, 0].sum())
            for i, node in enumerate(open_):
                c, b = divmod(int(np.round(gain[i], 9).argmax()), bins)
                if gain[i, c, b] > gamma:
                    values = leaf(g[i, c, :b + 1].sum(), h[i, c, :b + 1].sum()), leaf(g[i, c, b + 1:].sum(), h[i, c, b + 1:].sum())
                    after += tree.split(node, cols[c], float(b), values)
            open_ = after
            if not open_:
                break
        trees.append(tree)
    raise AssertionError("the last round returns")
