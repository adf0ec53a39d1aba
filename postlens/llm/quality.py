"""Document quality: a linear-chain CRF labels every line good or bad."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import bounded_sample, table

#: Labelled documents the model is fitted on (a hash sample of that size, twice at
#: most; whole texts of no more than MAX_LINES lines in all), and steps of the optimiser.
MAX_DOCS, MAX_LINES, STEPS, L2 = 3000, 300_000, 150, 1e-3
THRESHOLD, FOLDS = 0.3, 5
CHUNK_BYTES = 1 << 21
#: Byte classes of a line.
KINDS = ("lower", "upper", "digit", "blank", "plain mark", "!", "|", "other mark", "lead byte", "other")
OWN = len(KINDS) + 5


def _byte_kinds() -> np.ndarray:
    k = np.full(256, 9, np.int64)
    k[ord("a"):ord("z") + 1], k[ord("A"):ord("Z") + 1], k[ord("0"):ord("9") + 1] = 0, 1, 2
    k[[32, 9]] = 3
    k[33:127][[chr(c).isalnum() is False for c in range(33, 127)]] = 7
    k[[ord(c) for c in ".,;:'\"()?-"]] = 4
    k[ord("!")], k[ord("|")] = 5, 6
    k[0xC0:] = 8
    return k


KIND = _byte_kinds()


_rng = np.random.Generator(np.random.Philox(key=[3, 8]))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_TURN = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def repeated_words(buf: np.ndarray, line: np.ndarray, n: int) -> np.ndarray:
    """Per line the share of its words that equal the word before them."""
    gap = (buf == 32) | (buf == 9) | (buf == 10)
    begin = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    if not len(begin):
        return np.zeros(n)
    inside = np.arange(begin[0], len(buf)) - np.repeat(begin, np.diff(np.append(begin, len(buf))))
    value = _BYTE[buf]
    value[begin[0]:] *= _TURN[inside & 63]
    value[gap] = 0
    word = np.add.reduceat(value, begin)
    at = line[begin]
    same = np.concatenate(([False], (word[1:] == word[:-1]) & (at[1:] == at[:-1])))
    return np.bincount(at[same], minlength=n) / np.maximum(np.bincount(at, minlength=n), 1)


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of texts: features of every line (its own, the previous and the
    next line's, zeros beyond the text's ends), line lengths in bytes, lines per
    text.  A line ends at each newline; an empty text is one empty line."""
    counts = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    stop = buf == 10
    line = np.cumsum(stop) - stop
    n = int(counts.sum())
    table_ = np.bincount((line * len(KINDS) + KIND[buf])[~stop], minlength=n * len(KINDS)).reshape(n, len(KINDS)).astype(np.float64)
    size = table_.sum(axis=1)
    den = np.maximum(size, 1)
    words = table_[:, 3] + 1
    own = np.column_stack([table_ / den[:, None], np.log1p(size) / 8, np.minimum(den / words, 30) / 10, size == 0, size < 20, repeated_words(buf, line, n)])
    first = np.zeros(n, bool)
    first[np.cumsum(counts)[:-1]] = True
    first[0] = True
    prev = np.vstack([np.zeros((1, OWN)), own[:-1]])
    prev[first] = 0
    last = np.append(first[1:], True)
    after = np.vstack([own[1:], np.zeros((1, OWN))])
    after[last] = 0
    return np.column_stack([own, prev, after, first, last, np.ones(n)]), size, counts


@dataclass
class Chain:
    """``unary``: weights of the label good against bad; ``pair``: 2 x 2 scores of
    a line's label given the one before.  ``prior``: used where nothing was learnt."""

    unary: np.ndarray | None
    pair: np.ndarray
    prior: float


def marginals(score: np.ndarray, counts: np.ndarray, pair: np.ndarray, edges: bool = False):
    """P(good) of every line by forward-backward; with ``edges`` also the log
    partition sums and the summed expected transitions.  Texts run side by side,
    longest first, so step t touches the texts that have a line t."""
    order = np.argsort(-counts, kind="stable")
    start = (np.cumsum(counts) - counts)[order]
    length = counts[order]
    fwd, bwd = np.zeros((len(score), 2)), np.zeros((len(score), 2))
    fwd[start, 1] = score[start]
    alive = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")  # texts with more than t lines
    for t in range(1, int(length[0])):
        at = start[:alive[t]] + t
        p = fwd[at - 1]
        fwd[at, 0] = np.logaddexp(p[:, 0] + pair[0, 0], p[:, 1] + pair[1, 0])
        fwd[at, 1] = np.logaddexp(p[:, 0] + pair[0, 1], p[:, 1] + pair[1, 1]) + score[at]
    for t in range(int(length[0]) - 1, 0, -1):
        at = start[:alive[t]] + t
        b0, b1 = bwd[at, 0], bwd[at, 1] + score[at]
        bwd[at - 1, 0] = np.logaddexp(pair[0, 0] + b0, pair[0, 1] + b1)
        bwd[at - 1, 1] = np.logaddexp(pair[1, 0] + b0, pair[1, 1] + b1)
    both = fwd + bwd
    z = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - z)
    if not edges:
        return good
    inner = np.ones(len(score), bool)
    inner[start] = False
    at = np.flatnonzero(inner)
    expect = np.array([[np.exp(fwd[at - 1, a] + pair[a, b] + bwd[at, b] + b * score[at] - z[at]).sum() for b in (0, 1)] for a in (0, 1)])
    return good, z[start].sum(), expect


def fit(x: np.ndarray, counts: np.ndarray, y: np.ndarray, steps: int = STEPS, l2: float = L2) -> Chain:
    """Maximum likelihood of a text's label on all of its lines, by Adam over
    features scaled to unit deviation."""
    labels = np.unique(y)
    if len(labels) < 2:
        return Chain(None, np.zeros((2, 2)), float((y.sum() + 1) / (len(y) + 2)))
    scale = x.std(axis=0)
    scale[scale == 0] = 1
    x = x / scale
    line_y = np.repeat(y, counts)
    rng_n = len(y)
    inner = np.ones(len(x), bool)
    inner[np.cumsum(counts) - counts] = False
    seen = np.array([[np.sum(inner & (line_y == a)) if a == b else 0 for b in (0, 1)] for a in (0, 1)], float)
    w, pair = np.zeros(x.shape[1]), np.zeros((2, 2))
    m = [np.zeros_like(w), np.zeros_like(pair)]
    v = [np.zeros_like(w), np.zeros_like(pair)]
    for step in range(1, steps + 1):
        good, _, expect = marginals(x @ w, counts, pair, edges=True)
        grads = [(x.T @ (line_y - good)) / rng_n - l2 * w, (seen - expect) / rng_n - l2 * pair]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            move = 0.1 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
            if i:
                pair = pair + move
            else:
                w = w + move
    return Chain(w / scale, pair, 0.5)


def score_texts(texts: list[bytes], model: Chain) -> np.ndarray:
    """Length-weighted mean of the lines' P(good), empty lines weighing one byte."""
    if model.unary is None:
        return np.full(len(texts), model.prior)
    x, size, counts = line_features(texts)
    good = marginals(x @ model.unary, counts, model.pair)
    at = np.cumsum(counts) - counts
    weight = np.maximum(size, 1)
    return np.clip(np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at), 0, 1)


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size > limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def score_column(model: Chain, text_col: str = "text") -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            done = [score_texts(c, model) for c in chunks([t or b"" for t in texts])]
            yield pd.Series(np.concatenate(done) if done else [], dtype="float64")

    return score(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


def held_out(id_col: str = "doc_id", folds: int = FOLDS, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_docs: int = MAX_DOCS, max_lines: int = MAX_LINES,
          id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fit on a bounded hash sample of the labelled rows outside the held-out fold.
    Only line features of whole texts travel to the driver; the sample's documents are
    taken in the order of their hashes, one that would bring its lines above
    ``max_lines`` is left out.  A doc_id with several labels counts with the least; null
    labels are left out.  No labelled rows: every score is 0.5."""
    lab = labels.filter(~held_out(id_col) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    lab = lab.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_y"))
    lab = bounded_sample(lab, F.col("_id"), max_docs)
    d = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    d = d.join(F.broadcast(lab), "_id").select("_id", "_y", "t")  # at most 2 * max_docs small rows
    sizes = d.groupBy("_id").agg(F.sum(F.regexp_count(F.col("t").cast("string"), F.lit("\n")) + 1).alias("n")).orderBy(F.xxhash64("_id"), "_id").collect()
    total, left_out = 0, []
    for r in sizes:
        if total + r["n"] > max_lines:
            left_out.append(r["_id"])
        else:
            total += r["n"]
    if left_out:
        d = d.filter(~F.col("_id").isin(left_out))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, y, t in zip(b["_id"], b["_y"], b["t"]):
                x, _, _ = line_features([t])
                yield pd.DataFrame({"_id": [i], "y": [int(y)], "x": [x.astype("<f4").tobytes()]})

    got = d.mapInPandas(features, "_id long, y int, x binary").collect()
    got.sort(key=lambda r: (r["_id"], bytes(r["x"])))
    if not got:
        return Chain(None, np.zeros((2, 2)), 0.5)
    xs = [np.frombuffer(r["x"], "<f4").reshape(-1, 3 * OWN + 3) for r in got]
    return fit(np.concatenate(xs).astype(float), np.array([len(x) for x in xs]), np.array([r["y"] for r in got], float))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    The score depends on the text alone.  Null text: as empty, one empty line.
    Null id: not held out, never learnt from.  Repeated rows: one result each.
    Empty table: no rows.  Other columns are not read."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), score_column(model, text_col).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose score reaches ``threshold``."""
    return docs.filter(score_column(train(docs, labels, id_col=id_col, text_col=text_col), text_col) >= threshold)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
