"""Substring dedup over words: prefix-partitioned suffix trees."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import table, with_row_key
from postlens.llm.repeats import CROWD, covered, cut, mix, repeated_spans

WINDOW, PREFIX = 35, 9


def word_symbols(text: bytes) -> np.ndarray:
    words = text.split()  # bytes: ASCII white space only
    return mix(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))


def word_parts(text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
    words = text.split()
    return [b" ".join(words[a:b]) for a, b in spans]


def deep_nodes(contexts: list[bytes], times: np.ndarray, window: int) -> list[np.ndarray]:
    """The suffix tree of the contexts' words down to depth ``window``, level by
    level: a level's nodes are the classes of suffixes that agree that far, and a
    node of twice the depth is a pair of nodes.  Nodes at the last level with two
    leaves or more, a leaf counting as often as its context occurs, are the deep
    internal ones; returned are the leaves below them, by context."""
    words = [c.split() for c in contexts]
    size = np.array([len(w) for w in words])
    node = pd.factorize(np.array([w for ws in words for w in ws], dtype=object))[0].astype(np.int64)
    depth = 1
    while depth < window:
        step = min(depth, window - depth)  # the last level overlaps
        pair = node[:len(node) - step] * (node.max() + 1) + node[step:]
        node, depth = pd.factorize(pair)[0].astype(np.int64), depth + step
    first = np.cumsum(size) - size
    leaf = np.concatenate([np.arange(f, f + n - window + 1) for f, n in zip(first, size)])
    owner = np.repeat(np.arange(len(size)), size - window + 1)
    deep = np.bincount(node[leaf], weights=times[owner])[node[leaf]] > 1
    return [x - f for x, f in zip(np.split(leaf[deep], np.cumsum(np.bincount(owner[deep], minlength=len(size)))[:-1]), first)]


def _digest(text: bytes, spans):
    words = text.split()
    gone = covered(len(words), spans)
    return len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone) if not g) if gone.any() else b" ".join(words)


def dedup_passages(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the words left, joined by one space) for
    every row of ``docs``: words covered by a window of ``window`` words that also
    starts anywhere else, in this text or another, are gone.

    Suffixes are partitioned by variable-length prefixes.  Of the suffixes that a
    window offers only the one with the least prefix hash is planted, so a window
    is looked for in one subtree; a prefix met once has no subtree; a crowded one
    is lengthened to the whole window.  A subtree is built in one task, in memory.

    Null and empty texts have no words.  Repeated rows, with or without an id, are
    copies of each other.  Empty table: no rows.  Other columns are not read."""
    d = with_row_key(docs, id_col, text_col)
    spans = repeated_spans(d, window, prefix, word_symbols, word_parts, deep_nodes, crowd, "passages")
    return cut(d, spans, _digest, "n_words long, n_removed long, kept binary")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
