"""Substring dedup over bytes: merged Burrows-Wheeler transforms of shards."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import table, with_row_key
from postlens.llm.repeats import _BASES, CROWD, Hashes, covered, cut, repeated_spans

WINDOW, GRAM = 200, 50
SHARDS, WIDEST = 4, 32

_VALUE = np.random.Generator(np.random.Philox(key=[5, 7])).integers(1, 1 << 63, 256, dtype=np.uint64)


def byte_symbols(text: bytes) -> np.ndarray:
    return _VALUE[np.frombuffer(text, np.uint8)]


def byte_parts(text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
    return [text[a:b] for a, b in spans]


def _letters(data: np.ndarray, ends: np.ndarray, q: int) -> np.ndarray:
    """The letter at every position: the q bytes from there, as a dense number from
    1; 0 is the end mark, where fewer than q bytes are left."""
    at = np.flatnonzero(np.arange(len(data)) + q <= ends)
    h = Hashes(_VALUE[data], _BASES[1])
    letter = np.zeros(len(data), np.int64)
    letter[at] = np.unique(h.of(at, at + q), return_inverse=True)[1] + 1
    return letter


def shard_suffixes(letter: np.ndarray, ends: np.ndarray, q: int, lo: int, hi: int) -> np.ndarray:
    """The positions lo to hi in suffix order: a context is q interleaved
    strings, each q positions a letter; end marks come first, in string order."""
    x, pos = letter[lo:hi], np.arange(lo, hi)
    marks = x == 0
    rank = np.where(marks, np.cumsum(marks), x + marks.sum())
    step = q
    while True:
        nxt = pos + step
        ok = nxt <= ends[lo:hi]
        second = np.zeros(len(x), np.int64)
        second[ok] = rank[nxt[ok] - lo]
        rank = np.unique(rank * (int(second.max()) + 1) + second, return_inverse=True)[1] + 1
        if rank.max() == len(x) or not ok.any():
            break
        step *= 2
    return np.argsort(rank, kind="stable") + lo


def repeated_intervals(contexts: list[bytes], times: np.ndarray, window: int) -> list[np.ndarray]:
    """Window starts of every context that occur twice in the collection.

    The contexts are dealt into shards, each shard's BWT is built alone, and the
    merged order follows by interleave refinement: Z says which shard the next
    suffix comes from; reading the shards' BWTs along Z and dealing the slots
    stably by what is read refines Z by one more letter.  Slots that differ in
    their letter or stood in different blocks before are parted there, which is the
    common prefix length; blocks of two or more after window / q rounds are the
    repeated intervals.  A letter is q bytes, q the greatest divisor of the window
    up to 32, so that eight rounds do for 200 bytes."""
    q = max(d for d in range(1, WIDEST + 1) if window % d == 0)
    size = np.array([len(c) + 1 for c in contexts])
    data = np.frombuffer(b"".join(c + b"\0" for c in contexts), np.uint8)  # a place for the last end mark
    first = np.cumsum(size) - size
    begin, ends = np.repeat(first, size), np.repeat(first + size - 1, size)
    letter = _letters(data, ends, q)
    edges = first[np.linspace(0, len(first), min(SHARDS, len(first)) + 1).astype(int)[:-1]]
    edges = np.append(edges, len(data))
    suffix, before, shard, marks = [], [], [], []
    for s, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        sa = shard_suffixes(letter, ends, q, lo, hi)
        suffix.append(sa)
        before.append(np.where(sa - q >= begin[sa], letter[np.maximum(sa - q, 0)], 0))
        shard.append(np.full(len(sa), s, np.uint8))
        marks.append(np.full(int((letter[lo:hi] == 0).sum()), s, np.uint8))
    suffix, before, z, marks = (np.concatenate(x) for x in (suffix, before, shard, marks))
    before = before.astype(np.uint16 if letter.max() < 1 << 16 else np.int64)  # 16 bits sort by counting
    block = np.zeros(len(z), np.int64)
    for _ in range(window // q):
        slot = np.argsort(z, kind="stable")
        read = np.empty_like(before)
        read[slot] = before
        moved = np.flatnonzero(read)
        moved = moved[np.argsort(read[moved], kind="stable")]
        part = np.ones(len(z), bool)
        part[1:len(marks)] = False
        r, b = read[moved], block[moved]
        part[len(marks) + 1:] = (r[1:] != r[:-1]) | (b[1:] != b[:-1])
        z = np.concatenate((marks, z[moved]))
        block = np.cumsum(part) - 1
    at = np.empty(len(z), np.int64)
    at[np.argsort(z, kind="stable")] = suffix
    whole = at + window <= ends[at]
    owner = np.repeat(np.arange(len(size)), size)
    often = np.bincount(block[whole], weights=times[owner[at[whole]]], minlength=int(block.max()) + 1) > 1
    starts = np.sort(at[whole][often[block[whole]]])
    return [x - f for x, f in zip(np.split(starts, np.searchsorted(starts, first[1:])), first)]


def _digest(text: bytes, spans):
    gone = covered(len(text), spans)
    if not gone.any():
        return len(text), 0, 0, text
    begins = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(text), int(gone.sum()), begins, np.frombuffer(text, np.uint8)[~gone].tobytes()


def dedup_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every row of ``docs``: bytes
    covered by a string of ``window`` bytes that also starts anywhere else, in this
    text or another, are gone; ``kept`` holds the others, ``n_spans`` is the number
    of removed runs.

    The collection is partitioned by the window's anchor gram (see ``repeats``); in
    each partition shard BWTs are merged, in one task, in memory.

    Null texts are empty.  Repeated rows, with or without an id, are copies of each
    other.  Cutting may split a UTF-8 character, so ``kept`` is binary.  Empty
    table: no rows.  Other columns are not read."""
    d = with_row_key(docs, id_col, text_col)
    spans = repeated_spans(d, window, gram, byte_symbols, byte_parts, repeated_intervals, crowd, "strings")
    return cut(d, spans, _digest, "n_bytes long, n_removed long, n_spans long, kept binary")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
