"""Language identification by hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import bounded_sample, table

DIM, GRAM, SEED = 1024, 3, 7
#: Labelled documents that the prototypes bundle (a hash sample of that size, twice at most).
MAX_DOCS = 10_000
FOLDS, HELD = 3, 1
CHUNK_CHARS, BLOCK = 1 << 20, 2048
NONE = "und"


@lru_cache(maxsize=1 << 14)
def letter_vector(code: int, dim: int = DIM) -> np.ndarray:
    """A letter's random vector of +1 and -1, the same on every machine; 0 stands
    for whatever is between words."""
    return np.random.Generator(np.random.Philox(key=[SEED, code])).integers(0, 2, dim, dtype=np.int8) * 2 - 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x10000)])


def letters_of(text: bytes) -> np.ndarray:
    """Code points of the lower-cased letters; each run of others is one 0, also
    at both ends.  Empty where the text has no letter."""
    cp = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if not len(cp):
        return cp
    is_letter = _letters()[np.minimum(cp, 0xFFFF)]
    far = np.flatnonzero(cp > 0xFFFF)
    if len(far):
        is_letter[far] = [chr(c).isalpha() for c in cp[far].tolist()]
    if not is_letter.any():
        return cp[:0]
    s = np.concatenate(([0], np.where(is_letter, cp, 0), [0]))
    return s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]


def bundles(texts: list[bytes], dim: int = DIM) -> np.ndarray:
    """One row a text: the sum over its trigrams abc of rho(rho(A) * B) * C, rho
    being a cyclic shift.  Equal trigrams are bound once and weighed by count."""
    runs = [letters_of(t) for t in texts]
    out = np.zeros((len(texts), dim), np.float32)
    size = np.array([max(0, len(r) - GRAM + 1) for r in runs])
    if not size.sum():
        return out
    alphabet, seq = np.unique(np.concatenate(runs), return_inverse=True)
    k = len(alphabet)
    at = np.concatenate([np.arange(n) + o for n, o in zip(size, np.cumsum([0, *map(len, runs[:-1])]))])
    gram = (seq[at] * k + seq[at + 1]) * k + seq[at + 2]
    if k ** 3 <= 1 << 24:
        present = np.flatnonzero(np.bincount(gram, minlength=1))
        place = np.zeros(present[-1] + 1, np.int64)
        place[present] = np.arange(len(present))
        column = place[gram]
    else:
        present, column = np.unique(gram, return_inverse=True)
    doc = np.repeat(np.arange(len(texts)), size)
    order = np.argsort(column, kind="stable") if len(present) > BLOCK else None
    if order is not None:
        column, doc = column[order], doc[order]
    base = np.stack([letter_vector(int(c), dim) for c in alphabet])
    once, twice = np.roll(base, 1, axis=1), np.roll(base, 2, axis=1)
    for lo in range(0, len(present), BLOCK):
        part = present[lo:lo + BLOCK]
        vec = twice[part // (k * k)] * once[part // k % k] * base[part % k]
        a, b = (0, len(column)) if order is None else np.searchsorted(column, (lo, lo + len(part)))
        count = np.bincount(doc[a:b] * len(part) + column[a:b] - lo, minlength=len(texts) * len(part)).reshape(len(texts), len(part))
        out += count.astype(np.float32) @ vec.astype(np.float32)
    return out


def chunks(texts: list[bytes], limit: int = CHUNK_CHARS) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size > limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD, F.lit(False))


def prototypes(docs: DataFrame, max_docs: int = MAX_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and their unit prototypes: each language's sampled
    documents bundled.  Tasks add up their documents; the sums meet by
    (language, dimension)."""
    ids = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    ids = bounded_sample(ids.select(F.col(id_col).alias("_id")).distinct(), F.col("_id"), max_docs)
    d = docs.filter(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"),
                                                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    d = d.join(F.broadcast(ids), "_id").select("lang", "t")  # at most 2 * max_docs ids

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, one in b.groupby("lang"):
                total = np.zeros(DIM)
                for c in chunks(list(one["t"])):
                    total += bundles(c).sum(axis=0, dtype=np.float64)
                yield pd.DataFrame({"lang": [lang], "v": [total.tolist()]})

    sums = (d.mapInPandas(add, "lang string, v array<double>").select("lang", F.posexplode("v").alias("i", "x"))
            .groupBy("lang", "i").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).collect())
    names, rows = [], []
    for r in sorted(sums, key=lambda r: r["lang"]):
        v = np.array([p["x"] for p in r["v"]])
        if np.any(v):
            names.append(r["lang"])
            rows.append(v / np.linalg.norm(v))
    return names, np.array(rows).reshape(len(names), DIM)


def predict_column(names: list[str], protos: np.ndarray, text_col: str = "text") -> Column:
    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score = [], []
            for c in chunks([t or b"" for t in texts]):
                v = bundles(c).astype(np.float64)
                norm = np.linalg.norm(v, axis=1)
                cos = (v @ protos.T) / np.maximum(norm, 1e-30)[:, None] if names else np.zeros((len(c), 1))
                top = cos.argmax(axis=1)  # the first of equals: names are sorted
                some = (norm > 0) & bool(names)
                lang += [names[i] if s else NONE for i, s in zip(top, some)]
                score += np.where(some, np.clip(cos.max(axis=1), 0, 1), 0.0).tolist()
            yield pd.DataFrame({"lang_pred": pd.Series(lang, dtype="object"), "score": pd.Series(score, dtype="float64")})

    return predict(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


def identify(docs: DataFrame, max_docs: int = MAX_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    The score is the cosine to the nearest prototype, 0 where it is negative; ties
    go to the language first in code point order.  Null or empty text, or none of
    its characters a letter: ``und`` with score 0, as is everything where nothing
    could be learnt.  Null language or id: not learnt from.  Repeated rows: one
    result each.  Empty table: no rows.  Other columns are not read."""
    names, protos = prototypes(docs, max_docs, id_col, text_col, lang_col)
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), predict_column(names, protos, text_col).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
