"""Scalar text expressions.

Regular expressions are written so that Java regex (Spark) and RE2
(the DuckDB oracle) give the same answer: explicit whitespace classes
instead of ``\\s``, Unicode classes instead of ``\\w``.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from importlib import resources

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "WS", "NON_WS", "PUNCT_CLASS", "TOKEN_PATTERN", "HATE_INDICATORS", "MASK_CHARS",
    "english_stop_words", "clean_post", "squeeze_whitespace", "strip_accents_lower",
    "words", "count_char", "count_substring", "count_regex", "text_stat_columns",
    "STAT_NAMES", "sigmoid_clip", "activation_expand", "tokens", "hashtags", "mentions",
]

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# Indicator words counted as substrings of the lower-cased post:
HATE_INDICATORS = ["hate", "kill", "die", "stupid", "idiot", "moron", "dumb", "ugly", "fat"]
# Characters counted once each when present (masking of profanity):
MASK_CHARS = ["@", "#", "*", "%"]
# ---------------------------------------------------------------------------

# ASCII whitespace, spelled out so both regex engines agree.
WS = "[ \\t\\n\\x0B\\f\\r]"
NON_WS = "[^ \\t\\n\\x0B\\f\\r]"
# The 32 ASCII punctuation characters as ranges: ! to /, : to @, [ to `, { to ~.
PUNCT_CLASS = "[!-/:-@\\[-`{-~]"
# Words of two or more Unicode word characters.
TOKEN_PATTERN = "[\\p{L}\\p{N}_]{2,}"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


@lru_cache(maxsize=1)
def english_stop_words() -> tuple[str, ...]:
    """Spark MLlib's English stop-word list, shipped as package data (the
    oracle SQL embeds the same list)."""
    data = resources.files("postlens.functions").joinpath("english_stop_words.txt").read_text(encoding="utf-8")
    return tuple(w for w in data.splitlines() if w and not w.startswith("#"))


def clean_post(col) -> Column:
    """URLs, then @mentions/#hashtags, then non-letters, then the token RT,
    then lower-case -- in that order (RT is removed before lower-casing)."""
    t = F.coalesce(_c(col), F.lit(""))
    t = F.regexp_replace(t, "http" + NON_WS + "+", "")
    t = F.regexp_replace(t, "@[A-Za-z0-9_]+|#[A-Za-z0-9_]+", "")
    t = F.regexp_replace(t, "[^A-Za-z \\t\\n\\x0B\\f\\r]", "")
    t = F.regexp_replace(t, "\\bRT\\b", "")
    return F.lower(t)


def squeeze_whitespace(col) -> Column:
    """Collapse whitespace runs to one blank and trim."""
    t = F.regexp_replace(_c(col), WS + "+", " ")
    return F.regexp_replace(t, "^ | $", "")


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Accent map built by rule: every code point of the Latin blocks, and of the
    compatibility forms, whose NFKD form minus what is not ASCII is one character."""
    src, dst = [], []
    for cp in (*range(0x00A0, 0x0250), *range(0x1E00, 0x2150), *range(0x2460, 0x2500), *range(0xFF01, 0xFF5F)):
        ch = chr(cp)
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if c.isascii())
        if len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def strip_accents_lower(col) -> Column:
    """Accents folded to their ASCII letter, all else that is not ASCII dropped,
    lower-cased."""
    src, dst = _accent_table()
    return F.lower(F.regexp_replace(F.translate(_c(col), src, dst), "[^\\x00-\\x7F]", ""))


def words(col, lower: bool = False) -> Column:
    """Python ``str.split()`` on ASCII whitespace: no empty words."""
    t = _c(col)
    if lower:
        t = F.lower(t)
    return F.filter(F.split(F.coalesce(t, F.lit("")), WS + "+"), lambda w: w != "")


def count_char(col, ch: str) -> Column:
    return F.length(_c(col)) - F.length(F.replace(_c(col), F.lit(ch), F.lit("")))


def count_substring(col, s: str) -> Column:
    """Non-overlapping occurrences, like Python's ``str.count``."""
    return ((F.length(_c(col)) - F.length(F.replace(_c(col), F.lit(s), F.lit("")))) / F.lit(len(s))).cast("long")


def count_regex(col, pattern: str) -> Column:
    return F.regexp_count(_c(col), F.lit(pattern))


STAT_NAMES = [
    "n_chars", "n_words", "n_sentences",
    "upper_ratio", "lower_ratio", "caps_word_ratio",
    "punct_ratio", "excl_ratio", "quest_ratio", "excl3_ratio", "quest3_ratio",
    "indicator_ratio", "mask_ratio", "repeat_ratio",
    "unique_word_ratio", "mean_word_len",
    "mention_density", "hashtag_density",
]


def text_stat_columns(col) -> dict[str, Column]:
    """The reference's per-post statistics (sentiment ones are separate:
    see ``lexicon_sentiment``).  Denominators are ``max(len, 1)``."""
    t = F.coalesce(_c(col), F.lit(""))
    n = F.length(t)
    den = F.greatest(n, F.lit(1)).cast("double")
    ws = words(t)
    nw = F.size(ws)
    wden = F.greatest(nw, F.lit(1)).cast("double")
    low = F.lower(t)
    lw = words(low)
    sentences = F.filter(F.split(t, "\\."), lambda s: s.rlike(NON_WS))
    caps = F.filter(ws, lambda w: w.rlike("\\p{Lu}") & ~w.rlike("[\\p{Ll}\\p{Lt}]"))
    indicator_hits = sum(F.when(F.instr(low, w) > 0, 1).otherwise(0) for w in HATE_INDICATORS)
    mask_hits = sum(F.when(F.instr(t, c) > 0, 1).otherwise(0) for c in MASK_CHARS)
    total_len = F.aggregate(lw, F.lit(0).cast("long"), lambda acc, w: acc + F.length(w))
    return {
        "n_chars": n.cast("long"),
        "n_words": nw.cast("long"),
        "n_sentences": F.size(sentences).cast("long"),
        "upper_ratio": count_regex(t, "\\p{Lu}") / den,
        "lower_ratio": count_regex(t, "\\p{Ll}") / den,
        "caps_word_ratio": F.size(caps) / wden,
        "punct_ratio": (n - F.length(F.regexp_replace(t, PUNCT_CLASS, ""))) / den,
        "excl_ratio": count_char(t, "!") / den,
        "quest_ratio": count_char(t, "?") / den,
        "excl3_ratio": count_substring(t, "!!!") / den,
        "quest3_ratio": count_substring(t, "???") / den,
        "indicator_ratio": indicator_hits / wden,
        "mask_ratio": mask_hits / den,
        "repeat_ratio": count_regex(low, "([^\\n])\\1{2,}") / den,
        "unique_word_ratio": F.when(F.size(lw) > 0, F.size(F.array_distinct(lw)) / F.size(lw)).otherwise(F.lit(0.0)),
        "mean_word_len": F.when(F.size(lw) > 0, total_len / F.size(lw)).otherwise(F.lit(0.0)),
        "mention_density": count_char(t, "@") / den,
        "hashtag_density": count_char(t, "#") / den,
    }


def tokens(col, stop_words=None, lower: bool = True) -> Column:
    """Words of >= 2 word characters, lower-cased, stop words removed."""
    t = F.coalesce(_c(col), F.lit(""))
    if lower:
        t = F.lower(t)
    toks = F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), 0)
    if stop_words:
        sw = list(stop_words)
        toks = F.filter(toks, lambda x: ~x.isin(sw))
    return toks


def hashtags(col) -> Column:
    return F.regexp_extract_all(F.coalesce(_c(col), F.lit("")), F.lit("#[\\p{L}\\p{N}_]+"), 0)


def mentions(col) -> Column:
    return F.regexp_extract_all(F.coalesce(_c(col), F.lit("")), F.lit("@[\\p{L}\\p{N}_]+"), 0)


def sigmoid_clip(z) -> Column:
    zc = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), _c(z).cast("double")))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-zc))


def activation_expand(arr) -> Column:
    """score array -> relu ++ sigmoid ++ tanh ++ leaky-relu(0.01)."""
    a = _c(arr)
    relu = F.transform(a, lambda x: F.greatest(x, F.lit(0.0)))
    sig = F.transform(a, lambda x: sigmoid_clip(x))
    tanh = F.transform(a, lambda x: F.tanh(x))
    leaky = F.transform(a, lambda x: F.when(x > 0, x).otherwise(x * 0.01))
    return F.concat(relu, sig, tanh, leaky)
