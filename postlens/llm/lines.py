"""Line dedup by winnowing over line hashes (native)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import keep, table, with_row_key

#: Lines of a hashed gram; grams of a window.  Runs of GRAM + GRAMS - 1 lines are certain to be found.
GRAM, GRAMS = 1, 2
#: A line of more words than this is a run by itself.
LONG = 3
WORD = r"[^\x20\x09-\x0D]+"


def repeated_lines(docs: DataFrame, gram: int = GRAM, grams: int = GRAMS, long: int = LONG, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id, _th, drop)``: numbers (from 0) of the non-blank lines that stand in a
    later copy of a run of at least gram + grams - 1 lines, blank ones not counted, or
    are a later copy of a line of over ``long`` words.

    Winnowing: of every window of ``grams`` line-gram hashes the least is the
    fingerprint, so two equal runs of that length share one; a long line is a window
    and its fingerprint at once, and windows of long lines only say no more than those.
    Fingerprints met at one position only end here.  Around the others the run windows
    that hold them, on both sides, are matched whole (128 hash bits); of equal windows
    the first in (doc_id, text hash, line) order stays.  Longer matches are chains of
    such windows.  Each window goes against the first of its group, never against all.
    The work on one text grows with its lines."""
    run = gram + grams - 1
    line = lambda l, i: F.struct(i.alias("i"), F.xxhash64(l).alias("a"), F.xxhash64(F.lit("#"), l).alias("b"), F.length(F.trim(l)).alias("n"),
                                 ((F.length(l) > 2 * long) & (F.regexp_count(l, F.lit(WORD)) > long)).alias("long"))
    ls = F.filter(F.transform(F.split("text", "\n", -1), line), lambda s: s["n"] > 0)
    d = with_row_key(docs, id_col, text_col).select("_id", "_th", ls.alias("ls"))
    # arrays of their own, by transform: a mere ls.a would be put into the lambdas below and copied at every use
    d = d.select("_id", "_th", *[F.expr(f"transform(ls, s -> s.{c}) AS {c}") for c in ("i", "a", "b", "long")])
    window = lambda n, m: f"struct({m} AS m, xxhash64(slice(a, j + 1, {n})) AS a, xxhash64(slice(b, j + 1, {n})) AS b, slice(i, j + 1, {n}) AS i)"
    print_ = lambda g, n: f"struct(xxhash64(slice(a, {g} + 1, {n})) AS f, {g} AS p)"
    least = f"array_min(transform(sequence(j, j + {grams - 1}), g -> {print_('g', gram)}))"
    short = f"filter(sequence(0, size(a) - {run}), j -> NOT forall(slice(long, j + 1, {run}), x -> x))"
    win = f"""explode(concat(
        if(size(a) >= {run}, transform({short}, j -> {window(run, least)}), array()),
        if(size(a) > 0, transform(filter(sequence(0, size(a) - 1), j -> long[j]), j -> {window(1, print_('j', 1))}), array())))"""
    w = d.select("_id", "_th", F.expr(win).alias("x")).select("_id", "_th", "x.m.f", "x.m.p", "x.a", "x.b", "x.i")
    w = keep(w, "line-windows")
    where = F.struct("_id", "_th", "p")
    # tables of their own, so that a hot line's partition of a join can be split
    shared = keep(w.groupBy("f").agg(F.min(where).alias("lo"), F.max(where).alias("hi")).filter("lo <> hi").select("f"), "line-prints")
    near = keep(w.join(shared, "f", "left_semi").select("_id", "_th", "a", "b", "i"), "line-matches")
    first = keep(near.groupBy("a", "b").agg(F.min(F.struct("_id", "_th", F.col("i")[0].alias("at"))).alias("first")), "line-firsts")
    later = near.join(first, ["a", "b"]).filter(F.struct("_id", "_th", F.col("i")[0].alias("at")) > F.col("first"))
    return later.select("_id", "_th", F.explode("i").alias("i")).groupBy("_id", "_th").agg(F.collect_set("i").alias("drop"))


def _cut(docs: DataFrame, gram: int, grams: int, long: int, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with cut texts, and ``__line_gone``, the number of lines removed."""
    drop = repeated_lines(docs, gram, grams, long, id_col, text_col)
    drop = drop.select(F.col("_id").alias("__line_id"), F.col("_th").alias("__line_th"), F.col("drop").alias("__line_drop"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = (F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text)) == F.col("__line_id")) & (F.hash(text) == F.col("__line_th"))
    x = docs.join(drop, same, "left").withColumn("__lines", F.when(F.col("__line_drop").isNotNull(), F.split(F.col(text_col), "\n", -1)))
    every = F.sequence(F.lit(0), F.size("__lines") - 1)
    # the lines left by number: a set difference, not a search for every line
    left = F.array_join(F.transform(F.array_except(every, "__line_drop"), lambda i: F.get("__lines", i)), "\n")
    cut = F.when(F.col("__line_drop").isNull(), F.col(text_col)).otherwise(left)
    return x.select(*[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns], F.coalesce(F.size("__line_drop"), F.lit(0)).alias("__line_gone"))


def dedup_lines(docs: DataFrame, gram: int = GRAM, grams: int = GRAMS, long: int = LONG, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the later copies of repeated line runs cut out of the text;
    all rows and all other columns stay.

    A run has gram + grams - 1 lines at least, or is one line of over ``long`` words.
    Lines end at newlines.  Blank lines stay and do not count as lines of a run.
    Null text stays null.  A text whose lines all go is empty.  Rows that repeat
    id and text are one document and get one result each; rows without an id come
    in the order of their text hashes.  Empty table: no rows."""
    return _cut(docs, gram, grams, long, id_col, text_col).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_digest(docs: DataFrame, gram: int = GRAM, grams: int = GRAMS, long: int = LONG, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_sha256`` of :func:`dedup_lines`; a null
    text counts as empty, one line."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.size(F.split(text, "\n", -1)).alias("n_lines"))
    cut = _cut(d, gram, grams, long, "doc_id", "text")
    return cut.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("__line_gone").cast("long").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digest(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l WHERE trim(l) <> ''),
g AS (SELECT a.doc_id, a.i, b.i AS j, a.l AS la, b.l AS lb FROM n a JOIN n b ON a.doc_id = b.doc_id AND b.k = a.k + {GRAM + GRAMS - 2}),
f AS (SELECT *, row_number() OVER (PARTITION BY la, lb ORDER BY doc_id, i) AS r FROM g),
x AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, i FROM f WHERE r > 1 UNION ALL SELECT doc_id, j FROM f WHERE r > 1
      UNION ALL SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY l ORDER BY doc_id, i) AS r FROM n WHERE len(regexp_extract_all(l, '{WORD}')) > {LONG}) WHERE r > 1)),
o AS (SELECT l.doc_id, count(*) AS n_lines, count(x.i) AS n_removed, string_agg(l.l, chr(10) ORDER BY l.i) FILTER (x.i IS NULL) AS kept
      FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.i = x.i GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM o
"""
assert GRAM + GRAMS == 3, "the oracle restates runs of two lines"
