"""Benchmark decontamination: prefix-filtered set join with exact verification (native)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import keep, table, with_row_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Its complement's runs are the same words before lower-casing.
RAW_NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window, words of a shingle, windows that one pass looks for.
WINDOW, SHINGLE, PASS_WINDOWS = 10, 3, 20_000


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else; ``lower`` does just that where all is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def item_words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), NOT_WORD, -1), lambda w: w != "")


def _shingles(words: str, size: int) -> str:
    """SQL: hashes of all runs of ``size`` words, in order."""
    args = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return f"if(size({words}) >= {size}, transform(sequence(0, size({words}) - {size}), i -> xxhash64({args})), array())"


def _known(words: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """``words`` with one row for each shingle that ``wanted.h`` has, as ``x.at``,
    ``x.h``.  The hashes (a pass's windows bound their number) are a literal set,
    so all other shingles go while they are still array elements."""
    keys = [r["h"] for r in wanted.distinct().collect()]
    if not keys:
        return words.withColumn("x", F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("h"))).limit(0)
    grams = F.transform(F.expr(_shingles("w", size)), lambda h, i: F.struct(i.alias("at"), h.alias("h")))
    return words.withColumn("x", F.explode(F.filter(grams, lambda g: g["h"].isin(keys))))


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``(item, len, win)``: the distinct windows of every item; an item of fewer
    words, but not none, is one window."""
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), item_words(F.coalesce(F.col(text_col), F.lit(""))).alias("w")).filter("size(w) > 0")
    win = f"explode(transform(sequence(0, greatest(size(w) - {window}, 0)), i -> slice(w, i + 1, {window})))"
    return w.select("item", F.expr(win).alias("win")).distinct().withColumn("len", F.size("win"))


def find_windows(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, pass_windows: int = PASS_WINDOWS,
                 id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(_id, _th, item, start, len)``: every occurrence of an item window in a document.

    A window is a set of shingles of which all must occur, so its prefix is one
    shingle: the one rarest over all documents (ties: the first).  Documents'
    shingles meet the prefixes alone; the shingle's place in the window gives the
    only possible start, which must leave room for the whole window, and the words
    there must equal the window's.  A pass looks for ``pass_windows``
    windows at most, so that what it broadcasts is bounded; a larger benchmark takes
    more passes."""
    win = keep(item_windows(items, window, item_id_col, item_text_col), "windows")
    sizes = {min(r["len"], shingle) for r in win.select("len").distinct().collect()}  # at most `window` lengths
    passes = max(1, -(-win.count() // pass_windows))
    words = with_row_key(docs, id_col, text_col).select("_id", "_th", item_words(F.col("text")).alias("w"))
    found = []
    for size in sorted(sizes):
        exact = (F.col("len") == size) if size < shingle else (F.col("len") >= size)
        own = win.filter(exact).withColumn("h", F.expr(_shingles("win", size)))
        for p in range(passes):
            part = own.filter(F.pmod(F.xxhash64("win"), F.lit(passes)) == p)
            often = _known(words, size, part.select(F.explode("h").alias("h"))).select("x.h").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
            ranked = part.select("item", "win", "len", F.posexplode("h").alias("off", "h")).join(often, "h", "left")
            prefix = (ranked.groupBy("item", "win", "len")
                      .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "h")).alias("m"))
                      .filter("m.n > 0").select("item", "win", "len", "m.off", "m.h"))
            prefix = keep(prefix, "prefixes")
            hit = _known(words, size, prefix.select("h")).select("_id", "_th", "w", "x.at", "x.h").join(F.broadcast(prefix), "h")
            hit = hit.withColumn("start", F.col("at") - F.col("off"))
            found.append(hit.filter("start >= 0 and start + len <= size(w)").filter("slice(w, start + 1, len) = win")
                         .select("_id", "_th", "item", "start", "len"))
    if not found:
        return docs.sparkSession.createDataFrame([], "_id long, _th int, item string, start int, len int")
    return reduce(DataFrame.unionByName, found)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    Null and empty texts have no words; such items no windows.  Items that repeat
    an id add up; a null item id is the empty name.  Repeated document rows get one
    result each.  An empty table on either side: no hits.  Other columns are not
    read."""
    occ = keep(find_windows(docs, items, window, shingle, id_col=id_col, text_col=text_col, item_id_col=item_id_col, item_text_col=item_text_col).distinct(), "hits")
    hit = (occ.select("_id", "_th", F.explode(F.expr("sequence(start, start + len - 1)")).alias("at")).distinct()
           .groupBy("_id", "_th").agg(F.count(F.lit(1)).alias("n_hit")))
    which = occ.select("_id", "_th", "item").distinct().groupBy("_id", "_th").agg(F.sort_array(F.collect_list("item")).alias("items"))
    per = hit.join(which, ["_id", "_th"])
    d = with_row_key(docs, id_col, text_col).select("doc_id", "_id", "_th", F.size(F.filter(F.split("text", RAW_NOT_WORD, -1), lambda w: w != "")).cast("long").alias("n_words"))
    j = d.join(per, ["_id", "_th"], "left")
    return j.select(F.col("doc_id").cast("long").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that hold no item window."""
    bad = find_windows(docs, items, window, shingle, id_col=id_col, text_col=text_col, item_id_col=item_id_col, item_text_col=item_text_col)
    bad = keep(bad.select("_id", "_th").distinct(), "contaminated")
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = (F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text)) == bad["_id"]) & (F.hash(text) == bad["_th"])
    return docs.join(bad, same, "left_anti")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
iw AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, w[i:i + least(len(w), {WINDOW}) - 1] AS win
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, n, i, w[i:i + n - 1] AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
occ AS (SELECT DISTINCT doc_id, item, i, dwin.n FROM dwin JOIN win ON dwin.win = win.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
   sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
