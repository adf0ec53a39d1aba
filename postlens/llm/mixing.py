"""Mixing sources to target weights by Sainte-Lague apportionment (native)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import keep, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
REPEAT_CAP, BLOCK, SHARD_TOKENS, SEED = 3, 8, 1 << 20, 17


def _weight(rank: Column, weights) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int")).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = REPEAT_CAP) -> DataFrame:
    """``(source, source_size, n_docs, target)``, one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    the sum of all sizes; a target stops at ``cap`` times its source's size and
    the excess is shared again by weight until none is above.  The fixed point is
    a water level: sorted by size per weight, the capped sources are a prefix.
    The windows without a partition hold one row per source, not per document."""
    lcm = math.lcm(*weights)
    s = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    s = s.withColumn("w", _weight(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())), weights))
    every = Window.partitionBy()
    level = Window.orderBy(F.col("source_size") * (F.lit(lcm) / F.col("w")).cast("long"), F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    upto = level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.select("*", F.sum("source_size").over(every).alias("t"), F.sum("w").over(every).alias("wt"),
                 F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("sb"),
                 F.coalesce(F.sum("w").over(before), F.lit(0)).alias("wb"))
    dec = lambda c: c.cast("decimal(19,0)")
    above = dec(cap * F.col("source_size")) * dec(F.col("wt") - F.col("wb")) < dec(F.col("t") - cap * F.col("sb")) * dec(F.col("w"))
    s = s.withColumn("over", above.cast("int")).withColumn("capped", F.min("over").over(upto) == 1)
    full = F.col("capped")
    s = s.select("source", "source_size", "n_docs", "w", "t", "wt", "capped",
                 F.coalesce(F.sum(F.when(full, F.col("source_size"))).over(every), F.lit(0)).alias("sc"),
                 F.coalesce(F.sum(F.when(full, F.col("w"))).over(every), F.lit(0)).alias("wc"))
    return s.select("source", "source_size", "n_docs",
                    F.when(full, (cap * F.col("source_size")).cast("double"))
                    .otherwise(((F.col("t") - cap * F.col("sc")) * F.col("w")).cast("double") / (F.col("wt") - F.col("wc")).cast("double")).alias("target"))


def sainte_lague(claims: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """Adds ``won``: of ``seats`` (one number per group) each claim gets as many
    as it has among the highest quotients votes / (2k + 1).

    A claim's result lies within share * claims / 2 + 1/2 of its exact quota, so
    only quotients in that band are ranked; the seats below it are its anyway."""
    g = Window.partitionBy(*group)
    share = F.col("votes") / F.sum("votes").over(g)
    c = claims.withColumn("_slack", share * F.count(F.lit(1)).over(g) / 2 + 2).withColumn("_quota", share * F.col("seats"))
    c = c.withColumn("_lo", F.greatest(F.lit(0), F.floor(F.col("_quota") - F.col("_slack")))).withColumn("_hi", F.floor(F.col("_quota") + F.col("_slack")) + 1)
    c = c.withColumn("_left", F.col("seats") - F.sum("_lo").over(g))
    best = Window.partitionBy(*group).orderBy((F.col("votes") / (2 * F.col("_k") + 1)).desc(), *order)
    rows = c.withColumn("_k", F.explode(F.sequence("_lo", "_hi"))).withColumn("_r", F.row_number().over(best))
    return rows.groupBy(*claims.columns).agg((F.first("_lo") + F.sum((F.col("_r") <= F.col("_left")).cast("long"))).alias("won"))


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = REPEAT_CAP, block: int = BLOCK, shard_tokens: int = SHARD_TOKENS,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``.

    Blocks of ``block`` words are apportioned to sources by their targets and,
    within a source, to its shards (about ``shard_tokens`` words each, by a seeded
    hash of the id) by their sizes.  A shard's documents stand in seeded order and
    are read in a circle for as many blocks as the shard has won, so a document is
    taken whole some times and at most one per shard in part.  No document exceeds
    ``cap`` times its size.  Same rows, same result.

    Null text: size 0.  Null source: a source of its own, last.  Null or repeated
    ids: every row counts by itself.  Empty table: no rows.  Other columns of
    ``docs`` are not read."""
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    d = keep(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                         F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), mark.alias("mark")), "mix")
    sources = source_targets(d, weights, cap)
    total = F.sum("source_size").over(Window.partitionBy())
    src = sainte_lague(sources.select("*", F.col("target").alias("votes"), F.floor(total / block).alias("seats")).filter("votes > 0"),
                       [], [F.col("source").asc_nulls_last()])
    src = src.select("source", F.col("won").alias("seats"))
    src = keep(sources.alias("a").join(src.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left")
               .select("a.*", F.coalesce("b.seats", F.lit(0)).alias("seats")), "mix-sources")
    shards_of = F.ceil((F.col("source_size") + F.col("n_docs")) / shard_tokens).cast("long")
    d = (d.alias("d").join(src.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
         .select("d.*", "source_size", "target", "seats",
                 (F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") % shards_of).alias("shard")))
    sh = (d.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.first("seats").alias("seats"))
          .filter("shard_size > 0").withColumn("votes", F.col("shard_size").cast("double")))
    sh = sainte_lague(sh, ["source"], [F.col("shard")])
    words = F.least(F.col("won") * block, cap * F.col("shard_size"))
    sh = sh.select("source", "shard", (words / F.col("shard_size")).cast("long").alias("rounds"), (words % F.col("shard_size")).alias("rest"))
    seat = Window.partitionBy("source", "shard").orderBy("mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("start", F.sum("size").over(seat) - F.col("size"))
    out = d.alias("d").join(sh.alias("h"), F.col("d.source").eqNullSafe(F.col("h.source")) & (F.col("d.shard") == F.col("h.shard")), "left")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start")))
    return out.select("d.doc_id", "d.size", "d.source_size", "d.target",
                      F.coalesce(F.col("rounds") * F.col("size") + part, F.lit(0)).cast("long").alias("taken"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def _rank_sql(claims: str, group: str, order: str, keys: str) -> str:
    part = f"PARTITION BY {group}" if group else ""
    return f"""(WITH c0 AS (SELECT *, votes / sum(votes) OVER ({part}) AS share, count(*) OVER ({part}) AS m FROM ({claims})),
c1 AS (SELECT *, greatest(0, floor(share * seats - (share * m / 2 + 2)))::BIGINT AS lo, (floor(share * seats + (share * m / 2 + 2)) + 1)::BIGINT AS hi FROM c0),
c2 AS (SELECT *, seats - sum(lo) OVER ({part}) AS left_over FROM c1),
c3 AS (SELECT *, unnest(range(lo, hi + 1)) AS k FROM c2),
c4 AS (SELECT *, row_number() OVER ({part} ORDER BY votes / (2 * k + 1) DESC, {order}) AS r FROM c3)
SELECT {keys}, (any_value(lo) + sum(CASE WHEN r <= left_over THEN 1 ELSE 0 END))::BIGINT AS won FROM c4 GROUP BY {keys})"""


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
                  md5(concat('{SEED}:', coalesce(doc_id::VARCHAR, ''))) AS mark FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM d GROUP BY source),
s1 AS (SELECT *, [1, 2, 3][((rk - 1) % 3 + 1)::INT]::BIGINT AS w FROM s0),
s2 AS (SELECT *, sum(source_size) OVER () AS t, sum(w) OVER () AS wt,
   coalesce(sum(source_size) OVER (lv ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sb,
   coalesce(sum(w) OVER (lv ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wb
   FROM s1 WINDOW lv AS (ORDER BY source_size * (6 // w), source NULLS LAST)),
s3 AS (SELECT *, min(CASE WHEN {REPEAT_CAP}::HUGEINT * source_size * (wt - wb) < (t - {REPEAT_CAP}::HUGEINT * sb) * w THEN 1 ELSE 0 END)
   OVER (ORDER BY source_size * (6 // w), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AS capped FROM s2),
s4 AS (SELECT *, coalesce(sum(CASE WHEN capped THEN source_size END) OVER (), 0) AS sc, coalesce(sum(CASE WHEN capped THEN w END) OVER (), 0) AS wc FROM s3),
s5 AS (SELECT source, source_size, n_docs, t, CASE WHEN capped THEN ({REPEAT_CAP} * source_size)::DOUBLE
   ELSE ((t - {REPEAT_CAP} * sc) * w)::DOUBLE / (wt - wc)::DOUBLE END AS target FROM s4),
q0 AS (SELECT s5.*, coalesce(won, 0) AS seats FROM s5 LEFT JOIN
   {_rank_sql(f'SELECT source, target AS votes, floor(t / {BLOCK})::BIGINT AS seats FROM s5 WHERE target > 0', '', 'source NULLS LAST', 'source')} w
   ON s5.source IS NOT DISTINCT FROM w.source),
e AS (SELECT d.*, q0.source_size, q0.target, q0.seats,
   ('0x' || substr(mark, 1, 8))::BIGINT % ceil((source_size + n_docs) / {SHARD_TOKENS})::BIGINT AS shard FROM d JOIN q0 ON d.source IS NOT DISTINCT FROM q0.source),
h0 AS (SELECT source, shard, sum(size)::BIGINT AS shard_size, any_value(seats) AS seats, sum(size)::DOUBLE AS votes FROM e GROUP BY source, shard HAVING sum(size) > 0),
h1 AS (SELECT source, shard, shard_size, least(won * {BLOCK}, {REPEAT_CAP} * shard_size) AS words FROM {_rank_sql('SELECT * FROM h0', 'source', 'shard', 'source, shard, shard_size')}),
f AS (SELECT *, (sum(size) OVER (PARTITION BY source, shard ORDER BY mark, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start FROM e)
SELECT f.doc_id, f.size, f.source_size, f.target,
   coalesce((h1.words // h1.shard_size) * f.size + greatest(0, least(f.size, h1.words % h1.shard_size - f.start)), 0)::BIGINT AS taken
FROM f LEFT JOIN h1 ON f.source IS NOT DISTINCT FROM h1.source AND f.shard = h1.shard
"""
