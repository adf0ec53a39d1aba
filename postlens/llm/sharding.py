"""Sharding by a hierarchical weighted hash tree (native)."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postlens.llm.common import crc32_sql, table

SHARDS, SEED = 16, 29
#: Shards of a rack, racks of a region.
RACK, REGION = 4, 2
#: Hex digits of the id's hash that name a slot bucket.
HEX = 3
BITS = 52


def topology(shards: int, base: int = SHARDS, rack: int = RACK, region: int = REGION) -> dict[str, float]:
    """Weights by path ``region.rack.shard``.  The first ``base`` shards fill racks and
    regions; every later one opens a region, so no weight above an older shard changes
    and the new shard takes rows into itself only."""
    at = lambda s: (s // (rack * region), s // rack % region)
    first = at(base - 1)[0] + 1
    return {"%d.%d.%d" % (*(at(s) if s < base else (first + s - base, 0)), s): 1.0 for s in range(shards)}


def _children(leaves: dict[str, float]) -> dict[str, dict[str, float]]:
    """Of every inner node the children and their weights, those of their leaves summed."""
    kids: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for path, weight in sorted(leaves.items()):
        parts = path.split(".")
        for depth in range(len(parts) if weight > 0 else 0):
            kids[".".join(parts[:depth])][".".join(parts[:depth + 1])] += weight
    return kids


def descend(key: Column, leaves: dict[str, float], seed: int = SEED) -> Column:
    """The shard number of ``key``.  At each level every child draws
    -ln(hash of key and child) / weight and the least draw wins, so children win in
    proportion to their weights, and a changed weight moves rows only into or out of
    that child; the tables below hold one entry per node of the tree."""
    kids = _children(leaves)
    if not kids:
        raise ValueError("a tree needs a shard of positive weight")
    nodes = F.create_map(*[x for parent, c in kids.items() for x in (
        F.lit(parent), F.array(*[F.struct(F.lit(p).alias("path"), F.lit(w).alias("weight")) for p, w in c.items()]))])

    def draw(child: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), child["path"], F.lit(":"), key)), 1, BITS // 4), 16, 10).cast("double")
        return F.struct((-F.ln((bits + 0.5) / float(1 << BITS)) / child["weight"]).alias("draw"), child["path"].alias("path"))

    node = F.lit("")
    for _ in range(len(next(iter(leaves)).split("."))):
        node = F.array_min(F.transform(F.element_at(nodes, node), draw))["path"]
    return F.element_at(F.split(node, r"\."), -1).cast("int")


def _key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def shard_table(docs: DataFrame, shards: int = SHARDS, base: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    The id and the shard count decide the shard (law ``key``); ``grown_shard`` is the
    one with a shard more.  Slots count a shard's rows from 0, in the order of the
    id's md5, id, size and checksum.  No shard is sorted in one task: rows that agree in all
    of these are counted per input partition first, buckets of the md5 get offsets from
    their counts, and a window runs inside a bucket only.

    Null and empty texts: size 1, checksum 0.  Null ids are one key, last in their bucket's order
    of ids; repeated rows share a shard and get slots of their own.  Empty
    table: no rows.  Other columns are not read."""
    text, key = F.coalesce(F.col(text_col), F.lit("")).cast("binary"), _key(id_col)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                    key.alias("key"), F.spark_partition_id().alias("part"))
    same = ["key", "doc_id", "size", "text_crc32"]
    g = d.groupBy(*same, "part").agg(F.count(F.lit(1)).alias("n"))
    g = g.select("*", descend(F.col("key"), topology(shards, base), seed).alias("shard"),
                 descend(F.col("key"), topology(shards + 1, base), seed).alias("grown_shard"), F.md5("key").alias("mark"))
    g = g.withColumn("bucket", F.substring("mark", 1, HEX))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = g.groupBy("shard", "bucket").agg(F.sum("n").alias("rows"))
    offsets = offsets.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("mark", F.col("doc_id").asc_nulls_last(), "size", "text_crc32", "part")
    g = g.withColumn("start", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
    rows = g.join(offsets, ["shard", "bucket"]).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                       (F.col("offset") + F.col("start") + F.col("copy")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, leaves: dict[str, float], seed: int = SEED, files: int = 4, id_col: str = "doc_id") -> None:
    """``docs`` under ``path``, a folder ``shard=N`` per shard with about ``files`` files
    each; all rows and columns as they are.  A column named ``shard`` is replaced."""
    key = _key(id_col)
    rows = docs.withColumn("shard", descend(key, leaves, seed))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(files))
    rows.repartition(len(leaves) * files, "shard", salt).write.partitionBy("shard").parquet(path)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table(table(spark, sf_dir, "documents"))


def _descend_sql(key: str, leaves: dict[str, float], seed: int = SEED) -> str:
    """One CASE per inner node, the draws of its children in a list of structs."""
    kids = _children(leaves)

    def draws(parent: str) -> str:
        one = "{{'d': -ln((('0x' || substr(md5('{s}:{p}:' || {k}), 1, {n}))::BIGINT::DOUBLE + 0.5) / {top}) / {w}, 'p': '{p}'}}"
        return "[" + ", ".join(one.format(s=seed, p=p, k=key, n=BITS // 4, top=float(1 << BITS), w=w) for p, w in kids[parent].items()) + "]"

    def choose(parent: str) -> str:
        if parent not in kids:
            return f"{parent.rsplit('.', 1)[1]}"
        return f"(SELECT CASE x.p {' '.join(f'''WHEN '{p}' THEN {choose(p)}''' for p in kids[parent])} END FROM (SELECT list_sort({draws(parent)})[1] AS x))"

    return choose("")


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, coalesce(text, '') AS s FROM documents),
c AS (SELECT doc_id, k, strlen(s) + 1 AS size, {crc32_sql('s')} AS text_crc32 FROM d),
h AS (SELECT *, {_descend_sql('k', topology(SHARDS))} AS shard, {_descend_sql('k', topology(SHARDS + 1))} AS grown_shard FROM c)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
   row_number() OVER (PARTITION BY shard ORDER BY md5(k), doc_id NULLS LAST, size, text_crc32) - 1 AS slot, grown_shard::INTEGER AS grown_shard FROM h
"""
