"""Global ranks and exact medians against plain windows and Spark's own median."""

import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.operators.features import build_vocabulary, token_index
from postlens.operators.ranking import exact_medians, global_rank


def test_global_rank_equals_a_plain_window(spark):
    rng = random.Random(5)
    rows = [(f"t{i}", 1 if i % 3 else rng.randint(1, 9)) for i in range(4000)]  # two thirds tie on the frequency
    df = spark.createDataFrame(rows, "term string, n long").repartition(7)
    order = [F.desc("n"), F.asc("term")]
    want = {r.term: r.r for r in df.withColumn("r", F.row_number().over(Window.orderBy(*order)) - 1).collect()}
    got = {r.term: r.r for r in global_rank(df, order, "r").collect()}
    assert got == want
    assert global_rank(df.limit(0), order).count() == 0


def test_vocabulary_ranks_need_no_single_task(spark):
    toks = spark.createDataFrame([(i, [f"w{j}" for j in range(i % 50)]) for i in range(200)], "id long, tokens array<string>")
    ids = sorted((r.token_id, r.freq, r.token) for r in token_index(toks).collect())
    assert [i for i, _, _ in ids] == list(range(1, 50)) and ids == sorted(ids, key=lambda r: (-r[1], r[2]))
    counts = toks.select("id", F.explode("tokens").alias("term")).groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))
    voc = build_vocabulary(counts, min_df=2)
    assert sorted(r.idx for r in voc.collect()) == list(range(49))
    # the only window that is not partitioned counts the rows of a range
    plan = voc._jdf.queryExecution().optimizedPlan().toString()
    assert all("_part" in line for line in plan.splitlines() if line.strip().lstrip(":+- ").startswith("Window"))


def groups():
    rng = random.Random(3)
    rows = [("uniform", rng.random()) for _ in range(3001)] + [("even", rng.gauss(0, 1)) for _ in range(2000)]
    rows += [("tied", 0.5) for _ in range(3000)] + [("tied", rng.random()) for _ in range(500)]
    rows += [("steep", 10.0 ** rng.uniform(-12, 12)) for _ in range(1500)]
    rows += [("huge", rng.choice([-1.7e308, 1.7e308])) for _ in range(1001)] + [("ends", x) for x in (-math.inf, 1.0, 2.0, math.inf, math.inf)]
    rows += [("inf", math.inf)] * 900 + [("inf", 1.0)] * 3 + [("nan", math.nan)] * 400 + [("nan", 2.0)] * 500
    rows += [("two", 1.0), ("two", 4.0), ("one", -3.0), ("none", None), (None, 7.0), (None, None), ("tiny", 5e-324), ("tiny", 0.0), ("tiny", 0.0)]
    return rows


def test_medians_equal_sparks_own(spark):
    df = spark.createDataFrame(groups(), "g string, x double").repartition(6)
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("x").alias("m")).collect()}
    for buckets, small in ((4096, 1 << 16), (64, 20)):
        got = {r.g: (r.median, r.n) for r in exact_medians(df, "x", ["g"], [F.count(F.lit(1)).alias("n")], buckets, small).collect()}
        assert set(got) == {r.g for r in df.select("g").distinct().collect()}
        for g, (m, _) in got.items():
            assert m == want[g] or (math.isnan(m) and math.isnan(want[g])), (g, m, want[g])
        assert got["tied"][1] == 3500


def test_median_of_a_whole_table(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1000)], "x double")
    assert exact_medians(df, "x", buckets=8, small=10).first().median == 499.5
    assert exact_medians(df.limit(0), "x").first().median is None
