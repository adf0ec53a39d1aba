"""The level-wise builders against plain recursive versions on small tables."""

import numpy as np
import pytest


def table(spark, n=300, dim=5, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, dim)), 2)
    x[:, 3] = 1.0  # constant
    y = ((x[:, 0] + x[:, 1] ** 2 + rng.normal(scale=0.3, size=n)) > 0.5).astype(int)
    wt = rng.integers(1, 4, n).astype(float)
    rows = [(i, x[i].tolist(), int(y[i]), float(wt[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, x array<double>, label int, wt double").repartition(3), x, y, wt


def plain_extra(x, y, wt, tree, path, k, seed, depth):
    """(probability, or feature, cut, left, right) of one node."""
    from postlens.operators.models.trees import candidates, uniform

    c = np.array([(wt * (y == 0)).sum(), (wt * (y == 1)).sum()])
    if c.min() == 0 or c.sum() < 2 or depth == 0:
        return c[1] / c.sum()
    best = None
    for f in candidates(seed, tree, path, x.shape[1], k):
        lo, hi = x[:, f].min(), x[:, f].max()
        if lo < hi:
            cut = min(lo + uniform(seed, tree, path, f, "cut") * (hi - lo), np.nextafter(hi, lo))
            go, gain = x[:, f] <= cut, 0.0
            for side in (go, ~go):
                s = np.array([(wt * (y == v))[side].sum() for v in (0, 1)])
                gain += (s ** 2).sum() / s.sum()
            if best is None or round(gain, 9) > best[0]:
                best = round(gain, 9), f, cut, go
    if best is None:
        return c[1] / c.sum()
    _, f, cut, go = best
    return (f, cut, *[plain_extra(x[m], y[m], wt[m], tree, path + s, k, seed, depth - 1) for m, s in ((go, "L"), (~go, "R"))])


def plain_score(node, v):
    while isinstance(node, tuple):
        node = node[2] if v[node[0]] <= node[1] else node[3]
    return node


@pytest.mark.parametrize("depth", [None, 3])
@pytest.mark.parametrize("local", [50_000, 60])
def test_extra_trees_are_the_plain_ones(spark, monkeypatch, depth, local):
    from postlens.operators.models import trees as TR

    monkeypatch.setattr(TR, "LOCAL_ROWS", local)  # several partitions
    df, x, y, wt = table(spark)
    got = TR.fit_extra_trees(df, 5, n_trees=4, max_depth=depth, weight_col="wt")
    plain = [plain_extra(x, y, wt, t, "", 2, 42, 10 ** 9 if depth is None else depth) for t in range(4)]
    prob = {r.id: r.prob for r in TR.score_trees(got, df).collect()}
    for i in range(len(x)):
        assert abs(prob[i] - np.mean([plain_score(t, x[i]) for t in plain])) < 1e-12
    if depth is None:  # unlimited depth learns the rows by heart where their drawn features differ
        assert np.mean([(prob[i] >= 0.5) == y[i] for i in range(len(x))]) > 0.97


def test_gains_are_what_the_loss_falls_by(spark):
    from postlens.operators.models.trees import split_gains

    rng = np.random.default_rng(3)
    g, h = rng.normal(size=(2, 3, 8)), rng.random((2, 3, 8))
    got = split_gains(g, h, 1.0, 0.5)
    for i in np.ndindex(2, 3, 8):
        *n, b = i
        a, c = g[tuple(n)], h[tuple(n)]
        half = lambda s: -0.5 * a[s].sum() ** 2 / (c[s].sum() + 1.0)
        want = half(slice(None)) - half(slice(0, b + 1)) - half(slice(b + 1, None))
        ok = c[:b + 1].sum() >= 0.5 and c[b + 1:].sum() >= 0.5
        assert np.isclose(got[i], want) if ok else got[i] == -np.inf


def plain_boost(x, y, use, dim, n_iter, rate, depth, bins):
    """Exhaustive cuts over all distinct values (one bin each)."""
    m = np.full(len(x), np.log(y[use].mean() / (1 - y[use].mean())))
    edges = [np.unique(x[use, f]) for f in range(dim)]
    for _ in range(n_iter):
        q = 1 / (1 + np.exp(-m))
        g, h = q - y, q * (1 - q)

        def grow(rows, at, d):
            a, c = g[rows & use].sum(), h[rows & use].sum()
            m[rows] = at[rows] - rate * a / (c + 1)
            best = (0.0, None, None)
            for f in range(dim) if d else ():
                for e in edges[f][:-1]:
                    go = rows & use & (x[:, f] <= e)
                    al, cl = g[go].sum(), h[go].sum()
                    if cl >= 1 and c - cl >= 1:
                        gain = 0.5 * (al ** 2 / (cl + 1) + (a - al) ** 2 / (c - cl + 1) - a ** 2 / (c + 1))
                        if round(gain, 9) > round(best[0], 9):
                            best = gain, f, e
            if best[1] is not None:
                go = x[:, best[1]] <= best[2]
                grow(rows & go, at, d - 1)
                grow(rows & ~go, at, d - 1)

        grow(np.ones(len(x), bool), m.copy(), depth)
    return 1 / (1 + np.exp(-m))


@pytest.mark.parametrize("local", [50_000, 60])
def test_boosting_is_the_plain_one(spark, monkeypatch, local):
    from pyspark.sql import functions as F

    from postlens.operators.models import trees as TR

    monkeypatch.setattr(TR, "LOCAL_ROWS", local)
    df, x, y, _ = table(spark, 200)
    x = np.round(x, 0)  # a dozen values: every one an edge
    df = df.withColumn("x", F.transform("x", lambda v: F.bround(v, 0))).withColumn("held", F.col("id") % 4 == 0)
    use = np.arange(200) % 4 != 0
    m = TR.fit_boosting(df, 5, n_iter=4, rate=0.3, max_depth=3, bins=200, held_col="held")
    want = plain_boost(x, y, use, 5, 4, 0.3, 3, 200)
    stages = {r.id: r.prob for r in TR.score_trees(m.trees, df, combine="sum", start=m.start, upto=[0, 2, 4]).collect()}
    assert max(abs(stages[i][2] - want[i]) for i in range(200)) < 1e-9
    assert [n for n, _, _ in m.losses] == list(range(5))
    for n, e in ((0, 0), (2, 1), (4, 2)):
        q = np.array([stages[i][e] for i in range(200)])
        each = -(y * np.log(q) + (1 - y) * np.log(1 - q))
        assert abs(m.losses[n][1] - each[use].mean()) < 1e-9 and abs(m.losses[n][2] - each[~use].mean()) < 1e-9
    held = [v for _, _, v in m.losses]
    assert m.best == int(np.argmin(held))


def test_sampling_stopping_and_edge_cases(spark):
    from pyspark.sql import functions as F

    from postlens.operators.models import trees as TR

    df, x, y, _ = table(spark, 300)
    noise = df.withColumn("label", (F.xxhash64("id") % 2 == 0).cast("int")).withColumn("held", F.col("id") % 3 == 0)
    m = TR.fit_boosting(noise, 5, n_iter=60, patience=5, subsample=0.5, colsample=0.6, held_col="held")
    again = TR.fit_boosting(noise.repartition(7), 5, n_iter=60, patience=5, subsample=0.5, colsample=0.6, held_col="held")
    assert len(m.trees) < 60 and len(m.trees) - m.best == 5 and np.allclose([v for *_, v in m.losses], [v for *_, v in again.losses])
    used = {f for t in m.trees for f in t.feature if f >= 0}
    assert all(len({f for f in t.feature if f >= 0}) <= 3 for t in m.trees) and used
    none = df.limit(0)
    assert TR.fit_boosting(none, 5).trees == [] and {t.value[0] for t in TR.fit_extra_trees(none, 5, n_trees=2)} == {0.5}
    odd = spark.createDataFrame([(1, None), (2, [1.0, None, 0.0, 1.0, 2.0]), (3, [float("nan")] * 5), (4, [0.0] * 5)], "id long, x array<double>")
    got = {r.id: r.prob for r in TR.score_trees(m.trees, odd, combine="sum", start=m.start).collect()}
    assert got[1] is got[2] is got[3] is None and 0 < got[4] < 1
    one = TR.fit_extra_trees(df.filter("label = 1"), 5, n_trees=2)
    assert [t.feature for t in one] == [[-1], [-1]] and one[0].value == [1.0]
