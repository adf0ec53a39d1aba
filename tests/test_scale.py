"""Steps that once did more work than their rows ask for."""

import numpy as np
from conftest import SF001
from pyspark.sql import functions as F


def rows_of(n=400, dim=5, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    return {"x": x, "y": (x[:, 0] + 0.5 * rng.normal(size=n) > 0).astype(float), "wt": np.ones(n), "held": np.zeros(n, bool), "rid": np.arange(n) * 7919}


def test_a_descent_step_is_the_plain_one():
    from postlens.operators.models.linear import _descend, _halved

    r, own, rates = rows_of(), np.arange(3, 300), np.array([0.1, 0.5])
    wt = np.where(np.arange(400) % 5, 1.5, 0.0)
    wt[3:19] = 0.0  # a batch without weight is no step
    w, b, seen = _descend(_halved(r["x"]), r["y"], wt, own, np.zeros((2, 5)), np.zeros(2), rates, 16, 0.1, 2, lambda e: Plain(), None)
    for j, rate in enumerate(rates):
        v, c = np.zeros(5), 0.0
        for _ in range(2):
            for s in range(3, 300, 16):
                at = np.arange(s, min(s + 16, 300))
                if wt[at].sum() > 0:
                    e = (1 / (1 + np.exp(-(r["x"][at] @ v + c))) - r["y"][at]) * wt[at]
                    v, c = v - rate * (e @ r["x"][at] / wt[at].sum() + 0.1 * v), c - rate * e.sum() / wt[at].sum()
        q = 1 / (1 + np.exp(-(r["x"][own] @ v + c)))
        assert np.allclose(w[j], v) and np.isclose(b[j], c)
        assert np.isclose(seen[-1][j], -(wt[own] * np.where(r["y"][own] > 0, np.log(q), np.log(1 - q))).sum()) and len(seen) == 3


class Plain:
    def permutation(self, n):
        return np.arange(n)


def test_boosting_walks_few_trees_a_pass(monkeypatch):
    """Of 20 trees a pass walks those since the margins were kept, not all."""
    from postlens.operators.models import trees as TR

    r, walked = rows_of(), []
    edges = [np.unique(np.quantile(r["x"][:, f], np.arange(1, 16) / 16)) for f in range(5)]
    bins = np.stack([np.searchsorted(e, r["x"][:, f]) for f, e in enumerate(edges)], axis=1).astype(np.uint16)
    walk = TR.Tree.walk
    monkeypatch.setattr(TR.Tree, "walk", lambda t, *a: walked.append(1) or walk(t, *a))
    fits = []
    for stay in (True, False):
        at = {"r": {**r, "x": bins, "margin": np.zeros(400)}}

        def keep(trees, at=at):
            at["r"] = {**r, "x": bins, "margin": TR.margin(bins, trees, np.zeros(400))}

        walked.clear()
        fits.append(TR._boost(lambda of, at=at: np.array(of(at["r"] if stay else dict(at["r"])), float), None if stay else keep, 0.0, [len(e) for e in edges], 5, 20, 0.3, 3, 0.8, 0.8, 1.0, 0.0, 1.0, 16, None, 1))
        assert len(walked) <= (20 + 60 if stay else 60 + 60 * TR.KEEP + 40)
    assert fits[0].losses == fits[1].losses and fits[0].losses[-1][1] < fits[0].losses[0][1]


def test_extra_trees_rows_walk_a_step_a_level(monkeypatch):
    from postlens.operators.models import trees as TR

    r, walk, given = rows_of(), TR.Tree.walk, []
    monkeypatch.setattr(TR.Tree, "walk", lambda t, x, which=None, at=None: given.append(len(x) if which is None else len(which)) or walk(t, x, which, at))
    grown = TR._grow(lambda of, meet=None: np.array(of(r), float), [0, 1], 5, 2, None, 2, 3)
    fresh = TR._grow(lambda of, meet=None: np.array(of({k: v for k, v in r.items() if k != "stand"}), float), [0, 1], 5, 2, None, 2, 3)
    assert grown == fresh
    n = len(given) // 2
    assert sum(given[:n]) < 0.6 * sum(given[n:])  # rows in leaves are left alone
    plain = sorted(sorted(range(9), key=lambda f: (TR.uniform(1, 2, "LR", f, "pick"), f))[:3])
    assert TR.candidates(1, 2, "LR", 9, 3) == plain


def test_smote_looks_up_copied_rows_only(spark, monkeypatch):
    from postlens.operators import synth as SY

    df = spark.createDataFrame([(i, [float(i % 7), float(i % 11)], int(i % 10 == 0)) for i in range(60)], "id long, x array<double>, label int")
    asked, real = [], SY.nearest_neighbors
    monkeypatch.setattr(SY, "nearest_neighbors", lambda t, q, **k: asked.append((t.count(), q.count())) or real(t, q, **k))
    got = SY.smote(df, k=2)
    assert asked == [(6, 6)] and got.count() == 48


def test_neighbours_through_products_are_exact():
    """Also far from the origin, where the products lose most digits, and among ties."""
    import pandas as pd

    from postlens.operators.models import knn as KNN

    rng = np.random.default_rng(0)
    for shift, step in ((0.0, None), (1e6, None), (0.0, 1.0)):
        x = rng.normal(size=(3000, 8)) + shift
        x = np.round(x) if step else x
        tid, q = rng.permutation(3000), np.concatenate([x[:20], rng.normal(size=(20, 8)) + shift])
        got = KNN._compare(5, 2)(pd.DataFrame({"tid": tid, "tx": list(x), "ty": 0}), pd.DataFrame({"qid": np.arange(40), "qx": list(q)}))
        for i, v in enumerate(q):
            d = np.sqrt(((x - v) ** 2).sum(axis=1))
            assert got[got["qid"] == i]["nid"].tolist() == tid[np.lexsort((tid, d))[:5]].tolist()
    assert KNN._kth(rng.normal(size=(3, 4000)), 5).shape == (3,)


def test_svd_rows_stay_in_the_jvm(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors
    from pyspark.mllib.linalg import distributed
    from pyspark.sql import DataFrame

    from postlens.operators.synth import truncated_svd

    seen, real = [], distributed.RowMatrix
    monkeypatch.setattr(distributed, "RowMatrix", lambda rows: seen.append(isinstance(rows, DataFrame)) or real(rows))
    df = spark.createDataFrame([(Vectors.sparse(3, [0, 2], [1.0, 2.0]),), (Vectors.sparse(3, [1], [3.0]),), (Vectors.sparse(3, [], []),)], ["features"])
    v, s = truncated_svd(df, 2)
    assert seen == [True] and np.allclose(s, [3.0, 5 ** 0.5]) and len(v) == 3


def test_mean_pool_of_odd_vectors(spark, monkeypatch):
    """Repeated words, nulls, short and empty vectors, documents in several parts; vectors
    move to parts of documents instead of a row per word and place."""
    from postlens.operators import features as FE

    monkeypatch.setattr(FE, "POOL_DOCS", 2)
    terms = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (1, "zz", 9), (2, "b", 3), (3, "c", 1), (4, "d", 1), (5, "e", 1), (6, "a", 1), (None, "a", 2), (7, None, 1)], "id long, term string, tf long")
    vecs = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("b", [None, 6.0]), ("c", [1.0]), ("d", []), ("e", None), (None, [9.0, 9.0])], "word string, vec array<double>")
    got = {r.id: r.embedding for r in FE.mean_pool_embeddings(terms, vecs).collect()}
    assert got == {1: [8 / 5, 18 / 5], 2: [None, 6.0], 3: [1.0], 6: [2.0, 3.0], None: [2.0, 3.0]}
    plan = FE.mean_pool_embeddings(terms, vecs)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "posexplode" not in plan


def test_char_ngram_counts_are_those_of_all_grams(spark):
    from postlens.operators import features as FE

    df = spark.createDataFrame([(1, "Ab ab  \t x"), (2, "a"), (3, ""), (4, None), (5, "\U0001F600e\u0301\U0001F600e\u0301!"), (6, "abab\nab"), (6, "xy")], "id long, post string")
    for low, high in ((2, 6), (1, 3), (3, 3)):
        plain = FE.char_ngrams(df, "post", low, high).groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
        assert sorted(map(tuple, FE.char_ngram_counts(df, "post", low, high).collect())) == sorted(map(tuple, plain.collect()))
    assert FE.char_ngrams(df, "post", 2, 6, longest=True).count() < 0.5 * FE.char_ngrams(df, "post", 2, 6).count()


def test_word_ngram_counts_are_those_of_all_grams(spark):
    """One row a place leaves the posts; tokens are made once, behind the join with the labels."""
    import __spark_entry__ as E
    from postlens.operators import features as FE

    df = spark.createDataFrame([(1, ["a", "b", "a", "b", "a"]), (2, ["a"]), (3, []), (5, ["b", "a"]), (6, ["x", "y", "z"]), (6, ["x", "y", "z"])], "id long, tokens array<string>")
    for low, high in ((1, 3), (2, 3), (2, 2), (1, 1), (1, 6)):
        plain = FE.word_ngrams(df, "tokens", low, high).select(F.explode("ngrams").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
        assert sorted(map(tuple, FE.word_ngram_counts(df, "tokens", low, high).collect())) == sorted(map(tuple, plain.collect()))
    assert FE.word_ngrams(df, "tokens", 1, 3, longest=True).count() == 14
    plan = str(E.queries()["word_ngrams"](spark, SF001)._jdf.queryExecution().optimizedPlan()).splitlines()
    made, joined = ([i for i, line in enumerate(plan) if sign in line] for sign in ("regexp_extract_all", "Join Inner"))
    assert made and len(made) == len(joined) and all(m < j for m, j in zip(made, joined))


def test_forest_rows_are_dealt_out(spark, monkeypatch):
    """Short posts in one partition once gave one task all dense rows of the forest."""
    import __spark_entry__ as E
    from postlens.operators.models import text_models as TM
    from pyspark.ml.classification import RandomForestClassifier

    seen, real = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, params=None: seen.append(df.rdd.glom().map(lambda rows: [r.id for r in rows]).collect()) or real(self, df))
    query = E.queries()["text_random_forest"]
    whole = query(spark, SF001).count()
    monkeypatch.setattr(TM, "FOREST_ROWS", 10, raising=False)
    out = query(spark, SF001).collect()
    few, many = seen
    n = sum(map(len, few))
    assert len(many) == -(-n // 10) and max(map(len, many)) < 25 and all(ids == sorted(ids) for ids in many)
    assert sorted(i for ids in many for i in ids) == sorted(i for ids in few for i in ids)
    assert len(out) == whole and all(0 <= r.prob <= 1 and r.prediction in (0, 1) for r in out)


def test_words_do_not_move_by_post(spark):
    """Words of a post are counted where the post is; lemmas need no post at all."""
    from postlens.operators import lexicon as LX

    df = spark.createDataFrame([(1, "Running, running (runs) run run"), (1, "run"), (2, None), (3, "run runs")], "id long, post string")
    words = LX.post_words(df)
    assert sorted(map(tuple, words.collect())) == [(1, "run", 3), (1, "running", 2), (1, "runs", 1), (3, "run", 1), (3, "runs", 1)]
    assert str(words._jdf.queryExecution().optimizedPlan()).count("Repartition") == 1
    lemmas = LX.induce_lemmas(LX.word_rows(df).select("word", F.lit(1).alias("n")))
    assert sorted(map(tuple, lemmas.collect())) == sorted(map(tuple, LX.induce_lemmas(words).collect())) == [("runs", "run", 2, 4)]


def test_nb_counts_are_made_once(spark):
    from postlens.plans.catalog import nb_data

    counts = nb_data(spark, SF001)[0]
    assert counts.storageLevel.useMemory


def test_a_forest_stays_off_the_driver(spark, monkeypatch):
    """Trees of unlimited depth are as large as the rows: they are grown, kept and scored in
    tasks, as the same trees that passes over partitions and a list of them give."""
    from postlens.operators.models import trees as TR
    from pyspark.sql import DataFrame

    r = rows_of()
    rows = [(i % 390, v, int(y), w) for i, (v, y, w) in enumerate(zip(r["x"].tolist(), r["y"], np.where(np.arange(400) % 3, 1.0, 0.3).tolist()))]
    df = spark.createDataFrame(rows, "id int, x array<double>, label int, wt double").repartition(3)
    single = df.withColumn("x", F.transform("x", lambda v: v.cast("float")))
    read, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda d: read.append(d.columns) or collect(d))
    forests = [TR.fit_extra_trees(d, 5, n_trees=11, weight_col=w) for d in (df, single) for w in (None, "wt")]
    assert not read and all(isinstance(f, TR.Forest) for f in forests)
    odd = df.select("id", "x").unionByName(spark.createDataFrame([(1, None), (2, [1.0, None, 0.0, 1.0, 2.0]), (3, [float("nan")] * 5), (4, [0.0] * 5), (4, [-0.0] * 5)], "id int, x array<double>"))
    scored = TR.score_trees(forests[1], odd), TR.score_trees(forests[1], odd, combine="sum", start=0.2, upto=[0, 3, 11])
    assert not read
    monkeypatch.undo()
    monkeypatch.setattr(TR, "WHOLE", 0)
    monkeypatch.setattr(TR, "LOCAL_ROWS", 60)  # several partitions
    plain = [TR.fit_extra_trees(d, 5, n_trees=11, weight_col=w) for d in (df, single) for w in (None, "wt")]
    assert all(isinstance(p, list) for p in plain)
    for f, p in zip(forests, plain):
        assert all(a.feature == b.feature and a.cut == b.cut and np.allclose(a.value, b.value) for a, b in zip(f, p))
    assert forests[0] == plain[0] and forests[0][-1] == plain[0][10] and forests[0][2:4] == plain[0][2:4]
    for got, want in zip(scored, (TR.score_trees(plain[1], odd), TR.score_trees(plain[1], odd, combine="sum", start=0.2, upto=[0, 3, 11]))):
        assert got.dtypes == want.dtypes
        got, want = (sorted(map(tuple, d.select("id", "x", "prob").collect()), key=str) for d in (got, want))
        assert len(got) == 405 and [g[:1] for g in got] == [w[:1] for w in want]
        assert all((a[2] is None) == (b[2] is None) and (a[2] is None or np.allclose(a[2], b[2])) for a, b in zip(got, want))


def test_node_draws_are_the_plain_ones():
    from postlens.operators.models import trees as TR

    nodes = [(0, ""), (7, "LR"), (12, "L" * 30 + "R"), (123, "RL" * 40)]
    features = np.array([[0, 9, 10, 101]] * 4)
    for what in ("pick", "cut"):
        got = TR.node_uniform(42, nodes, features, what)
        assert got.tolist() == [[TR.uniform(42, t, p, f, what) for f in fs] for (t, p), fs in zip(nodes, features.tolist())]


def test_descent_of_soft_labels_and_far_scores():
    """Labels between the classes, scores past the loss's bounds, chunks smaller than the rows."""
    from postlens.operators.models import linear as LIN

    r, own = rows_of(), np.arange(400)
    for y, wt, scale in ((np.where(np.arange(400) % 3, r["y"], 0.3), np.ones(400), 1.0), (r["y"], np.full(400, 2.0), 900.0), (r["y"], 1.0 + np.arange(400) % 2, 1.0)):
        x = r["x"] * scale
        w, b, seen = LIN._descend(LIN._halved(x), y, wt, own, np.zeros((1, 5)), np.zeros(1), np.array([0.3]), 16, 0.0, 3, lambda e: np.random.default_rng(e), None)
        v, c, told = np.zeros(5), 0.0, []
        for epoch in range(4):
            z = np.clip(x @ v + c, -700, 700)
            told.append((wt * np.clip(np.logaddexp(0, np.where(y > 0, -z, z)), 1e-15, -np.log(1e-15))).sum())
            order = np.random.default_rng(epoch).permutation(400)
            for s in range(0, 400 if epoch < 3 else 0, 16):
                at = order[s:s + 16]
                e = (1 / (1 + np.exp(-np.clip(x[at] @ v + c, -700, 700))) - y[at]) * wt[at]
                v, c = v - 0.3 * (e @ x[at]) / wt[at].sum(), c - 0.3 * e.sum() / wt[at].sum()
        assert np.allclose(w[0], v) and np.isclose(b[0], c) and np.allclose([s[0] for s in seen], told)


def test_each_group_of_models_has_a_task(spark, monkeypatch):
    """Groups dealt by hash met in a task by chance, one after the other."""
    from postlens.operators.models import linear as LIN
    from pyspark import TaskContext

    r = rows_of()
    df = spark.createDataFrame([(i, v, int(y), i % 5) for i, (v, y) in enumerate(zip(r["x"].tolist(), r["y"]))], "id int, x array<double>, label int, fold int")
    monkeypatch.setattr(LIN, "_descend", lambda xh, y, wt, own, w, b, *a: (w, b + TaskContext.get().partitionId(), [[0.0]] * 2))
    got = LIN.gd_logistic_many(df, 5, [(0.1, batch, k) for batch in (16, 32, 64) for k in range(5)], epochs=1, fold_col="fold")
    assert sorted(b for _, b, _ in got) == list(range(15))


def test_pooled_vectors_stay_packed():
    """A pool's vectors were all unpacked, twice over for a moment: 2.4 kB a word at 300 dimensions."""
    import tracemalloc

    import pandas as pd
    from postlens.operators import word_vectors as W

    rng, n, size = np.random.default_rng(0), 40_000, 300
    v = rng.normal(size=(n, size)).astype(np.float32)
    known = W.unpacked(W.packed(v), size)
    # word w is number w of part 0, those of the upper half number w - n / 2 of part 2 as well
    where = [np.array([[0, w]] + [[2, w - n // 2]] * (w >= n // 2), np.int32).tobytes() for w in range(n)]
    words = pd.DataFrame({"kind": 0, "n": 0, "number": 0, "id": None, "vec": W.packed(v), "shared": where})
    said = [(p, rng.integers(0, n // (1 + (p > 0)), k).astype(np.int32)) for p, k in [(0, 30), (2, 5), (0, 0), (2, 7000), (0, 1)] * 40] + [(0, np.zeros(0, np.int32))]
    own = rng.normal(size=(len(said), size)).astype(np.float32)
    count = [len(k) + 1 for _, k in said[:-1]] + [0]
    posts = pd.DataFrame({"kind": 1, "n": count, "number": [p for p, _ in said], "id": [str(i) for i in range(len(said))], "vec": [o.tobytes() for o in own], "shared": [k.tobytes() for _, k in said]})
    both = pd.concat([words, posts], ignore_index=True)
    batches = [both.iloc[i:i + 7000] for i in range(0, len(both), 7000)]
    v = words = both = None
    tracemalloc.start()
    got = pd.concat(W.pooled(batches, size))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * 454 * 3 + 1.2e3 * 30_000  # packed words, a block's vectors, the result
    for (p, k), o, m, mean, i in zip(said, own, count, got["embedding"], got["id"]):
        assert (mean is None) == (m == 0)
        if m:
            assert np.allclose(mean, (o + known[k + (n // 2 if p else 0)].sum(axis=0)) / m, atol=1e-3), i
    assert len(got) == len(said)
    assert [len(d) for d in W.pooled([posts.iloc[2:3].drop(columns=["vec"]).assign(vec=own[0].tobytes())], size)] == [1]  # no word is shared


def test_mean_pool_moves_little(spark, monkeypatch):
    """Vectors of float32 values move as such, a document's words as one row; nothing is cached,
    and words may hold anything."""
    from postlens.operators import features as FE

    monkeypatch.setattr(FE, "POOL_DOCS", 3)
    words = ["a", "b", "", "\u00e4\U0001F600", "a b", "ab", "c\x00d", "zz"]
    rng = np.random.default_rng(4)
    docs = [(i % 17, [words[k] for k in rng.integers(0, 8, 9)]) for i in range(30)] + [(50, ["zz"]), (51, []), (None, ["a", "zz"])]
    v = {w: rng.normal(size=4).astype(np.float32 if i != 3 else float).tolist() for i, w in enumerate(words[:7])}
    df = spark.createDataFrame(docs, "id long, tokens array<string>")
    vecs = spark.createDataFrame(list(v.items()), "word string, vec array<double>")
    out = FE.mean_pool_embeddings(FE.term_counts(df), vecs, n_docs=12)
    want = {}
    for i, tokens in docs:
        want.setdefault(i, []).extend(v[w] for w in tokens if w in v)
    got = out.collect()
    assert len(got) == len({r.id for r in got}) == 18 and 50 not in {r.id for r in got}
    assert all(np.allclose(r.embedding, np.mean(want[r.id], axis=0)) for r in got)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "InMemory" not in plan and "array<float>" in str(out._jdf.queryExecution().analyzed())
