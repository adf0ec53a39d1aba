"""Ensembles, calibration, pruning, gradient descent, text SVD, synthetic rows and
batch scoring against plain versions."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

DIM = 3


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    data = [(i, [float(v) for v in rng.normal((i % 2) * 1.6, 1.0, DIM)], i % 2) for i in range(300)]
    df = spark.createDataFrame(data, "id long, x array<double>, label int").repartition(4)
    return df.withColumn("features", array_to_vector("x")).withColumn("fold", (F.col("id") % 7 % 3).cast("int")).cache()


def accuracy(out):
    got = out.collect()
    assert all(0 <= r.prob <= 1 and r.prediction == int(r.prob >= 0.5) for r in got)
    return sum(r.prediction == r.label for r in got) / len(got)


def test_bagging_is_the_mean_of_its_members(spark, rows):
    from postlens.operators.models import ensembles as EN
    from postlens.operators.models import linear as LIN

    members = EN.bagging(rows, lambda w: LIN.decision_tree(3, weight_col=w), bags=3, feature_fraction=0.67, dim=DIM)
    assert [len(at) for _, at in members] == [2, 2, 2]
    scored = EN.score_bagging(members, rows)
    for r in scored.withColumn("m", EN.mean_of(["p0", "p1", "p2"])).collect():
        assert abs(r.m - (r.p0 + r.p1 + r.p2) / 3) < 1e-12
    assert accuracy(EN.verdict(scored, EN.mean_of(["p0", "p1", "p2"]))) > 0.8


def test_adaboost_weights_follow_its_errors(rows):
    from postlens.operators.models import ensembles as EN

    members = EN.adaboost(rows, rounds=4, depth=1)
    assert members and all(abs(a - np.log((1 - e) / e)) < 1e-9 for _, a, e in members)
    # the same weights by hand, from the trees' own predictions
    got = rows
    for i, (tree, _, _) in enumerate(members):
        got = tree.copy().setPredictionCol(f"t{i}").setProbabilityCol("").setRawPredictionCol("").transform(got)
    got = got.collect()
    w = np.full(len(got), 1 / len(got))
    for i, (_, a, e) in enumerate(members):
        miss = np.array([r[f"t{i}"] != r.label for r in got])
        assert abs(w[miss].sum() / w.sum() - e) < 1e-9
        w = w * np.exp(a * miss)
    assert accuracy(EN.score_adaboost(members, rows)) > 0.8


def test_last_stage_is_the_whole_model(rows):
    from postlens.operators.models import ensembles as EN
    from postlens.operators.models import linear as LIN

    model = LIN.gradient_boosting(n_iter=5, max_depth=2).fit(rows)
    stages = EN.staged_predictions(model, rows, [1, 3, 5, 9])
    assert {r.stage for r in stages.select("stage").distinct().collect()} == {1, 3, 5}
    whole = {r.id: r.p for r in EN.with_prob(model, rows, "p").collect()}
    assert all(abs(r.prob - whole[r.id]) < 1e-5 for r in stages.filter("stage = 5").collect())


def test_calibration_and_any_model(rows):
    from postlens.operators.models import ensembles as EN
    from postlens.operators.models import linear as LIN

    svc = lambda: LIN.linear_svc(C=1.0, n=300)
    assert accuracy(EN.score_calibrated(EN.platt_calibration(rows, svc), rows)) > 0.8
    scaled = EN.score_any_model(svc().fit(rows), rows).agg(F.min("score"), F.max("score")).first()
    assert tuple(scaled) == (0.0, 1.0)


def test_blend_and_layers_learn(rows):
    from postlens.operators.models import ensembles as EN
    from postlens.operators.models import linear as LIN

    test = rows.filter("id >= 200")
    train = rows.filter("id < 200")
    lr = lambda: LIN.logistic_regression(C=1.0, n=100)
    assert accuracy(EN.blend_holdout(train, test, {"lr": lr, "tree": lambda: LIN.decision_tree(3)}, lr)) > 0.8
    vote, layers = EN.layered_stack(train, test, layers=2, width=2)
    assert accuracy(vote) > 0.8 and vote.count() == 100
    assert [t.count() for t, _ in layers] == [200, 200] and all(f > 0.7 for _, f in EN.layer_scores(layers))


def test_prune_against_all_subsets_of_a_step(spark):
    from postlens.operators.models.ensembles import ensemble_prune

    rng = np.random.default_rng(1)
    p = {m: rng.random(60) for m in "abc"}
    y = (p["a"] > 0.5).astype(int)
    df = spark.createDataFrame([(i, m, int(y[i]), float(p[m][i])) for m in p for i in range(60)], "id long, model string, label int, prob double")

    def f1(models):
        pred = np.mean([p[m] for m in models], axis=0) >= 0.5
        per = [2 * ((pred == c) & (y == c)).sum() / ((pred == c).sum() + (y == c).sum()) for c in (0, 1)]
        return sum(per) / 2

    got, left = ensemble_prune(df, list("abc")), list("abc")
    for step in sorted({s for s, *_ in got}):
        of = [r for r in got if r[0] == step]
        assert {m for _, m, _, _ in of} == set(left)
        assert all(abs(f - f1([x for x in left if x != m])) < 1e-9 for _, m, f, _ in of)
        gone = [m for _, m, _, taken in of if taken]
        assert bool(gone) == (max(f for _, _, f, _ in of) > f1(left))
        left = [m for m in left if m not in gone]
    assert left == ["a"]


@pytest.mark.parametrize("parts", [None, 4])
def test_gradient_descent_against_numpy(rows, parts):
    from postlens.operators.models.linear import gd_logistic, score_linear

    got = rows.collect()
    x, y, wt = np.array([r.x for r in got]), np.array([r.label for r in got]), np.array([1.0 + r.id % 2 for r in got])
    w, b, hist = gd_logistic(rows.withColumn("wt", 1.0 + F.col("id") % 2), DIM, epochs=3, lr=0.5, batch=None, l2=0.1, weight_col="wt", partitions=parts)
    v, c = np.zeros(DIM), 0.0
    for e in range(3):
        g = (1 / (1 + np.exp(-(x @ v + c))) - y) * wt
        v, c = v - 0.5 * (x.T @ g / wt.sum() + 0.1 * v), c - 0.5 * g.sum() / wt.sum()
        p = 1 / (1 + np.exp(-(x @ v + c)))
        assert abs(hist[e][1] + (wt * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / wt.sum()) < 1e-9
    assert np.allclose(w, v) and abs(b - c) < 1e-9
    probs = {r.id: r.prob for r in score_linear(rows, w, b).collect()}
    assert all(abs(probs[r.id] - q) < 1e-9 for r, q in zip(got, p))
    assert gd_logistic(rows.limit(0), DIM, epochs=2)[2] == []


def test_rfe_keeps_the_planted_feature(spark, rows):
    from postlens.operators.models.ensembles import rfe
    from postlens.operators.models.linear import random_forest

    noisy = rows.withColumn("features", array_to_vector(F.array(F.rand(1), F.rand(2), F.col("x")[0], F.rand(3))))
    out = rfe(noisy, lambda: random_forest(10, 3), 4, keep=1, step=2)
    assert sorted(f for f, _ in out) == [0, 1, 2, 3] and out[-1] == (2, 3) and [r for _, r in out] == [1, 1, 2, 3]


def test_svd_against_numpy(spark):
    from postlens.operators import features as FE
    from postlens.operators.synth import project, truncated_svd

    rng = np.random.default_rng(2)
    a = rng.random((12, 5)) * (rng.random((12, 5)) < 0.6)
    a[3] = 0  # a row without any value
    long_df = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(12) for j in range(5) if a[i, j]], "id long, idx int, value double")
    ids = spark.range(12)
    v, s = truncated_svd(FE.to_vectors(long_df, 5, ids=ids), 2)
    assert np.allclose(s, np.linalg.svd(a, compute_uv=False)[:2])
    got = {r.id: r.pcs for r in project(long_df, v, ids).collect()}
    assert np.allclose([got[i] for i in range(12)], a @ np.array(v)) and got[3] == [0.0, 0.0]


def test_smote_evens_the_classes_between_neighbours(spark):
    from postlens.operators.synth import smote

    rng = np.random.default_rng(4)
    x = {i: rng.random(2) for i in range(50)}
    label = {i: int(i % 5 == 0) for i in x}
    df = spark.createDataFrame([(i, [float(t) for t in v], label[i]) for i, v in x.items()], "id long, x array<double>, label int")
    got = smote(df, k=3).collect()
    assert len(got) == 40 - 10 and all(r.label == 1 for r in got)
    own = [i for i in x if label[i]]
    for r in got:
        near = sorted((float(np.linalg.norm(x[r.id] - x[j])), j) for j in own if j != r.id)[:3]
        assert r.neighbor in [j for _, j in near] and 0 <= r.u < 1
        assert np.allclose(r.x, x[r.id] + r.u * (x[r.neighbor] - x[r.id]))
    assert smote(df.filter("id < 0")).count() == 0
    assert len({(r.id, r.copy) for r in got}) == len(got) and rows_agree(smote(df, k=3), got)


def rows_agree(df, before):
    return sorted(map(tuple, df.select(*before[0].__fields__).collect())) == sorted(map(tuple, before))


def test_batch_scoring(spark):
    from postlens.operators.synth import score_batch

    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "")], "id long, post string")
    assert {r.id: r.prob for r in score_batch(df, lambda ts: [len(t) / 10 for t in ts]).collect()} == {1: 0.3, 2: 0.0, 3: 0.0}


def test_word2vec_gives_every_token_a_vector(spark):
    """Words met once have vectors too; the query has the reference's size."""
    import __spark_entry__ as E
    from postlens.operators.features import word2vec_mean
    from tests.conftest import SF001

    docs = [(i, ["sun", "sky"] if i % 2 else ["cow", "hay"]) for i in range(60)] + [(60, ["once"]), (61, ["once", "sun"]), (62, [])]
    df = spark.createDataFrame(docs, "id long, tokens array<string>").repartition(4)
    got = {r.id: r.embedding for r in word2vec_mean(df, size=8).collect()}
    assert len(got) == 63 and got[62] is None and all(len(got[i]) == 8 for i in range(62)) and np.isfinite([got[i] for i in range(62)]).all()
    assert np.allclose(got[1], got[3]) and any(got[60]) and not np.allclose(got[60], got[61])
    out = E.queries()["word2vec_mean"](spark, SF001).join(E.queries()["tokenize_words"](spark, SF001), "id").collect()
    assert len(out) == 87 and all((r.embedding is None) == (r.n_tokens == 0) for r in out)
    assert {len(r.embedding) for r in out if r.embedding} == {300}


def test_word_vectors_stay_in_parts(spark):
    """No result of the driver's holds a word; a task holds a part's words; averages are those of the
    parts; reruns agree whatever the partitioning, rows with odd ids and without tokens kept."""
    from unittest import mock

    from pyspark.ml.feature import Word2Vec
    from postlens.operators import word_vectors as W
    from postlens.operators.features import word2vec_mean

    rng = np.random.default_rng(3)
    docs = [(i, [f"t{i % 4}w{k}" for k in rng.integers(0, 12, 30)]) for i in range(400)] + [(2**62 + 1, ["t0w1", "rare"]), (None, ["t1w1", None]), (None, None), (7, []), (7, ["rare"])]
    df = spark.createDataFrame(docs, "id long, tokens array<string>")
    with mock.patch.object(Word2Vec, "fit", side_effect=AssertionError("the vocabulary on the driver")):
        one, many = (word2vec_mean(df.repartition(k), size=9, passes=8, part_tokens=most).collect() for k, most in ((3, None), (5, 2000)))
        again = word2vec_mean(df.repartition(2), size=9, passes=8, part_tokens=2000).collect()
    text = lambda rows: sorted(map(str, rows))
    assert text(many) == text(again) and text(many) != text(one)
    for got in (one, many):
        assert sorted(str(r.id) for r in got) == sorted(str(i) for i, _ in docs) and sum(r.embedding is None for r in got) == 2
        v = {r.id: np.array(r.embedding) for r in got if r.id is not None and r.id != 7}
        m = np.stack([v[i] for i in range(400) if i != 7])
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        c, topic = m @ m.T, np.array([i % 4 for i in range(400) if i != 7])
        np.fill_diagonal(c, -2)
        assert (topic[c.argmax(axis=1)] == topic).all()  # planted neighbours
    # without passes the vectors are the words' first ones, in however many parts: the pooled mean of them
    first = {k: {str((r.id, n)): r.embedding for n, r in enumerate(sorted(word2vec_mean(df, size=9, passes=0, part_tokens=k).collect(), key=str))} for k in (None, 2000)}
    assert all((a is None) == (b is None) and (a is None or np.allclose(a, b, atol=1e-4 / 9)) for a, b in zip(first[None].values(), first[2000].values()))
    x = np.concatenate([rng.normal(size=(50, 9)), np.zeros((1, 9))]).astype(np.float32)
    assert (np.abs(W.unpacked(W.packed(x), 9) - x).max(axis=1) <= np.abs(x).max(axis=1) / 4000).all()


def test_word_vectors_step_is_that_of_plain_cbow():
    """A step over two posts against the sums of gradients written out."""
    from postlens.operators import word_vectors as W

    words, post = np.array([0, 1, 2, 0, 3, 1], np.int32), np.array([0, 0, 0, 0, 1, 1])
    v = W.start_vectors(np.arange(4) * 7919, 6)
    first = v.copy()
    assert np.abs(first).max() <= 0.5 / 6 and len(np.unique(first)) == 24
    W.train(words, post, v, 1, 1, 0, np.random.default_rng(0))
    assert np.allclose(v, first)  # the outer vectors start at zero, so the first step moves these only
    v = first.copy()
    W.train(words, post, v, 2, 1, 0, np.random.default_rng(0))
    near = {0: [1], 1: [0, 2], 2: [1, 3], 3: [2], 4: [5], 5: [4]}
    outer, want = np.zeros((4, 6)), first.astype(float)
    for rate in (0.025, 0.025 - (0.025 - 0.0001) / 2):
        up, move = np.zeros((4, 6)), np.zeros((4, 6))
        for i, c in near.items():
            h = want[words[c]].mean(axis=0)
            g = rate * (1 - 1 / (1 + np.exp(-h @ outer[words[i]])))
            up[words[i]] += g * h
            for j in c:
                move[words[j]] += g * outer[words[i]] / len(c)
        outer, want = outer + up, want + move
    assert np.allclose(v, want, atol=1e-6) and not np.allclose(v, first, atol=1e-6)


def test_descent_of_many_models_is_that_of_each(rows):
    from postlens.operators.models.linear import gd_logistic, gd_logistic_many

    for parts in (1, 3):
        many = gd_logistic_many(rows, DIM, [(0.5, 16, None), (0.1, 16, 0), (0.5, None, 2), (0.2, 16, 0)], epochs=3, l2=0.01, fold_col="fold", partitions=parts)
        for (w, b, hist), (rate, batch, df) in zip(many, [(0.5, 16, rows), (0.1, 16, rows.filter("fold <> 0")), (0.5, None, rows.filter("fold <> 2")), (0.2, 16, rows.filter("fold <> 0"))]):
            v, c, one = gd_logistic(df, DIM, epochs=3, lr=rate, batch=batch, l2=0.01, partitions=parts)
            assert np.allclose(w, v) and abs(b - c) < 1e-12 and np.allclose(hist, one) and len(hist) == 3
        stopped = gd_logistic(rows, DIM, epochs=300 if parts == 1 else 40, lr=0.5, batch=None, l2=0.1, tol=2e-3, partitions=parts)[2]
        assert 2 < len(stopped) < 40 and abs(stopped[-1][1] - stopped[-2][1]) < 2e-3 <= abs(stopped[-2][1] - stopped[-3][1])


def test_mini_batches_against_plain_descent(rows):
    """The loss of the reference's setting within one percent of numpy's, from one
    partition and from three that meet after every epoch."""
    from postlens.operators.models.linear import gd_logistic

    got = rows.collect()
    x, y = np.array([r.x for r in got]), np.array([r.label for r in got], float)
    v, c, rng = np.zeros(DIM), 0.0, np.random.default_rng(0)
    for _ in range(40):
        order = rng.permutation(len(x))
        for s in range(0, len(x), 64):
            at = order[s:s + 64]
            e = 1 / (1 + np.exp(-(x[at] @ v + c))) - y[at]
            v, c = v - 0.05 * x[at].T @ e / len(at), c - 0.05 * e.mean()
    p = 1 / (1 + np.exp(-(x @ v + c)))
    loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    assert abs(gd_logistic(rows, DIM, epochs=40, lr=0.05, batch=64)[2][-1][1] / loss - 1) < 0.01
    # three partitions of a third of the rows: batches of a third keep the number of steps
    assert abs(gd_logistic(rows, DIM, epochs=40, lr=0.05, batch=22, partitions=3)[2][-1][1] / loss - 1) < 0.01


def test_unknown_values_take_no_part(rows):
    from postlens.operators.models.linear import gd_logistic

    more = rows.unionByName(rows.limit(5).withColumn("label", F.lit(None).cast("int"))).unionByName(rows.limit(4).withColumn("x", F.lit(None).cast("array<double>")))
    more = more.select(*[F.col(c) for c in rows.columns])
    w, _, hist = gd_logistic(more, DIM, epochs=3, batch=None)
    v, _, one = gd_logistic(rows, DIM, epochs=3, batch=None)
    assert np.allclose(w, v) and np.allclose(hist, one)


def test_registered_effort(spark, monkeypatch):
    """The queries ask for the reference's epochs, rounds, rates and folds."""
    import __spark_entry__ as E
    from postlens.operators import search as SE
    from postlens.operators import synth as SY
    from postlens.operators.models import ensembles as EN
    from postlens.operators.models import linear as LIN
    from tests.conftest import SF001

    class Asked(Exception):
        pass

    def ask(*args, **named):
        raise Asked(args, named)

    for where, name in ((LIN, "gd_logistic"), (LIN, "gd_logistic_many"), (LIN, "gradient_boosting"), (EN, "adaboost"), (EN, "layered_stack"), (SE, "search"), (SY, "truncated_svd")):
        monkeypatch.setattr(where, name, ask)

    def asked(query):
        with pytest.raises(Asked) as got:
            E.queries()[query](spark, SF001)
        return got.value.args

    assert all(asked(q)[1]["epochs"] == 1000 for q in ("gd_logistic", "gd_logistic_l2", "gd_logistic_weighted", "history_table", "lr_batch_sweep"))
    assert len(asked("lr_batch_sweep")[0][2]) == 4 * 3 * 5
    assert all(asked(q)[1]["n_iter"] == 100 for q in ("staged_predictions",))
    assert asked("adaboost")[1] == {"rounds": 100, "depth": 3} and asked("layered_stack")[1] == {"layers": 3, "width": 6}
    assert len(asked("random_search")[0][2]) == 20 and asked("truncated_svd")[0][1] == 100
