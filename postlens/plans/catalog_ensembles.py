"""Registered queries, part three: ensembles, calibration, sweeps, reduction of text,
synthetic rows, batch scoring."""

from __future__ import annotations

import time

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.operators import evaluate as EV
from postlens.operators import features as FE
from postlens.operators import search as SE
from postlens.operators import split as SP
from postlens.operators import synth as SY
from postlens.operators.models import ensembles as EN
from postlens.operators.models import linear as LIN
from postlens.operators.models import trees as TR
from postlens.plans import sqlfrag as S
from postlens.plans.catalog import MODELS, R6, _toks, _vec, dense_split, fx_scores, r6, register
from postlens.plans.catalog_models import FOLDS, _folded, _lr
from postlens.sources import train_posts

DIM = 64


def _dense(spark, sf):
    tr, te = dense_split(spark, sf)
    return _vec(tr).select("id", "label", "features"), _vec(te).select("id", "label", "features")


def _tree(depth=5):
    return lambda weight=None: LIN.decision_tree(max_depth=depth, weight_col=weight)


_MEMBERS = {"lr": _lr, "lasso": lambda: _lr(0.1, 1.0), "tree": _tree(5)}


# ---------------------------------------------------------------- bagging, boosting
@register("bagging")
def q_bagging(spark, sf):
    tr, te = _dense(spark, sf)
    members = EN.bagging(tr, _tree(5), bags=10, feature_fraction=0.8, dim=DIM)
    return EN.verdict(EN.score_bagging(members, te), EN.mean_of(f"p{i}" for i in range(10)))


@register("bagged_logistic")
def q_bagged_logistic(spark, sf):
    tr, te = _dense(spark, sf)
    members = EN.bagging(tr, lambda w: LIN.logistic_regression(C=1.0, n=1000, weight_col=w), bags=5)
    return EN.verdict(EN.score_bagging(members, te), EN.mean_of(f"p{i}" for i in range(5)))


@register("adaboost")
def q_adaboost(spark, sf):
    tr, te = _dense(spark, sf)
    return EN.score_adaboost(EN.adaboost(tr, rounds=100, depth=3), te)


@register("boosting_estimators")
def q_boosting_estimators(spark, sf):
    rows = [(i, round(a, 6), round(e, 6)) for i, (_, a, e) in enumerate(EN.adaboost(_dense(spark, sf)[0], rounds=10, depth=1))]
    return spark.createDataFrame(rows, "estimator int, weight double, error double")


_STAGES = (10, 50, 100)


def _staged(spark, sf):
    tr, te = _dense(spark, sf)
    return EN.staged_predictions(LIN.gradient_boosting(n_iter=100).fit(tr), te, _STAGES)


@register("staged_predictions")
def q_staged(spark, sf):
    return _staged(spark, sf)


@register("extra_trees")
def q_extra_trees(spark, sf):
    tr, te = dense_split(spark, sf)
    return EN.verdict(TR.score_trees(TR.fit_extra_trees(tr, DIM, n_trees=100), te), F.col("prob"))


_BOOST = {"n_iter": 100, "rate": 0.1, "max_depth": 6, "subsample": 0.8, "colsample": 0.8}


def _held(tr):
    """A fifth of the training rows, by hash, only to be judged on."""
    return SP.train_val_split(tr, 0.2, 7).withColumn("held", F.col("split") == "val").drop("split")


@register("gradient_boosting")
def q_gradient_boosting(spark, sf):
    tr, te = dense_split(spark, sf)
    m = TR.fit_boosting(tr, DIM, **_BOOST)
    return EN.verdict(TR.score_trees(m.trees, te, combine="sum", start=m.start), F.col("prob"))


@register("boosting_early_stop")
def q_early_stop(spark, sf):
    tr, te = dense_split(spark, sf)
    m = TR.fit_boosting(_held(tr), DIM, **_BOOST, patience=10, held_col="held")
    out = EN.verdict(TR.score_trees(m.trees[:m.best], te, combine="sum", start=m.start), F.col("prob"))
    return out.withColumn("n_trees", F.lit(m.best)).withColumn("n_grown", F.lit(len(m.trees)))


@register("best_iteration")
def q_best_iteration(spark, sf):
    """Losses after every tree of one run; the tree count of least held loss, and what each tree brought."""
    m = TR.fit_boosting(_held(dense_split(spark, sf)[0]), DIM, **_BOOST, held_col="held")
    t = spark.createDataFrame(m.losses, "trees int, train_loss double, held_loss double")
    step = Window.orderBy("trees")  # one row per tree, not per post
    t = t.withColumn("improvement", F.lag("held_loss").over(step) - F.col("held_loss")).withColumn("is_best", F.col("trees") == m.best)
    return r6(t, {"train_loss", "held_loss", "improvement"})


@register("averaged_importance")
def q_averaged_importance(spark, sf):
    tr, _ = _dense(spark, sf)
    makes = {"forest": LIN.random_forest(20, 6), "extra": LIN.extra_trees(20, 6), "boosted": LIN.gradient_boosting(10)}
    rows = [(m, i, v) for m, e in makes.items() for i, v in enumerate(e.fit(tr).featureImportances.toArray().tolist())]
    x = spark.createDataFrame(rows, "model string, feature int, importance double")
    return r6(x.groupBy("feature").agg(F.avg("importance").alias("importance")), {"importance"})


@register("tree_rules_depth")
def q_tree_rules(spark, sf):
    m = LIN.decision_tree(max_depth=4).fit(_dense(spark, sf)[0])
    rules = [x for x in m.toDebugString.split("\n")[1:] if x.strip()]
    rows = [(i, len(x) - len(x.lstrip()), x.strip(), m.depth, m.numNodes) for i, x in enumerate(rules)]
    return spark.createDataFrame(rows, "line int, indent int, rule string, depth int, nodes int")


@register("rfe")
def q_rfe(spark, sf):
    rows = EN.rfe(_dense(spark, sf)[0], lambda: LIN.random_forest(20, 5), DIM, keep=16, step=16)
    last = max(r for _, r in rows)
    return spark.createDataFrame([(f, r, r == last) for f, r in rows], "feature int, round int, selected boolean")


# ---------------------------------------------------------------- calibration, blends
@register("platt_calibration")
def q_platt(spark, sf):
    tr, te = _folded(spark, sf)
    return EN.score_calibrated(EN.platt_calibration(tr, lambda: LIN.linear_svc(C=1.0, n=1000), FOLDS), te)


@register("score_any_model")
def q_score_any(spark, sf):
    tr, te = _dense(spark, sf)
    for name, make in {"lr": _lr(), "svc": LIN.linear_svc(C=1.0, n=1000), "tree": LIN.decision_tree(5)}.items():
        te = EN.score_any_model(make.fit(tr), te, name)
    return te.select("id", "label", *[F.round(c, 6).alias(c) for c in ("lr", "svc", "tree")])


@register("blend_holdout")
def q_blend(spark, sf):
    tr, te = _dense(spark, sf)
    return EN.blend_holdout(tr, te, _MEMBERS, _lr)


@register("layered_stack")
def q_layered(spark, sf):
    return EN.layered_stack(*_dense(spark, sf), layers=3, width=6)[0]


@register("layer_score")
def q_layer_score(spark, sf):
    found = EN.layer_scores(EN.layered_stack(*_dense(spark, sf))[1])
    return spark.createDataFrame([(i, round(f, 6)) for i, f in found], "layer int, macro_f1 double")


@register("ensemble_prune")
def q_prune(spark, sf):
    rows = EN.ensemble_prune(fx_scores(spark, sf), list(MODELS))
    return r6(spark.createDataFrame(rows, "step int, left_out string, macro_f1 double, taken boolean"), {"macro_f1"})


# ---------------------------------------------------------------- sweeps
@register("logistic_cv")
def q_logistic_cv(spark, sf):
    tr, te = _folded(spark, sf)
    best = SE.search(tr, _lr, SE.grid({"C": [0.01, 0.1, 1.0, 10.0]}), FOLDS)[0][0]
    out = EN.verdict(EN.with_prob(_lr(**best).fit(tr), te, "_p"), F.col("_p"))
    return out.withColumn("best_c", F.lit(best["C"]))


def _f1(model, df):
    scored = EN.verdict(EN.with_prob(model, df, "_p"), F.col("_p"))
    return round(float(EV.binary_metrics(scored, prob_col=None).first()["macro_f1"]), 6)


@register("one_param_sweep")
def q_sweep(spark, sf):
    tr, te = _dense(spark, sf)
    rows = []
    for depth in (2, 4, 6, 8):
        m = LIN.decision_tree(max_depth=depth).fit(tr)
        rows.append(("max_depth", float(depth), _f1(m, tr), _f1(m, te)))
    return spark.createDataFrame(rows, "param string, value double, train_f1 double, test_f1 double")


@register("multi_seed_benchmark")
def q_multi_seed(spark, sf):
    rows = []
    for seed in (1, 2, 3):
        tr, te = (_vec(d).select("id", "label", "features") for d in dense_split(spark, sf, seed))
        for name, make in {"lr": _lr(), "tree": LIN.decision_tree(5, seed=seed), "forest": LIN.random_forest(20, 6, seed=seed)}.items():
            start = time.monotonic()
            f1 = _f1(make.fit(tr), te)
            rows.append((name, seed, f1, time.monotonic() - start))
    return spark.createDataFrame(rows, "algorithm string, seed int, macro_f1 double, seconds double")


def _gd_verdict(te, w, b):
    return EN.verdict(LIN.score_linear(te, w, b), F.col("prob"))


@register("gd_logistic_l2")
def q_gd_l2(spark, sf):
    tr, te = dense_split(spark, sf)
    w, b, _ = LIN.gd_logistic(tr, DIM, epochs=1000, lr=0.01, batch=64, l2=0.01, tol=1e-6)
    return _gd_verdict(te, w, b)


@register("gd_logistic_weighted")
def q_gd_weighted(spark, sf):
    tr, te = dense_split(spark, sf)
    w, b, _ = LIN.gd_logistic(SP.sample_weights(tr), DIM, epochs=1000, lr=0.01, batch=64, l2=0.01, weight_col="weight")
    return _gd_verdict(te, w, b)


@register("history_table")
def q_history(spark, sf):
    _, _, hist = LIN.gd_logistic(dense_split(spark, sf)[0], DIM, epochs=1000, lr=0.01, batch=64)
    return spark.createDataFrame([(e, round(v, 6)) for e, v in hist], "epoch int, loss double")


@register("lr_batch_sweep")
def q_lr_batch(spark, sf):
    tr = SP.stratified_kfold(dense_split(spark, sf)[0], 5, 42)
    grid = [(rate, batch, k) for rate in (0.001, 0.01, 0.1, 0.2) for batch in (16, 32, 64) for k in range(5)]
    found = LIN.gd_logistic_many(tr, DIM, grid, epochs=1000, fold_col="fold")
    keys = [(rate, batch, k, round(hist[-1][1], 6) if hist else None) for (rate, batch, k), (_, _, hist) in zip(grid, found)]
    scored = LIN.score_many(tr, found, keys, "rate double, batch int, fold int, loss double")
    scored = scored.withColumn("prediction", (F.col("prob") >= 0.5).cast("int"))
    return r6(EV.binary_metrics(scored, ["rate", "batch", "fold", "loss"], prob_col=None).select("rate", "batch", "fold", "macro_f1", "loss"), {"macro_f1"})


_STEP_SQL = f"""
WITH t AS (SELECT embedding::DOUBLE[] AS x, CASE WHEN label < 5 THEN 1.0 ELSE 0.0 END AS y FROM embeddings WHERE NOT ({S.md5_uniform_sql('vec_id', 42)} < 0.2)),
i AS (SELECT unnest(range(1, {DIM + 1})) AS i),
w1 AS (SELECT list(0.5 * g ORDER BY i) AS w, 0.5 * any_value(h) AS b FROM (SELECT i, avg((y - 0.5) * x[i]) AS g, avg(y - 0.5) AS h FROM t, i GROUP BY i)),
p AS (SELECT x, y, y - 1 / (1 + exp(-(list_dot_product(x, w) + b))) AS e FROM t, w1)
SELECT (i - 1)::INT AS feature, {R6('any_value(w[i]) + 0.5 * avg(e * x[i])')} AS weight FROM p, i, w1 GROUP BY i
UNION ALL SELECT {DIM} AS feature, {R6('any_value(b) + 0.5 * avg(e)')} AS weight FROM p, w1
"""


@register("gd_full_batch_weights", _STEP_SQL)
def q_gd_full(spark, sf):
    w, b, _ = LIN.gd_logistic(dense_split(spark, sf)[0], DIM, epochs=2, lr=0.5, batch=None, partitions=3)
    return spark.createDataFrame([(i, round(float(v), 6)) for i, v in enumerate([*w, b])], "feature int, weight double")


# ---------------------------------------------------------------- text reduction, vectors
def _text_svd(spark, sf, k=100, max_features=5000):
    """``id, pcs``: posts on the first k right singular vectors of their TF-IDF
    (those of the training posts), and the singular values."""
    posts = SP.stratified_split(train_posts(spark, sf), 0.2, 42).select("id", "label", "split", "post")
    counts = FE.term_counts(FE.tokenize_words(posts, "post")).persist()
    ids = posts.select("id", "label", "split").persist()
    own = counts.join(ids.filter("split = 'train'").select("id"), "id", "left_semi")
    n = ids.filter("split = 'train'").count()
    vocab = FE.build_vocabulary(own, n_docs=n, min_df=2, max_df=1.0, max_features=max_features).persist()
    values = FE.tfidf(counts, vocab, n).select("id", "idx", "value")
    train = ids.filter("split = 'train'").select("id")
    v, s = SY.truncated_svd(FE.to_vectors(values.join(train, "id", "left_semi"), vocab.count(), ids=train), k)
    return ids, SY.project(values, v, ids.select("id")), s


@register("truncated_svd")
def q_svd(spark, sf):
    _, x, _ = _text_svd(spark, sf)
    x = x.select("id", F.posexplode("pcs").alias("pc", "value"))
    return x.select("id", "pc", F.round(F.abs("value"), 6).alias("abs_value"))  # a component's sign is free


@register("svd_logistic_pipeline")
def q_svd_lr(spark, sf):
    ids, x, _ = _text_svd(spark, sf)
    rows = ids.join(x, "id").withColumn("features", array_to_vector("pcs"))
    tr = SP.sample_weights(rows.filter("split = 'train'").select("id", "label", "features"))
    model = LIN.logistic_regression(C=1.0, n=tr.count(), weight_col="weight").fit(tr)
    return EN.verdict(EN.with_prob(model, rows.filter("split = 'val'"), "_p"), F.col("_p"))


@register("word2vec_mean")
def q_word2vec(spark, sf):
    return FE.word2vec_mean(_toks(spark, sf).select("id", "tokens"))


# ---------------------------------------------------------------- synthetic rows, batch scoring
@register("smote")
def q_smote(spark, sf):
    x = SY.smote(dense_split(spark, sf)[0], k=5, seed=42)
    return x.select("id", "copy", "neighbor", F.round("u", 6).alias("u"), F.transform("x", lambda v: F.round(v, 6)).alias("x"), "label")


@register("score_batch", f"""SELECT id, {R6('1 / (1 + exp(6.0 - length(post)::DOUBLE / len(string_split(post, chr(32)))))')} AS prob FROM ({S.POSTS})""")
def q_score_batch(spark, sf):
    import numpy as np

    def linear(texts):  # of the mean length of a word with its blank
        return 1 / (1 + np.exp(6.0 - np.array([len(t) / (t.count(" ") + 1) for t in texts])))

    return r6(SY.score_batch(train_posts(spark, sf).select("id", "post"), linear), {"prob"})
