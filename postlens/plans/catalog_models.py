"""Registered queries, part two: feature selection, discriminants, text models,
reduction, cross-validation, search and stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.operators import combine as CB
from postlens.operators import evaluate as EV
from postlens.operators import search as SE
from postlens.operators import select as SEL
from postlens.operators import split as SP
from postlens.operators.models import discriminant as DA
from postlens.operators.models import knn as KNN
from postlens.operators.models import linear as LIN
from postlens.operators.models import text_models as TM
from postlens.plans import sqlfrag as S
from postlens.plans.catalog import _BAGS_SQL, _METRICS_SQL, MODELS, R6, SC, _counts_sql, _posts_lab, _toks, _vec, _votes, dense_split, fx_scores, r6, register
from postlens.operators import features as FE
from postlens.sources import table, train_posts

FOLDS = 3

_F_SQL = """WITH x AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
g AS (SELECT pos, label, count(*) AS n, sum(v) AS s, sum(v * v) AS q FROM x GROUP BY 1, 2),
t AS (SELECT pos, sum(n) AS n, count(*) AS k, sum(s) AS s, sum(q) AS q, sum(s * s / n) AS b FROM g GROUP BY pos),
f AS (SELECT pos, ((b - s * s / n) / (k - 1)) / ((q - b) / (n - k)) AS f FROM t)"""


@register("select_k_best_f", f"{_F_SQL} SELECT pos, {R6('f')} AS f, (row_number() OVER (ORDER BY f DESC, pos))::INT AS rank FROM f QUALIFY rank <= 20")
def q_best_f(spark, sf):
    e = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("pos", "value"))
    return r6(SEL.select_k_best_f(e.withColumn("pos", F.col("pos").cast("long")), 20), {"f"})


@register("select_k_best_chi2", f"""WITH c AS (SELECT t.term, p.label, t.tf FROM ({_counts_sql()}) t JOIN ({S.POSTS}) p ON t.id = p.id),
pr AS (SELECT label, count(*) / sum(count(*)) OVER () AS prior FROM ({S.POSTS}) GROUP BY label),
o AS (SELECT v.term, pr.label, pr.prior, coalesce(sum(c.tf), 0)::DOUBLE AS o FROM (SELECT DISTINCT term FROM c) v CROSS JOIN pr
      LEFT JOIN c ON c.term = v.term AND c.label = pr.label GROUP BY 1, 2, 3),
e AS (SELECT *, sum(o) OVER (PARTITION BY term) * prior AS e FROM o),
x AS (SELECT term, round(sum((o - e) * (o - e) / e), 9) AS chi2 FROM e GROUP BY term)
SELECT term, {R6('chi2')} AS chi2, (row_number() OVER (ORDER BY chi2 DESC, term))::INT AS rank FROM x QUALIFY rank <= 1000""")
def q_best_chi2(spark, sf):
    lab = _posts_lab(spark, sf)
    counts = FE.term_counts(_toks(spark, sf)).join(lab, "id")
    priors = lab.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    priors = priors.withColumn("prior", F.col("n") / lab.count()).select("label", "prior")
    scores = SEL.chi2(counts, priors).withColumn("chi2", F.round("chi2", 9))
    return r6(SEL._best(scores, "term", "chi2", 1000), {"chi2"})


@register("balanced_subsample_weights", f"""WITH g AS (SELECT bag::INT AS bag, label, sum(weight)::BIGINT AS n FROM ({_BAGS_SQL}) GROUP BY 1, 2 HAVING sum(weight) > 0)
SELECT bag, label, n, {R6('sum(n) OVER (PARTITION BY bag) / (count(*) OVER (PARTITION BY bag) * n)')} AS class_weight FROM g""")
def q_bsw(spark, sf):
    return r6(SP.balanced_subsample_weights(SP.bootstrap_bags(_posts_lab(spark, sf), 5, 42)), {"class_weight"})


_USER = {m: float(i + 1) for i, m in enumerate(MODELS)}


@register("set_weights", f"""SELECT id, {R6('sum(weight * prob) / sum(weight)')} AS prob FROM (SELECT id, prob, CASE model {' '.join(f"WHEN '{m}' THEN {w}" for m, w in _USER.items())} END AS weight FROM {SC}) GROUP BY id""")
def q_set_weights(spark, sf):
    x = CB.set_weights(fx_scores(spark, sf), _USER)
    return r6(x.groupBy("id").agg((F.sum(F.col("weight") * F.col("prob")) / F.sum("weight")).alias("prob")), {"prob"})


_WMF = ["model_disagreement", "confidence_gap", "prediction_variance", "mean_prediction", "median_prediction", "prediction_range"]


@register("weighted_meta_features", f"""WITH w AS (SELECT model, f1 / sum(f1) OVER () AS weight FROM ({_METRICS_SQL})),
x AS (SELECT s.id, s.model, s.prob * w.weight AS prob FROM {SC} s JOIN w ON s.model = w.model)
SELECT id, {', '.join(f"{R6(f'max(CASE WHEN model = {S.q(m)} THEN prob END)')} AS {m}_pred" for m in MODELS)},
 {R6('stddev_pop(prob)')} AS model_disagreement, {R6('max(prob) - min(prob)')} AS confidence_gap, {R6('var_pop(prob)')} AS prediction_variance,
 {R6('avg(prob)')} AS mean_prediction, {R6('median(prob)')} AS median_prediction, {R6('max(prob) - min(prob)')} AS prediction_range,
 sum(CASE WHEN prob > 0.5 THEN 1 ELSE 0 END)::BIGINT AS models_above_threshold FROM x GROUP BY id""")
def q_weighted_meta(spark, sf):
    w = CB.f1_weights(EV.binary_metrics(_votes(spark, sf), ["model"], prob_col=None))
    return r6(CB.weighted_meta_features(fx_scores(spark, sf), w, MODELS), set(_WMF) | {f"{m}_pred" for m in MODELS})


@register("prediction_analysis", f"""SELECT p.id, p.post, s.label, (s.prob >= 0.5)::INT AS prediction, {R6('greatest(s.prob, 1 - s.prob)')} AS confidence,
 {R6('1 - s.prob')} AS p0, {R6('s.prob')} AS p1 FROM ({S.POSTS}) p JOIN {SC} s ON p.id = s.id WHERE s.model = 'm_len'""")
def q_analysis(spark, sf):
    one = fx_scores(spark, sf).filter("model = 'm_len'")
    return r6(CB.prediction_analysis(train_posts(spark, sf), one), {"confidence", "p0", "p1"})


@register("example_predictions", f"""SELECT id, label, (prob >= 0.5)::INT AS prediction, {R6('prob')} AS prob FROM {SC} WHERE model = 'm_len' ORDER BY md5(concat(id, ':42')), id LIMIT 10""")
def q_examples(spark, sf):
    return r6(CB.example_predictions(fx_scores(spark, sf).filter("model = 'm_len'"), 10, 42), {"prob"})


@register("estimator_scores", f"SELECT id, model, (prob >= 0.5)::INT AS prediction, {R6('prob')} AS prob FROM {SC}")
def q_estimator_scores(spark, sf):
    return r6(fx_scores(spark, sf).select("id", "model", (F.col("prob") >= 0.5).cast("int").alias("prediction"), "prob"), {"prob"})


_NEAR_SQL = f"""WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS x, {S.md5_uniform_sql('vec_id', 42)} < 0.2 AS test FROM embeddings),
d AS (SELECT q.id AS qid, t.id AS nid, round(sqrt(list_sum(list_transform(list_zip(q.x, t.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))), 9) AS distance FROM e q JOIN e t ON q.test AND NOT t.test)
SELECT qid, nid, {R6('distance')} AS distance, (row_number() OVER (PARTITION BY qid ORDER BY distance, nid))::INT AS rank FROM d QUALIFY rank <= 5"""


@register("nearest_neighbors", _NEAR_SQL)
def q_near(spark, sf):
    tr, te = dense_split(spark, sf)
    return r6(KNN.nearest_neighbors(tr, te, k=5).select("qid", "nid", "distance", "rank"), {"distance"})


def _discriminant(quadratic: bool, reg: float):
    def fn(spark, sf):
        tr, te = dense_split(spark, sf)
        model = DA.discriminants(DA.class_moments(tr), quadratic, reg)
        return DA.score(te, model).select("id", "label", "prediction", F.round("prob", 6).alias("prob"))
    return fn


register("lda_classifier")(_discriminant(False, 0.0))
register("qda_classifier")(_discriminant(True, 0.1))


# ---------------------------------------------------------------- text -> TF-IDF -> model
def _text_query(make, parts=lambda n: 1):
    def fn(spark, sf):
        posts = SP.stratified_split(train_posts(spark, sf), 0.2, 42)
        train, val = posts.filter("split = 'train'"), posts.filter("split = 'val'")
        n = train.count()
        out = TM.predict_text_model(TM.fit_text_model(train, make(n), parts=parts(n)), val)
        out = LIN.positive_prob(out) if "probability" in out.columns else out.withColumn("prob", F.lit(None).cast("double"))
        return out.select("id", "label", F.col("prediction").cast("int").alias("prediction"), F.round("prob", 6).alias("prob"))
    return fn


register("text_logistic_regression")(_text_query(lambda n: LIN.logistic_regression(C=100.0, n=n)))
register("text_linear_svc")(_text_query(lambda n: LIN.linear_svc(C=100.0, n=n)))
register("text_random_forest")(_text_query(lambda n: LIN.random_forest(n_trees=100, max_depth=10), parts=lambda n: -(-n // TM.FOREST_ROWS)))


# ---------------------------------------------------------------- reduction
def _pca(spark, sf, k):
    from pyspark.ml.feature import PCA

    e = _vec(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x")))
    return PCA(k=k, inputCol="features", outputCol="pcs").fit(e), e


@register("pca")
def q_pca(spark, sf):
    from pyspark.ml.functions import vector_to_array

    m, e = _pca(spark, sf, 10)
    x = m.transform(e).select("id", F.posexplode(vector_to_array("pcs")).alias("pc", "value"))
    return x.select("id", "pc", F.round(F.abs("value"), 6).alias("abs_value"))  # a component's sign is free


@register("explained_variance")
def q_explained(spark, sf):
    m, _ = _pca(spark, sf, 64)
    rows, total = [], 0.0
    for i, v in enumerate(m.explainedVariance.toArray().tolist()):
        total += v
        rows.append((i, round(v, 6), round(total, 6)))
    return spark.createDataFrame(rows, "pc int, ratio double, cumulative double")


@register("pca_by_variance")
def q_pca_by_variance(spark, sf):
    from pyspark.ml.functions import vector_to_array

    m, e = _pca(spark, sf, 64)
    ratio = m.explainedVariance.toArray().cumsum()
    k = int((ratio < 0.95).sum()) + 1  # the fewest components that reach 95 %
    x = m.transform(e).select("id", F.posexplode(F.slice(vector_to_array("pcs"), 1, k)).alias("pc", "value"))
    return x.select("id", "pc", F.round(F.abs("value"), 6).alias("abs_value"))


# ---------------------------------------------------------------- folds, search, stacking
def _folded(spark, sf):
    tr, te = dense_split(spark, sf)
    u = F.conv(F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(":fold"))), 1, 8), 16, 10).cast("long")
    return _vec(tr).withColumn("fold", (u % FOLDS).cast("int")).select("id", "label", "features", "fold"), _vec(te).select("id", "label", "features")


def _lr(C=1.0, l1_ratio=0.0):
    return LIN.logistic_regression(C=C, n=1000, l1_ratio=l1_ratio)


@register("cross_validate")
def q_cv(spark, sf):
    return r6(SE.cross_validate(_folded(spark, sf)[0], _lr, FOLDS), {"accuracy", "macro_f1", "auc", "f1", "precision", "recall"})


def _search_table(spark, found):
    return spark.createDataFrame([(i + 1, str(sorted(c.items())), round(m, 6)) for i, (c, m) in enumerate(found)], "rank int, params string, macro_f1 double")


@register("grid_search")
def q_grid(spark, sf):
    return _search_table(spark, SE.search(_folded(spark, sf)[0], _lr, SE.grid({"C": [0.1, 1.0, 10.0], "l1_ratio": [0.0, 1.0]}), FOLDS))


@register("random_search")
def q_random(spark, sf):
    import random

    rng = random.Random(42)
    return _search_table(spark, SE.search(_folded(spark, sf)[0], _lr, [{"C": 10 ** rng.uniform(-2, 2), "l1_ratio": rng.random()} for _ in range(20)], FOLDS))


@register("halving_search")
def q_halving(spark, sf):
    h = SE.halving_search(_folded(spark, sf)[0], _lr, SE.grid({"C": [10.0 ** (i / 2) for i in range(-4, 5)]}), FOLDS, factor=3, start=1 / 9)
    return spark.createDataFrame([(r, s, str(sorted(c.items())), round(m, 6)) for r, s, c, m in h], "round int, share double, params string, macro_f1 double")


@register("stack_meta")
def q_stack(spark, sf):
    tr, te = _folded(spark, sf)
    members = {"lr": _lr, "lasso": lambda: _lr(0.1, 1.0), "tree": lambda: LIN.decision_tree(max_depth=5)}
    return SE.stack_meta(tr, members, _lr, FOLDS, te)
