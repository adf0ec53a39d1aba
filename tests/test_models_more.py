"""Invariants of feature selection, discriminants, text models, search and stacking."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01, SF001


def test_chi2_against_counts(spark):
    from postlens.operators.select import chi2

    rows = [("a", 0, 5), ("a", 1, 1), ("b", 1, 4), ("c", 0, 2), ("c", 1, 2)]
    priors = {0: 0.7, 1: 0.3}
    df = spark.createDataFrame(rows, "term string, label int, tf long")
    got = {r.term: r.chi2 for r in chi2(df, spark.createDataFrame(list(priors.items()), "label int, prior double")).collect()}
    for t in "abc":
        o = {y: sum(n for a, b, n in rows if (a, b) == (t, y)) for y in priors}
        e = {y: p * sum(o.values()) for y, p in priors.items()}
        assert abs(got[t] - sum((o[y] - e[y]) ** 2 / e[y] for y in priors)) < 1e-9


def test_anova_edge_features(spark):
    from postlens.operators.select import anova_f, select_k_best_f

    rows = [("const", y, 1.0) for y in (0, 0, 1, 1)] + [("good", 0, 0.0), ("good", 0, 0.1), ("good", 1, 1.0), ("good", 1, 1.1)] + [("one class", 0, 1.0), ("one class", 0, 2.0)]
    df = spark.createDataFrame(rows, "pos string, label int, value double")
    got = {r.pos: r.f for r in anova_f(df).collect()}
    assert got["const"] is None and "one class" not in got and got["good"] > 100
    assert [r.pos for r in select_k_best_f(df, 5).collect()] == ["good"]


@pytest.mark.parametrize("quadratic", [False, True])
def test_discriminant_separates_planted_classes(spark, quadratic):
    from postlens.operators.models import discriminant as DA

    rng = np.random.default_rng(0)
    rows = [(i, i % 2, [float(v) for v in rng.normal(i % 2 * 2.0, 1 + (i % 2), 4)]) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, label int, x array<double>").repartition(4)
    m = DA.class_moments(df)
    x = np.array([r[2] for r in rows if r[1] == 1])
    assert m[1][0] == len(x) and np.allclose(m[1][1], x.sum(axis=0)) and np.allclose(m[1][2], x.T @ x)
    out = DA.score(df, DA.discriminants(m, quadratic))
    assert out.filter("prediction = label").count() / len(rows) > 0.9
    assert out.filter("prob < 0 or prob > 1").count() == 0


def test_text_models_beat_the_majority(spark):
    """Bad documents (quality 0) are told by their words better than by chance."""
    from postlens.operators import evaluate as EV
    from postlens.operators import split as SP
    from postlens.operators.models import linear as LIN
    from postlens.operators.models import text_models as TM
    from postlens.sources import train_posts

    posts = SP.stratified_split(train_posts(spark, SF01), 0.3, 42)
    train, val = posts.filter("split = 'train'"), posts.filter("split = 'val'")
    out = TM.predict_text_model(TM.fit_text_model(train, LIN.logistic_regression(C=1000.0, n=train.count())), val)
    out = LIN.positive_prob(out).select("id", "label", "prediction", "prob")
    n, pos = val.count(), val.filter("label = 1").count()
    assert out.count() == n  # every post comes out, with or without a known word
    majority = (n - pos) / (n - pos + pos / 2) / 2  # macro F1 of always saying 0
    m = EV.binary_metrics(out).first()
    assert m.macro_f1 > majority and m.auc > 0.5


def test_no_meta_row_was_seen_by_its_model(spark):
    """A member that remembers its training ids finds none of them when it scores."""
    from pyspark.ml.functions import array_to_vector

    from postlens.operators.search import out_of_fold

    df = spark.range(60).select("id", (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 3).cast("int").alias("fold"),
                                array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))

    class Memory:
        def fit(self, train):
            self.ids = {r.id for r in train.select("id").collect()}
            return self

        def transform(self, test):
            assert not self.ids & {r.id for r in test.select("id").collect()}
            return test.withColumn("probability", array_to_vector(F.array(F.lit(0.5), F.lit(0.5)))).withColumn("prediction", F.lit(0.0))

    out = out_of_fold(df, Memory, 3)
    assert out.count() == 60 and out.select("id").distinct().count() == 60


def test_halving_keeps_the_best(spark):
    from postlens.plans.catalog_models import q_halving

    rows = q_halving(spark, SF001).collect()
    rounds = sorted({r["round"] for r in rows})
    for a, b in zip(rounds, rounds[1:]):
        best = [r.params for r in sorted((r for r in rows if r["round"] == a), key=lambda r: -r.macro_f1)]
        later = {r.params for r in rows if r["round"] == b}
        assert len(later) == max(1, len(best) // 3) and later <= set(best)


def test_set_weights_wants_every_model(spark):
    from postlens.operators.combine import set_weights

    s = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.5)], "id long, model string, prob double")
    assert set_weights(s, {"a": 1, "b": 2}).count() == 2
    with pytest.raises(ValueError):
        set_weights(s, {"a": 1})


def test_ascii_folding_and_one_hot(spark):
    from postlens.functions.text import strip_accents_lower
    from postlens.operators.hygiene import one_hot

    df = spark.createDataFrame([("Café ωμέγα 東京 ậ ＡＢ",)], "t string")
    assert df.select(strip_accents_lower("t").alias("x")).first().x == "cafe   a ab"
    rows = one_hot(spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "id long, c string"), "c").collect()
    assert sorted((r.id, r.category, r.hot) for r in rows if r.id < 3) == [(1, "a", 1), (1, "zz", 0), (2, "a", 0), (2, "zz", 1)]
    assert not any(r.hot for r in rows if r.id == 3)


def test_posts_without_known_words_keep_their_row(spark):
    from postlens.operators.features import to_vectors

    ids = spark.createDataFrame([(1,), (2,)], "id long")
    long_df = spark.createDataFrame([(1, 0, 0.5), (1, 2, 0.5)], "id long, idx int, value double")
    got = {r.id: r.features for r in to_vectors(long_df, 3, ids=ids).collect()}
    assert got[1].toArray().tolist() == [0.5, 0.0, 0.5] and got[2].numNonzeros() == 0
