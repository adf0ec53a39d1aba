"""Saved models, prediction files, reports and the runner."""

import os
import shutil

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from postlens.operators import runner as RU
from postlens.operators.models import discriminant as DA
from postlens.operators.models import linear as LIN
from postlens.operators.models import trees as TR
from postlens.operators.models.nb import NBModel, score_nb
from postlens.sources import write_predictions
from postlens.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def dense(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(i % 2, 1.0, 4)], i % 2) for i in range(200)]
    return spark.createDataFrame(rows, "id long, x array<double>, label int").withColumn("features", array_to_vector("x")).persist()


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select("id", *cols).collect())


def test_mllib_models_pipelines_and_lists_of_them(spark, dense, tmp_path):
    lone = LogisticRegression().fit(dense)
    pipe = Pipeline(stages=[StandardScaler(inputCol="features", outputCol="s"), LogisticRegression(featuresCol="s")]).fit(dense)
    for name, model in (("lone", lone), ("pipe", pipe)):
        save_model(spark, model, f"{tmp_path}/{name}")
        back = load_model(spark, f"{tmp_path}/{name}")
        assert type(back) is type(model)
        assert rows_of(back.transform(dense), "probability") == rows_of(model.transform(dense), "probability")
    save_model(spark, [(0.25, lone), (0.75, pipe)], f"{tmp_path}/members")
    (a, m), (b, n) = load_model(spark, f"{tmp_path}/members")
    assert (a, b) == (0.25, 0.75) and rows_of(n.transform(dense), "prediction") == rows_of(pipe.transform(dense), "prediction")
    assert list(m.coefficients) == list(lone.coefficients)


def test_own_models(spark, dense, tmp_path):
    w, b, hist = LIN.gd_logistic(dense, 4, epochs=3, lr=0.1, batch=16)
    save_model(spark, (w, b, hist), f"{tmp_path}/gd")
    w2, b2, hist2 = load_model(spark, f"{tmp_path}/gd")
    assert list(w2) == list(w) and b2 == b and [tuple(h) for h in hist2] == [tuple(h) for h in hist]
    assert rows_of(LIN.score_linear(dense, w2, b2), "prob") == rows_of(LIN.score_linear(dense, w, b), "prob")

    model = DA.discriminants(DA.class_moments(dense), True, 0.1)
    save_model(spark, model, f"{tmp_path}/qda")
    assert rows_of(DA.score(dense, load_model(spark, f"{tmp_path}/qda")), "prob") == rows_of(DA.score(dense, model), "prob")

    trees = TR.fit_extra_trees(dense, 4, n_trees=3)
    save_model(spark, trees, f"{tmp_path}/trees")
    assert load_model(spark, f"{tmp_path}/trees") == trees

    nb = NBModel(spark.createDataFrame([("a", 0, -1.0), ("a", 1, -2.0), ("b", 0, -3.0), ("b", 1, -0.5)], "term string, label int, logp double"),
                 spark.createDataFrame([(0, -0.7), (1, -0.7)], "label int, logprior double"))
    save_model(spark, nb, f"{tmp_path}/nb")
    counts = spark.createDataFrame([(1, "a", 2), (2, "b", 1), (2, "zz", 4)], "id long, term string, tf int")
    docs = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    back = load_model(spark, f"{tmp_path}/nb")
    assert back.kind == "multinomial" and rows_of(score_nb(back, counts, docs), "prob") == rows_of(score_nb(nb, counts, docs), "prob")


def test_versions(spark, tmp_path):
    path = f"{tmp_path}/m"
    with pytest.raises(Exception):
        load_model(spark, path)
    first = save_model(spark, {"w": np.array([[1, 2], [3, 4]]), 2: None, "none": []}, path)
    old = load_model(spark, path)
    assert old["w"].tolist() == [[1, 2], [3, 4]] and old["w"].dtype == np.int64 and old[2] is None and old["none"] == []
    save_model(spark, {"w": 2}, path)
    assert load_model(spark, path) == {"w": 2}
    assert load_model(spark, path, first)["w"].tolist() == [[1, 2], [3, 4]]
    # a save that died before its manifest row does not count
    with pytest.raises(TypeError):
        save_model(spark, {"w": spark.range(3), "bad": object()}, path)
    shutil.copytree(f"{path}/{first}", f"{path}/{'f' * 32}")
    assert load_model(spark, path) == {"w": 2}
    with pytest.raises(ValueError):
        load_model(spark, path, "0" * 32)


def test_only_own_classes_load(spark, tmp_path):
    from postlens.sources.models import _decode

    with pytest.raises(ValueError):
        _decode({"class": "subprocess:Popen", "fields": {}}, None)


def test_prediction_files_are_in_order(spark, tmp_path):
    df = spark.createDataFrame([(i * 7 % 500, float(i % 2)) for i in range(500)], "id long, prediction double").repartition(5)
    write_predictions(df, f"{tmp_path}/p")
    parts = sorted(f for f in os.listdir(f"{tmp_path}/p") if f.endswith(".csv"))
    ids = []
    for f in parts:
        head, *lines = open(f"{tmp_path}/p/{f}").read().splitlines()
        assert head == "id,label"
        ids += [int(x.split(",")[0]) for x in lines]
    assert ids == list(range(500))


def test_failures_cost_their_own_row_only(spark):
    rows = spark.createDataFrame([(1, 1), (0, 0), (1, 0), (0, 0)], "label int, prediction int")

    def broken():
        raise RuntimeError("no such file\nsecond line")

    runs = {"good": lambda: rows, "broken": broken, "typo": lambda: rows.select("labl"), "bare": lambda: rows.limit(0), "nothing": lambda: None,
            "task": lambda: rows.select("label", F.raise_error(F.lit("in a task")).cast("int").alias("prediction")),
            "best": lambda: rows.select("label", F.col("label").alias("prediction"))}
    got = {r.pipeline: r for r in RU.rank_outcomes(RU.run_all(spark, runs)).collect()}
    assert {k: r.status for k, r in got.items()} == {"good": "ok", "broken": "failed", "typo": "failed", "bare": "empty", "nothing": "failed", "task": "failed", "best": "ok"}
    assert got["broken"].error == "RuntimeError: no such file" and "UNRESOLVED_COLUMN" in got["typo"].error
    assert (got["best"].rank, got["best"].gap, got["good"].rank) == (1, 0.0, 2) and abs(got["good"].gap - 1 / 3) < 1e-9
    assert got["good"].n == 4 and got["task"].n is None and got["task"].rank is None and all(r.seconds >= 0 for r in got.values())
