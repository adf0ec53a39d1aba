"""Ensembles over MLlib models: bagging, boosting, calibration, blending, layers.

Members are fitted in a driver loop (a handful of fits, each distributed); scoring
chains the members' ``transform`` over one scan, one column per member, so no
member costs a scan or a union branch of its own.  The driver holds models and a
few numbers per member, never rows."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterable

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.hashing import md5_bucket, md5_uniform
from postlens.functions.text import activation_expand
from postlens.operators import evaluate as EV
from postlens.operators.models.linear import LOCAL_ROWS
from postlens.operators.split import bootstrap_bags
from postlens.sources import written


def with_prob(model, df: DataFrame, out: str) -> DataFrame:
    """``df`` and the model's probability of class 1, no other new column."""
    m = model.copy().setPredictionCol("").setRawPredictionCol("").setProbabilityCol("__p")
    return m.transform(df).withColumn(out, F.round(vector_to_array("__p")[1], 9)).drop("__p")


def with_margin(model, df: DataFrame, out: str) -> DataFrame:
    """``df`` and the model's raw margin of class 1."""
    m = model.copy().setPredictionCol("").setRawPredictionCol("__m")
    return m.transform(df).withColumn(out, vector_to_array("__m")[1]).drop("__m")


def mean_of(cols: Iterable[str]) -> Column:
    cols = list(cols)
    return sum((F.col(c) for c in cols), F.lit(0.0)) / len(cols)


def verdict(df: DataFrame, prob: Column) -> DataFrame:
    """``id, label, prediction, prob``; class 1 from one half on."""
    p = F.round(prob, 6)
    return df.select("id", "label", (p >= 0.5).cast("int").alias("prediction"), p.alias("prob"))


def score_any_model(model, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability where the model has one, else its margin scaled to 0..1 over
    ``df`` (one half where all margins are equal), else the predicted label."""
    if hasattr(model, "setProbabilityCol"):
        return with_prob(model, df, out)
    if hasattr(model, "setRawPredictionCol"):
        x = with_margin(model, df, out)
        lo, hi = x.agg(F.min(out), F.max(out)).first()
        return x.withColumn(out, F.lit(0.5) if lo is None or lo == hi else (F.col(out) - lo) / (hi - lo))
    return model.transform(df).withColumnRenamed("prediction", out)


# ------------------------------------------------------------------ bagging
def bagging(train: DataFrame, make: Callable, bags: int = 10, seed: int = 42, feature_fraction: float = 1.0, dim: int | None = None) -> list:
    """``(model, feature positions or None)`` per bag.  ``make(weight_col)`` gives the
    estimator; a bag's rows count by their Poisson(1) multiplicity, and a bag sees a
    seeded choice of ``feature_fraction`` of the ``dim`` features."""
    rows, out = bootstrap_bags(train, bags, seed).filter("weight > 0"), []
    for b in range(bags):
        one, at = rows.filter(F.col("bag") == b).withColumn("weight", F.col("weight").cast("double")), None
        if feature_fraction < 1:
            at = sorted(random.Random(seed * 1000 + b).sample(range(dim), max(1, round(feature_fraction * dim))))
            one = VectorSlicer(inputCol="features", outputCol="_some", indices=at).transform(one).drop("features").withColumnRenamed("_some", "features")
        out.append((make("weight").fit(one), at))
    return out


def score_bagging(members: list, df: DataFrame) -> DataFrame:
    """``df`` with one probability column ``p<i>`` per bag."""
    for i, (m, at) in enumerate(members):
        if at is None:
            df = with_prob(m, df, f"p{i}")
        else:
            x = VectorSlicer(inputCol="features", outputCol="_some", indices=at).transform(df)
            df = with_prob(m.copy().setFeaturesCol("_some"), x, f"p{i}").drop("_some")
    return df


# ----------------------------------------------------------------- boosting
def adaboost(train: DataFrame, rounds: int = 10, depth: int = 1, rate: float = 1.0) -> list[tuple]:
    """Discrete two-class AdaBoost: ``(tree, weight, error)`` per round.  A tree
    without error ends the loop with weight 1; so does one no better than chance,
    which is left out unless it is the first."""
    n = train.count()
    # a round is half a dozen jobs: a small table is one task in each of them
    cur, out = train.select("id", "label", "features").coalesce(max(1, n // LOCAL_ROWS)).withColumn("w", F.lit(1.0 / max(n, 1))).persist(), []
    for _ in range(rounds):
        tree = DecisionTreeClassifier(maxDepth=depth, weightCol="w", seed=42).fit(cur)
        said = tree.copy().setProbabilityCol("").setRawPredictionCol("").transform(cur)
        miss = (F.col("prediction") != F.col("label")).cast("double")
        wrong, total = said.agg(F.sum(F.col("w") * miss), F.sum("w")).first()
        error = wrong / total
        if error <= 0:
            out.append((tree, 1.0, 0.0))
            break
        if error >= 0.5:
            out += [] if out else [(tree, 1.0, error)]
            break
        alpha = rate * math.log((1 - error) / error)
        out.append((tree, alpha, error))
        mass = total - wrong + wrong * math.exp(alpha)
        nxt = said.select("id", "label", "features", (F.col("w") * F.exp(alpha * miss) / mass).alias("w"))
        # the next weights rest on these: a chain of 100 rounds overflows the scheduler, ten do not
        if len(out) % 10 == 0:
            nxt = written(nxt)
        else:
            nxt.persist().count()
        cur.unpersist()
        cur = nxt
    cur.unpersist()
    return out


def score_adaboost(members: list[tuple], df: DataFrame) -> DataFrame:
    """``id, label, prediction, prob``: sigmoid of the weighted vote of -1 and 1."""
    for i, (tree, _, _) in enumerate(members):
        df = tree.copy().setPredictionCol(f"t{i}").setProbabilityCol("").setRawPredictionCol("").transform(df)
    vote = sum((F.lit(a) * (F.col(f"t{i}") * 2 - 1) for i, (_, a, _) in enumerate(members)), F.lit(0.0))
    return verdict(df, F.lit(1.0) / (F.lit(1.0) + F.exp(-vote)))


def staged_predictions(model, df: DataFrame, stages: Iterable[int]) -> DataFrame:
    """``id, label, stage, prediction, prob`` of a boosted model after the first
    ``stage`` trees; all trees are applied once, the stages are partial sums."""
    weights, stages = model.treeWeights, [s for s in stages if s <= model.getNumTrees]
    for i, tree in enumerate(model.trees):
        df = tree.copy().setPredictionCol(f"t{i}").transform(df)
    margin = lambda s: sum((F.lit(weights[i]) * F.col(f"t{i}") for i in range(s)), F.lit(0.0))
    prob = lambda s: F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-2.0 * margin(s))), 6)
    x = df.select("id", "label", F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), prob(s).alias("prob")) for s in stages])).alias("s"))
    return x.select("id", "label", "s.stage", (F.col("s.prob") >= 0.5).cast("int").alias("prediction"), "s.prob")


# -------------------------------------------------------------- calibration
def platt_calibration(train: DataFrame, make: Callable, folds: int = 3, fold_col: str = "fold") -> list[tuple]:
    """``(margin model, sigmoid model)`` per fold: the margin model is fitted on the
    other folds, the one-feature sigmoid on its margins of the fold left out."""
    out = []
    for k in range(folds):
        base = make().fit(train.filter(F.col(fold_col) != k))
        held = with_margin(base, train.filter(F.col(fold_col) == k), "_m")
        held = held.select("label", array_to_vector(F.array("_m")).alias("features"))
        out.append((base, LogisticRegression(regParam=0.0).fit(held)))
    return out


def score_calibrated(members: list[tuple], df: DataFrame) -> DataFrame:
    """Mean of the folds' calibrated probabilities."""
    for k, (base, sigmoid) in enumerate(members):
        x = with_margin(base, df, "_m").withColumn("_one", array_to_vector(F.array("_m")))
        df = with_prob(sigmoid.copy().setFeaturesCol("_one"), x, f"p{k}").drop("_m", "_one")
    return verdict(df, mean_of(f"p{k}" for k in range(len(members))))


# ------------------------------------------------------------ blends, layers
def _scores(models: dict, df: DataFrame) -> DataFrame:
    for name, m in models.items():
        df = with_prob(m, df, f"_{name}")
    return df


def blend_holdout(train: DataFrame, test: DataFrame, members: dict[str, Callable], meta: Callable, share: float = 0.3, seed: int = 42) -> DataFrame:
    """Members learn from one part of ``train``, the meta model from their scores on
    the other ``share``; returns the scored ``test``."""
    part = train.withColumn("_hold", md5_uniform("id", seed) < share)
    models = {n: make().fit(part.filter(~F.col("_hold"))) for n, make in members.items()}

    def ask(df):
        return _scores(models, df).select("id", "label", array_to_vector(F.array(*[f"_{n}" for n in models])).alias("features"))

    fitted = meta().fit(ask(part.filter("_hold")))
    return verdict(with_prob(fitted, ask(test), "_p"), F.col("_p"))


def layered_stack(train: DataFrame, test: DataFrame, layers: int = 2, width: int = 3, seed: int = 42) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """Layers of random models: features are scaled, ``width`` models with seeded
    random settings score the rows, and the scores (-1 to 1) through the four
    activations are the next layer's features.  A layer's models are fitted on two
    halves in turn, each half scored by the other's, so no training row meets a model
    that saw it; other rows get the mean of both.  Returns the soft vote of the last
    layer on ``test`` and every layer's ``(train, test)`` outputs."""
    rng, outputs = random.Random(seed), []
    names = [f"_m{i}" for i in range(width)]
    train, test = train.select("id", "label", "features"), test.select("id", "label", "features")
    vote = None
    for layer in range(layers):
        scaler = StandardScaler(inputCol="features", outputCol="_s", withMean=True).fit(train)
        tr, te = (scaler.transform(d).drop("features").withColumnRenamed("_s", "features") for d in (train, test))
        tr = tr.withColumn("_half", md5_bucket("id", seed + layer, 2)).persist()
        halves = []
        settings = [10 ** rng.uniform(-3, 0) if i % 2 == 0 else rng.randint(2, 5) for i in range(width)]
        for half in (0, 1):
            own = tr.filter(F.col("_half") != half)
            halves.append([(LogisticRegression(regParam=s) if i % 2 == 0 else DecisionTreeClassifier(maxDepth=s, seed=seed)).fit(own)
                           for i, s in enumerate(settings)])

        def apply(df, models, tag):
            for name, m in zip(names, models):
                df = with_prob(m, df, name + tag)
            return df

        both = apply(apply(tr, halves[0], "a"), halves[1], "b")
        score_tr = [F.when(F.col("_half") == 0, F.col(n + "a")).otherwise(F.col(n + "b")).alias(n) for n in names]
        both_te = apply(apply(te, halves[0], "a"), halves[1], "b")
        score_te = [((F.col(n + "a") + F.col(n + "b")) / 2).alias(n) for n in names]
        expand = array_to_vector(activation_expand(F.array(*[F.col(n) * 2 - 1 for n in names]))).alias("features")
        train = both.select("id", "label", *score_tr).select("id", "label", expand).persist()
        x = both_te.select("id", "label", *score_te).persist()
        vote, test = verdict(x, mean_of(names)), x.select("id", "label", expand)
        train.count()
        tr.unpersist()
        outputs.append((train, test))
    return vote, outputs


def layer_scores(outputs: list[tuple[DataFrame, DataFrame]]) -> list[tuple[int, float]]:
    """``(layer, macro F1 of a plain logistic regression on its output)``."""
    out = []
    for i, (train, test) in enumerate(outputs):
        scored = verdict(with_prob(LogisticRegression(regParam=0.01).fit(train), test, "_p"), F.col("_p"))
        out.append((i, float(EV.binary_metrics(scored).first()["macro_f1"])))
    return out


def ensemble_prune(scores: DataFrame, models: list[str]) -> list[tuple[int, str, float, bool]]:
    """``(step, member left out, macro F1 without it, taken)``: while the soft vote
    without some member is better than with it, the best such member goes.  All
    candidates of a step come from one pass over ``(id, model, label, prob)``."""
    vote = lambda p: (p >= 0.5).cast("int").alias("prediction")
    left, out = list(models), []
    whole = scores.groupBy("id", "label").agg(F.avg("prob").alias("p")).select("id", "label", vote(F.col("p")))
    best = EV.binary_metrics(whole, prob_col=None).first()["macro_f1"]
    while len(left) > 1:
        x = scores.filter(F.col("model").isin(left)).groupBy("id", "label").agg(
            F.sum("prob").alias("s"), F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("model", "prob")).alias("of"))
        x = x.select("id", "label", "s", "n", F.explode("of").alias("m")).filter("n > 1")
        x = x.select("id", "label", F.col("m.model").alias("model"), vote((F.col("s") - F.col("m.prob")) / (F.col("n") - 1)))
        found = sorted(((r["macro_f1"], r["model"]) for r in EV.binary_metrics(x, ["model"], prob_col=None).collect()), key=lambda r: (-r[0], r[1]))
        better = found[0][0] > best
        out += [(len(models) - len(left) + 1, m, float(f), better and m == found[0][1]) for f, m in found]
        if not better:
            break
        best = found[0][0]
        left.remove(found[0][1])
    return out


def rfe(train: DataFrame, make: Callable, dim: int, keep: int, step: int) -> list[tuple[int, int]]:
    """``(feature, round it left)``; the ``keep`` that stay have the last round.  Each
    round a model is fitted and its least important features go, ties: later ones."""
    left, out, level = list(range(dim)), [], 1
    while len(left) > keep:
        x = VectorSlicer(inputCol="features", outputCol="_some", indices=left).transform(train).drop("features").withColumnRenamed("_some", "features")
        importance = make().fit(x).featureImportances.toArray().tolist()
        order = sorted(range(len(left)), key=lambda i: (importance[i], -left[i]))[:min(step, len(left) - keep)]
        out += [(left[i], level) for i in order]
        left = [f for i, f in enumerate(left) if i not in set(order)]
        level += 1
    return out + [(f, level) for f in left]
