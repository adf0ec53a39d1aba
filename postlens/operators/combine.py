"""Combining model scores held in the long shape ``(id, model, prob)``.

Votes and meta-features are ``groupBy(id)`` aggregations.  Pairwise
statistics (agreement, correlation) never emit model pairs per row: the
scores are pivoted to one column per model (the model list is metadata,
a handful of names) and every pair becomes one aggregate of a single
pass.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def threshold_predict(scores: DataFrame, threshold: float = 0.5, inclusive: bool = True, prob_col="prob",
                      out="prediction") -> DataFrame:
    p = F.col(prob_col)
    return scores.withColumn(out, ((p >= threshold) if inclusive else (p > threshold)).cast("int"))


def soft_vote(scores: DataFrame, weights: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """(Weighted) mean probability per id; prediction = mean >= t."""
    if weights is None:
        g = scores.groupBy("id").agg(F.avg("prob").alias("prob"))
    else:  # weights: (model, weight) -- one row per model
        x = scores.join(weights, "model")
        g = x.groupBy("id").agg((F.sum(F.col("weight") * F.col("prob")) / F.sum("weight")).alias("prob"))
    return g.withColumn("prediction", (F.col("prob") >= threshold).cast("int"))


def hard_vote(votes: DataFrame, pred_col="prediction") -> DataFrame:
    """Majority of member labels; a tie goes to the smaller class (0)."""
    g = votes.groupBy("id").agg(F.sum(pred_col).alias("_s"), F.count(F.lit(1)).alias("_n"))
    return g.select("id", (F.col("_s") * 2 > F.col("_n")).cast("int").alias("prediction"))


def quorum_vote(votes: DataFrame, m: int, pred_col="prediction") -> DataFrame:
    g = votes.groupBy("id").agg(F.sum(pred_col).alias("_s"))
    return g.select("id", (F.col("_s") >= m).cast("int").alias("prediction"))


def f1_weights(metrics: DataFrame, metric: str = "f1") -> DataFrame:
    """weight_i = F1_i / sum F1 (window over the per-model table)."""
    return metrics.select("model", (F.col(metric) / F.sum(metric).over(Window.partitionBy())).alias("weight"))


def weighted_average(scores: DataFrame, weights: DataFrame, threshold: float = 0.5) -> DataFrame:
    """sum_i w_i p_i, predicted 1 when strictly above the threshold;
    models without a weight count 1.0."""
    x = scores.join(weights, "model", "left").fillna(1.0, ["weight"])
    g = x.groupBy("id").agg(F.sum(F.col("weight") * F.col("prob")).alias("prob"))
    return g.withColumn("prediction", (F.col("prob") > threshold).cast("int"))


def meta_features(scores: DataFrame, models: list[str], threshold: float = 0.5) -> DataFrame:
    """Per id: each model's p, population std, gap (max-min), population
    variance, mean, median, range and count of p > 0.5."""
    p = F.col("prob")
    g = scores.groupBy("id").agg(
        *[F.max(F.when(F.col("model") == m, p)).alias(f"{m}_pred") for m in models],
        F.stddev_pop(p).alias("model_disagreement"), (F.max(p) - F.min(p)).alias("confidence_gap"),
        F.var_pop(p).alias("prediction_variance"), F.avg(p).alias("mean_prediction"),
        F.median(p).alias("median_prediction"), (F.max(p) - F.min(p)).alias("prediction_range"),
        F.sum((p > threshold).cast("int")).cast("long").alias("models_above_threshold"))
    return g


def _wide(votes: DataFrame, models: list[str], col: str) -> DataFrame:
    return votes.groupBy("id").agg(*[F.max(F.when(F.col("model") == m, F.col(col))).alias(m) for m in models])


def agreement_matrix(votes: DataFrame, models: list[str], pred_col="prediction") -> DataFrame:
    """Share of ids where two models give the same label, all ordered
    pairs (diagonal 1)."""
    w = _wide(votes, models, pred_col)
    aggs = [F.avg((F.col(a) == F.col(b)).cast("double")).alias(f"{a}|{b}") for a in models for b in models]
    row = w.agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a in models for b in models)
    return row.selectExpr(f"stack({len(models) ** 2}, {stack}) AS (model_a, model_b, agreement)")


def agreement_summary(matrix: DataFrame) -> DataFrame:
    up = matrix.filter(F.col("model_a") < F.col("model_b"))
    return up.agg(F.avg("agreement").alias("mean_agreement"), F.stddev_pop("agreement").alias("std_agreement"))


def prediction_correlation(scores: DataFrame, models: list[str]) -> DataFrame:
    w = _wide(scores, models, "prob")
    pairs = list(combinations(models, 2))
    row = w.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a, b in pairs)
    return row.selectExpr(f"stack({len(pairs)}, {stack}) AS (model_a, model_b, correlation)")


def disagreement_rows(votes: DataFrame, a: str, b: str, pred_col="prediction") -> DataFrame:
    w = _wide(votes, [a, b], pred_col)
    return w.agg(F.sum((F.col(a) != F.col(b)).cast("int")).cast("long").alias("n_disagree"))


def estimator_variance(votes: DataFrame, col="prediction") -> DataFrame:
    return votes.groupBy("id").agg(F.var_pop(F.col(col).cast("double")).alias("variance"))


def consensus_analysis(votes: DataFrame, first_model: str, pred_col="prediction") -> DataFrame:
    """Mean label, number agreeing with the first model, disagreement ratio."""
    first = votes.filter(F.col("model") == first_model).select("id", F.col(pred_col).alias("_first"))
    x = votes.join(first, "id")
    g = x.groupBy("id").agg(F.avg(pred_col).alias("consensus_ratio"),
                            F.sum((F.col(pred_col) == F.col("_first")).cast("int")).cast("long").alias("agreement_count"),
                            F.count(F.lit(1)).alias("_n"))
    return g.select("id", "consensus_ratio", "agreement_count",
                    (F.lit(1.0) - F.col("agreement_count") / F.col("_n")).alias("disagreement_ratio"))


def minmax_scores(scores: DataFrame, col="prob", by=("model",)) -> DataFrame:
    """(s - min) / (max - min) per model over the scored batch (window
    per model -> use an aggregate + join so no model sits in one task)."""
    mm = scores.groupBy(*by).agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    x = scores.join(mm, list(by))
    return x.withColumn(col, F.when(F.col("_mx") > F.col("_mn"), (F.col(col) - F.col("_mn")) / (F.col("_mx") - F.col("_mn")))
                        .otherwise(F.lit(0.0))).drop("_mn", "_mx")


def set_weights(scores: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Adds the user's weight of each model; every model needs exactly one."""
    models = {r["model"] for r in scores.select("model").distinct().collect()}  # one row per model
    if models != set(weights):
        raise ValueError(f"weights for {sorted(weights)}, models are {sorted(models)}")
    w = scores.sparkSession.createDataFrame(sorted((m, float(x)) for m, x in weights.items()), "model string, weight double")
    return scores.join(w, "model")


def weighted_meta_features(scores: DataFrame, weights: DataFrame, models: list[str]) -> DataFrame:
    """The meta features of p_i scaled by its model's weight (1.0 where it has none)."""
    x = scores.join(weights, "model", "left").fillna(1.0, ["weight"])
    return meta_features(x.withColumn("prob", F.col("prob") * F.col("weight")), models)


def prediction_analysis(posts: DataFrame, scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``id, post, label, prediction, confidence, p0, p1`` of every scored post."""
    p = F.col("prob")
    return posts.select("id", "post").join(scored.select("id", "label", "prob"), "id").select(
        "id", "post", "label", (p >= threshold).cast("int").alias("prediction"), F.greatest(p, 1 - p).alias("confidence"),
        (1 - p).alias("p0"), p.alias("p1"))


def example_predictions(scored: DataFrame, n: int = 10, seed: int = 42, threshold: float = 0.5) -> DataFrame:
    """``n`` sampled rows (the least seeded hashes): truth, prediction, probability."""
    pick = scored.withColumn("_h", F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{seed}")))).orderBy("_h", "id").limit(n)
    return pick.select("id", "label", (F.col("prob") >= threshold).cast("int").alias("prediction"), "prob")
