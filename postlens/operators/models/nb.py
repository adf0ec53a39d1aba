"""Naive Bayes family as closed-form aggregations.

The fitted model is two small tables -- per (label, term) log
likelihoods and per label log priors -- and scoring is a join of the
long counts with the likelihood table plus a ``groupBy(id)`` sum.
Nothing leaves the cluster; the model never passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELS = (0, 1)


@dataclass
class NBModel:
    loglik: DataFrame   # (term, label, logp)   [bernoulli: + log1m]
    prior: DataFrame    # (label, logprior)
    kind: str = "multinomial"


def _priors(train: DataFrame, label_col: str, uniform: bool) -> DataFrame:
    c = train.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_c"))
    if uniform:
        return c.select(F.col(label_col).alias("label"), F.log(F.lit(0.5)).alias("logprior"))
    from pyspark.sql import Window

    return c.select(F.col(label_col).alias("label"),
                    F.log(F.col("n_c") / F.sum("n_c").over(Window.partitionBy())).alias("logprior"))


def _class_term_counts(train_counts: DataFrame, train: DataFrame, vocab: DataFrame, id_col: str, label_col: str):
    lab = train.select(id_col, F.col(label_col).alias("label"))
    v = vocab.select("term")
    ct = (train_counts.join(v, "term").join(lab, id_col)
          .groupBy("label", "term").agg(F.sum("tf").cast("double").alias("n_ct")))
    # dense (label x vocab) grid: vocab is model-sized
    grid = v.withColumn("label", F.explode(F.array(*[F.lit(x) for x in LABELS])))
    return grid.join(ct, ["label", "term"], "left").fillna(0.0, ["n_ct"])


def fit_multinomial_nb(train_counts: DataFrame, train: DataFrame, vocab: DataFrame, alpha: float = 1.0,
                       uniform_prior: bool = False, id_col: str = "id", label_col: str = "label") -> NBModel:
    ct = _class_term_counts(train_counts, train, vocab, id_col, label_col)
    from pyspark.sql import Window

    w = Window.partitionBy("label")  # over the (label, vocabulary) table: model-sized
    ll = ct.select("term", "label", F.log((F.col("n_ct") + alpha) /
                                          (F.sum("n_ct").over(w) + alpha * F.count(F.lit(1)).over(w))).alias("logp"))
    return NBModel(ll, _priors(train, label_col, uniform_prior), "multinomial")


def fit_complement_nb(train_counts: DataFrame, train: DataFrame, vocab: DataFrame, alpha: float = 1.0,
                      id_col: str = "id", label_col: str = "label") -> NBModel:
    """Weights from the counts of the *other* class (normalised, negated)."""
    ct = _class_term_counts(train_counts, train, vocab, id_col, label_col)
    from pyspark.sql import Window

    tot = ct.groupBy("term").agg(F.sum("n_ct").alias("n_t"))
    x = ct.join(tot, "term").withColumn("comp", F.col("n_t") - F.col("n_ct"))
    w = Window.partitionBy("label")
    x = x.withColumn("lw", F.log((F.col("comp") + alpha) / (F.sum("comp").over(w) + alpha * F.count(F.lit(1)).over(w))))
    ll = x.select("term", "label", (-F.col("lw")).alias("logp"))
    return NBModel(ll, _priors(train, label_col, True).withColumn("logprior", F.lit(0.0)), "complement")


def fit_bernoulli_nb(train_counts: DataFrame, train: DataFrame, vocab: DataFrame, alpha: float = 1.0,
                     id_col: str = "id", label_col: str = "label") -> NBModel:
    """P(term present | class) = (docs with term + a) / (n_c + 2a)."""
    present = train_counts.withColumn("tf", F.lit(1))
    ct = _class_term_counts(present, train, vocab, id_col, label_col)
    nc = train.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).cast("double").alias("n_c"))
    x = ct.join(nc, "label")
    p = (F.col("n_ct") + alpha) / (F.col("n_c") + 2 * alpha)
    ll = x.select("term", "label", F.log(p).alias("logp"), F.log(1 - p).alias("log1m"))
    return NBModel(ll, _priors(train, label_col, False), "bernoulli")


def score_nb(model: NBModel, counts: DataFrame, docs: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, score0, score1, prob)``: joint log likelihood per class and
    P(class 1) = 1 / (1 + exp(score0 - score1))."""
    ll = model.loglik
    if model.kind == "bernoulli":
        base = ll.groupBy("label").agg(F.sum("log1m").alias("b"))
        pri = model.prior.join(base, "label").select("label", (F.col("logprior") + F.col("b")).alias("logprior"))
        contrib = counts.join(ll, "term").select(id_col, "label", (F.col("logp") - F.col("log1m")).alias("c"))
    else:
        pri = model.prior
        contrib = counts.join(ll, "term").select(id_col, "label", (F.col("tf") * F.col("logp")).alias("c"))
    s = contrib.groupBy(id_col).agg(
        F.sum(F.when(F.col("label") == 0, F.col("c")).otherwise(0.0)).alias("_c0"),
        F.sum(F.when(F.col("label") == 1, F.col("c")).otherwise(0.0)).alias("_c1"))
    # two log priors: model-sized state on the driver, used as literals
    pr = {r["label"]: r["logprior"] for r in pri.collect()}
    x = docs.select(id_col).join(s, id_col, "left")
    s0 = F.lit(pr.get(0, float("-inf"))) + F.coalesce(F.col("_c0"), F.lit(0.0))
    s1 = F.lit(pr.get(1, float("-inf"))) + F.coalesce(F.col("_c1"), F.lit(0.0))
    return x.select(id_col, s0.alias("score0"), s1.alias("score1"),
                    F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(s0 - s1)), 9).alias("prob"))


def fit_gaussian_nb(train: DataFrame, features_col: str = "x", label_col: str = "label", var_smoothing: float = 1e-9):
    """Per (label, pos) mean / population variance of an array column;
    variances get ``var_smoothing * max variance`` added."""
    e = train.select(F.col(label_col).alias("label"), F.posexplode(features_col).alias("pos", "v"))
    m = e.groupBy("label", "pos").agg(F.avg("v").alias("mu"), F.var_pop("v").alias("var"))
    from pyspark.sql import Window

    per_feat = e.groupBy("pos").agg(F.var_pop("v").alias("fv"))
    mx = per_feat.select(F.max("fv").over(Window.partitionBy()).alias("mx"), "pos")
    m = m.join(mx, "pos").withColumn("var", F.col("var") + var_smoothing * F.col("mx")).drop("mx")
    pri = _priors(train, label_col, False)
    return m, pri


def score_gaussian_nb(model, df: DataFrame, features_col: str = "x", id_col: str = "id") -> DataFrame:
    m, pri = model
    e = df.select(id_col, F.posexplode(features_col).alias("pos", "v"))
    j = e.join(m, "pos").select(id_col, "label", (-0.5 * F.log(2 * 3.141592653589793 * F.col("var"))
                                                  - (F.col("v") - F.col("mu")) ** 2 / (2 * F.col("var"))).alias("c"))
    s = j.groupBy(id_col, "label").agg(F.sum("c").alias("c")).join(pri, "label")
    s = s.groupBy(id_col).agg(
        F.sum(F.when(F.col("label") == 0, F.col("c") + F.col("logprior"))).alias("score0"),
        F.sum(F.when(F.col("label") == 1, F.col("c") + F.col("logprior"))).alias("score1"))
    return s.withColumn("prob", F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("score0") - F.col("score1"))))
