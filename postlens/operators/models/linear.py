"""Linear models and trees: MLlib estimators with the reference's
parameter mapping, plus the from-scratch gradient-descent logistic
regression as local descent with averaged models (the driver keeps only
the d weights)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def logistic_regression(C: float = 1.0, n: int = 1, l1_ratio: float = 0.0, weight_col: str | None = None,
                        max_iter: int = 100):
    """C (inverse regularisation of a summed loss) -> regParam = 1/(C n)."""
    lr = LogisticRegression(regParam=1.0 / (C * max(n, 1)), elasticNetParam=l1_ratio, maxIter=max_iter,
                            standardization=False, family="binomial")
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def linear_svc(C: float = 1.0, n: int = 1, max_iter: int = 100, weight_col: str | None = None):
    s = LinearSVC(regParam=1.0 / (C * max(n, 1)), maxIter=max_iter, standardization=False)
    if weight_col:
        s.setWeightCol(weight_col)
    return s


def ridge_classifier(df: DataFrame, alpha: float = 1.0, features_col: str = "features", label_col: str = "label"):
    """Least squares on labels -1/+1 (normal equations); sign of the score."""
    x = df.withColumn("_y", F.col(label_col) * 2.0 - 1.0)
    n = x.count()
    return LinearRegression(featuresCol=features_col, labelCol="_y", regParam=alpha / max(n, 1), elasticNetParam=0.0,
                            solver="normal", standardization=False).fit(x)


def decision_tree(max_depth: int = 5, min_leaf: int = 1, impurity: str = "gini", weight_col: str | None = None, seed: int = 42):
    t = DecisionTreeClassifier(maxDepth=min(max_depth, 30), minInstancesPerNode=min_leaf, impurity=impurity, seed=seed)
    if weight_col:
        t.setWeightCol(weight_col)
    return t


def random_forest(n_trees: int = 100, max_depth: int = 10, weight_col: str | None = None, seed: int = 42,
                  bootstrap: bool = True, max_bins: int = 32):
    f = RandomForestClassifier(numTrees=n_trees, maxDepth=min(max_depth, 30), featureSubsetStrategy="sqrt",
                               bootstrap=bootstrap, maxBins=max_bins, seed=seed)
    if weight_col:
        f.setWeightCol(weight_col)
    return f


def extra_trees(n_trees: int = 100, max_depth: int = 10, weight_col: str | None = None, seed: int = 42):
    """No bootstrap, sqrt features; random cut points have no MLlib form:
    approximated by very coarse histograms (few bins)."""
    return random_forest(n_trees, max_depth, weight_col, seed, bootstrap=False, max_bins=8)


def gradient_boosting(n_iter: int = 50, lr: float = 0.1, max_depth: int = 3, subsample: float = 1.0,
                      weight_col: str | None = None, seed: int = 42, validation_col: str | None = None):
    g = GBTClassifier(maxIter=n_iter, stepSize=lr, maxDepth=max_depth, subsamplingRate=subsample, seed=seed)
    if weight_col:
        g.setWeightCol(weight_col)
    if validation_col:
        g.setValidationIndicatorCol(validation_col)
    return g


def positive_prob(pred: DataFrame, prob_col: str = "probability") -> DataFrame:
    return pred.withColumn("prob", vector_to_array(prob_col)[1])


#: Rows a partition of gradient descent has at least, so that its own batches say something.
LOCAL_ROWS = 50_000

#: Partial sums of the models that reach the driver.
FAN = 64


def _halved(x: np.ndarray) -> np.ndarray:
    """Half of the rows and of a constant one: times a model, half of its scores."""
    return np.concatenate([x * 0.5, np.full((len(x), 1), 0.5)], axis=1)


#: Rows of a descent that lie in the processor's cache.
CHUNK = 2048


def _loss(z, weight, alike):
    """Weighted sums of log(1 + exp(-z)) by model, each between 1e-15 and its opposite's log;
    of rows of one weight sixteen to a logarithm."""
    if not alike or np.abs(z).max(initial=0) > 34:
        return (weight[:, None] * np.clip(np.logaddexp(0, -z), 1e-15, -np.log(1e-15))).sum(0)
    q = np.exp(-z)
    q += 1
    most = len(q) // 16 * 16
    return weight[0] * (np.log(q[:most].reshape(16, -1, q.shape[1]).prod(axis=0)).sum(0) + np.log(q[most:]).sum(0))


def _descend(xh, y, wt, own, w, b, rates, batch, l2, epochs, shuffles, tol, after=True):
    """``epochs`` of mini-batches over the rows ``own`` of one partition (``xh``: halved
    rows), all models (one row of ``w`` each) at once.  Returns the models and the summed
    loss before each epoch and, with ``after``, at the end; stops where no loss changes by
    ``tol`` times the weights.

    With rows of class 0 negated a step adds the rows times 1 / (1 + exp(score)), which is a
    few calls on its batch.  Rows are fetched in chunks; the loss before an epoch comes from
    the same chunks, unless ``tol`` asks for it first."""
    n, total = len(own), wt[own].sum()
    batch = batch or n
    model = np.concatenate([w, b[:, None]], axis=1).T.copy()  # a column a model, the offset last
    alike = n > 0 and wt[own].min() == wt[own].max() > 0
    sign = np.where(y > 0, 2.0, -2.0)
    soft = (y - (y > 0)) * sign / 2 if ((y != 0) & (y != 1)).any() else None  # labels between the classes
    decay = np.where(np.arange(len(model))[:, None] < len(model) - 1, 1 - rates[None, :] * l2, 1.0)
    rows = max(batch, CHUNK // max(batch, 1) * batch, 1)
    held = np.empty((min(n, rows), xh.shape[1]))

    def chunks(order):
        for lo in range(0, n, rows):
            at = order[lo:lo + rows]
            x = xh.take(at, axis=0, out=held[:len(at)], mode="clip")
            x *= sign[at][:, None]
            yield at, x

    def loss():
        return sum((_loss(x @ model, wt[at], alike) for at, x in chunks(own)), np.zeros(len(rates)))

    seen = [loss()] if tol is not None else []
    with np.errstate(over="ignore"):
        for epoch in range(epochs):
            order = own if batch >= n else own[shuffles(epoch).permutation(n)]
            first, before, whole = model.copy(), np.zeros(len(rates)), rates / batch
            for at, x in chunks(order):
                if tol is None:
                    before += _loss(x @ first, wt[at], alike)
                for s in range(0, len(at), batch):
                    xb = x[s:s + batch]
                    e = xb.dot(model)
                    np.exp(e, e)
                    e += 1.0
                    weight = None if alike else wt[at[s:s + batch]]
                    if not alike and not (heft := weight.sum()) > 0:
                        continue
                    np.divide(whole if len(xb) == batch else rates / len(xb), e, e)
                    if soft is not None:
                        e += soft[at[s:s + batch]][:, None] * rates / len(xb)
                    if not alike:
                        e *= (weight * (len(xb) / heft))[:, None]
                    step = xb.T.dot(e)
                    if l2:
                        model *= decay
                    model += step
            if tol is None:
                seen.append(before)
            elif after:
                seen.append(loss())
            if tol is not None and epoch and (np.abs(seen[-1] - seen[-2]) < tol * total).all():
                break
    if tol is None and (after or not epochs):
        seen.append(loss())
    return model[:-1].T, model[-1], seen


def gd_logistic_many(df: DataFrame, dim: int, models: list[tuple[float, int | None, int | None]], epochs: int = 20, l2: float = 0.0, seed: int = 42,
                     features_col: str = "x", label_col: str = "label", weight_col: str | None = None, fold_col: str | None = None,
                     tol: float | None = None, partitions: int | None = None) -> list[tuple]:
    """Mini-batch gradient descent from zero weights for several ``(rate, batch size or
    None for all rows, fold left out or None)`` at once: ``(w, b, history)`` each,
    history one ``(epoch, loss)`` per epoch.

    Local descent with model averaging: in a job every partition runs an epoch of its
    own shuffled batches for all models, then the models meet as a mean weighted by the
    partitions' row weights; the number of jobs does not grow with rows or models.  A
    partition has ``LOCAL_ROWS`` rows at least, so a small table is one partition, its
    descent the plain one, and all its epochs one job.  Whole-table batches are exact for
    any number of partitions, as the mean of their steps is the step of all.  Rows are
    cached as packed blocks, so that an epoch does not turn them into arrays again.

    Rows with a null label, weight or feature are left out.  A model stops when its
    loss, or that of all models of its batch size and fold, changes by less than ``tol``.
    No rows: zero weights, empty history.  The driver holds the models only, and once of
    each of ``FAN`` groups of partitions."""
    rid = F.col("id").cast("string") if "id" in df.columns else F.xxhash64(features_col, label_col).cast("string")
    rows = df.select(F.col(features_col).cast("array<double>").alias("x"), F.col(label_col).cast("double").alias("y"), (F.col(weight_col) if weight_col else F.lit(1.0)).cast("double").alias("wt"),
                     F.coalesce((F.col(fold_col) if fold_col else F.lit(-1)).cast("int"), F.lit(-1)).alias("fold"), rid.alias("rid"))
    rows = rows.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("wt").isNotNull() & ~F.exists("x", lambda v: v.isNull()))
    if partitions is None:
        partitions = max(1, min(df.sparkSession.sparkContext.defaultParallelism * 4, rows.count() // LOCAL_ROWS))
    groups: dict[tuple, list[int]] = {}
    for i, (_, batch, fold) in enumerate(models):
        groups.setdefault((batch, fold), []).append(i)
    rates = np.array([float(r) for r, _, _ in models])
    run = _alone if partitions == 1 else _averaged
    state, hist = run(rows, dim, groups, rates, epochs, l2, seed, tol, partitions, len(models))
    return [(*state[i], [(e, float(h)) for e, h in enumerate(hist[i])]) for i in range(len(models))]


def _alone(rows, dim, groups, rates, epochs, l2, seed, tol, partitions, n_models):
    """The descent over a table of one partition: all epochs in one job, and a copy of the
    rows for every group of models, so that the groups run side by side."""
    base = rows.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1)))).repartitionById(len(groups), "g").sortWithinPartitions("g", "rid")

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_rows = list(batches)  # a partition's rows
        for g, b in pd.concat(held_rows).groupby("g") if held_rows else ():
            (batch, held), at = list(groups.items())[g]
            x, y, wt, fold = np.stack(b["x"].to_numpy()), b["y"].to_numpy(float), b["wt"].to_numpy(float), b["fold"].to_numpy(int)
            own = np.arange(len(y)) if held is None else np.flatnonzero(fold != held)
            if not (n := wt[own].sum()) > 0:
                continue
            w, c, seen = _descend(_halved(x), y, wt, own, np.zeros((len(at), dim)), np.zeros(len(at)), rates[at], batch, l2, epochs,
                                  lambda e: np.random.default_rng([seed, e, 0, batch or 0]), tol)
            for j, i in enumerate(at):
                yield pd.DataFrame({"model": [i], "w": [w[j].tolist()], "b": [c[j]], "seen": [[s[j] / n for s in seen[1:]]]})

    state, hist = {i: (np.zeros(dim), 0.0) for i in range(n_models)}, [[] for _ in range(n_models)]
    for r in base.mapInPandas(local, "model int, w array<double>, b double, seen array<double>").collect():  # the models and their losses
        state[r["model"]], hist[r["model"]] = (np.array(r["w"]), r["b"]), list(r["seen"])
    return state, hist


def _averaged(rows, dim, groups, rates, epochs, l2, seed, tol, partitions, n_models):
    """The descent over several partitions, a job an epoch."""
    base = rows.repartition(partitions, "rid").sortWithinPartitions("rid").select("x", "y", "wt", "fold").mapInPandas(_packed, "n int, x binary, y binary, wt binary, fold binary").persist()

    def job(now: dict, epoch: int, last: bool) -> dict[int, np.ndarray]:
        """Of each model the sums over the partitions of weights, offset, loss before the
        epoch and row weights, from one pass."""

        def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held_rows = list(batches)  # a partition's blocks
            if not held_rows:
                return
            blocks, part = pd.concat(held_rows), TaskContext.get().partitionId()
            x, y, wt, fold = (np.concatenate([np.frombuffer(v, kind) for v in blocks[c]]) for c, kind in (("x", float), ("y", float), ("wt", float), ("fold", np.int32)))
            xh = _halved(x.reshape(len(y), -1))
            for (batch, held), at in groups.items():
                if at[0] not in now:
                    continue
                own = np.arange(len(y)) if held is None else np.flatnonzero(fold != held)
                if not (n := wt[own].sum()) > 0:
                    continue
                w, c, seen = _descend(xh, y, wt, own, np.array([now[i][0] for i in at]), np.array([now[i][1] for i in at]), rates[at], batch, l2, 0 if last else 1,
                                      lambda e, batch=batch: np.random.default_rng([seed, epoch, part, batch or 0]), None, after=False)
                for j, i in enumerate(at):
                    yield pd.DataFrame({"r": [part % FAN], "model": [i], "v": [np.concatenate([w[j] * n, [c[j] * n, seen[0][j], n]]).tobytes()]})

        def meet(b: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"r": b["r"][:1], "model": b["model"][:1], "v": [np.sum([np.frombuffer(v) for v in b["v"]], axis=0).tobytes()]})

        told = base.mapInPandas(local, schema := "r int, model int, v binary")
        if partitions > FAN:
            told = told.groupBy("r", "model").applyInPandas(meet, schema)
        got: dict[int, np.ndarray] = {}
        for r in sorted(told.collect(), key=lambda r: (r["model"], r["r"])):  # FAN * models * (dim + 3) numbers, whatever the rows
            got[r["model"]] = got.get(r["model"], 0.0) + np.frombuffer(r["v"])
        return got

    state, hist = {i: (np.zeros(dim), 0.0) for i in range(n_models)}, [[] for _ in range(n_models)]
    going = set(range(n_models))
    for ep in range(epochs + 1):
        done = job({i: state[i] for i in going}, ep, ep >= epochs)
        going &= set(done)  # not a model without rows
        for i in going:
            if ep:
                hist[i].append(done[i][-2] / done[i][-1])
            if ep < epochs:
                state[i] = done[i][:dim] / done[i][-1], float(done[i][dim] / done[i][-1])
        if tol is not None:
            for at in groups.values():
                if ep < epochs and all(len(hist[i]) > 1 and abs(hist[i][-1] - hist[i][-2]) < tol for i in at if i in going):
                    going -= set(at)
        if not going:
            break
    base.unpersist()
    return state, hist


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows as blocks of plain bytes, a block a batch."""
    for b in batches:
        if len(b):
            yield pd.DataFrame({"n": [len(b)], "x": [np.stack(b["x"].to_numpy()).astype(float).tobytes()], "y": [b["y"].to_numpy(float).tobytes()],
                                "wt": [b["wt"].to_numpy(float).tobytes()], "fold": [b["fold"].to_numpy(np.int32).tobytes()]})


def gd_logistic(df: DataFrame, dim: int, epochs: int = 20, lr: float = 0.01, batch: int | None = 64, l2: float = 0.0, seed: int = 42, features_col: str = "x",
                label_col: str = "label", weight_col: str | None = None, tol: float | None = None, partitions: int | None = None):
    """:func:`gd_logistic_many` for one model: (w, b, history)."""
    return gd_logistic_many(df, dim, [(lr, batch, None)], epochs, l2, seed, features_col, label_col, weight_col, None, tol, partitions)[0]


def score_many(df: DataFrame, models: list[tuple], keys: list[tuple], schema: str, features_col: str = "x") -> DataFrame:
    """Rows of ``df`` with a probability ``prob`` for every one of ``models`` (w, b, ...),
    whose ``keys`` (columns ``schema``) come along; keys that are columns of ``df`` too
    are joined on.  The table of models is as large as the models."""
    names = [c.split()[0] for c in schema.split(", ")]
    held = df.sparkSession.createDataFrame([(*k, [float(v) for v in m[0]], float(m[1])) for k, m in zip(keys, models)], f"{schema}, _w array<double>, _b double")
    on = [c for c in names if c in df.columns]
    x = df.join(F.broadcast(held), on) if on else df.crossJoin(F.broadcast(held))
    z = F.aggregate(F.zip_with(features_col, "_w", lambda a, c: a * c), F.col("_b"), lambda acc, t: acc + t)
    return x.withColumn("prob", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))))).drop("_w", "_b")


def _linear_prob(features_col: str, w, b: float):
    """Sigmoid of w x + b.  Weights and offset are one folded array literal, so the
    steps share their compiled code."""
    wl = F.array(*[F.lit(float(v)) for v in w], F.lit(float(b)))
    prods = F.zip_with(features_col, F.slice(wl, 1, len(w)), lambda x, v: x * v)
    z = F.aggregate(prods, wl[len(w)], lambda acc, t: acc + t)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))))


def score_linear(df: DataFrame, w, b: float, features_col: str = "x") -> DataFrame:
    return df.withColumn("prob", _linear_prob(features_col, w, b))
