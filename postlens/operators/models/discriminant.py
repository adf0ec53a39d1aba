"""Linear and quadratic discriminant analysis in closed form.

Tasks add up, per class, the count, the sum and the second moments of their
rows (a d x d matrix); these few rows meet on the driver, where one d x d system
per model is solved.  d is the number of features, not of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_moments(df: DataFrame, x_col: str = "x", label_col: str = "label") -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """label -> (n, sum of x, sum of x x^T)."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for b in batches:
            for y, rows in b.groupby("y"):
                x = np.stack(list(rows["x"])).astype(float)
                n, s, q = held.get(y, (0, 0, 0))
                held[y] = n + len(x), s + x.sum(axis=0), q + x.T @ x
        for y, (n, s, q) in held.items():
            yield pd.DataFrame({"y": [int(y)], "n": [float(n)], "s": [s.tolist()], "q": [q.ravel().tolist()]})

    parts = (df.select(F.col(label_col).cast("int").alias("y"), F.col(x_col).cast("array<double>").alias("x")).na.drop()
             .mapInPandas(add, "y int, n double, s array<double>, q array<double>"))
    wide = parts.select("y", "n", F.posexplode(F.concat("s", "q")).alias("i", "v"))
    sums = wide.groupBy("y", "i").agg(F.sum("v").alias("v"))  # one row per class and matrix cell
    counts = {r["y"]: r["n"] for r in parts.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    flat: dict[int, dict[int, float]] = {}
    for r in sums.collect():
        flat.setdefault(r["y"], {})[r["i"]] = r["v"]
    out = {}
    for y, cells in flat.items():
        v = np.array([cells[i] for i in range(len(cells))])
        d = int((np.sqrt(1 + 4 * len(v)) - 1) / 2)
        out[y] = counts[y], v[:d], v[d:].reshape(d, d)
    return out


def discriminants(moments: dict, quadratic: bool, reg: float = 0.0) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """label -> (constant, linear, quadratic form) of the log posterior up to a
    common term.  ``reg`` shrinks a covariance towards the identity."""
    total = sum(n for n, _, _ in moments.values())
    scatter = {y: q - np.outer(s, s) / n for y, (n, s, q) in moments.items()}
    d = len(next(iter(scatter.values())))
    pooled = sum(scatter.values()) / (total - len(moments) if total > len(moments) else total)
    out = {}
    for y, (n, s, _) in moments.items():
        cov = scatter[y] / max(n - 1, 1) if quadratic else pooled
        cov = (1 - reg) * cov + reg * np.eye(d)
        inv, mean = np.linalg.pinv(cov), s / n
        lin = inv @ mean
        const = np.log(n / total) - 0.5 * mean @ lin - (0.5 * np.linalg.slogdet(cov)[1] if quadratic else 0.0)
        out[y] = float(const), lin, -0.5 * inv if quadratic else np.zeros((d, d))
    return out


def score(df: DataFrame, model: dict, x_col: str = "x") -> DataFrame:
    """Adds ``prob`` (of class 1 of two) and ``prediction`` (the likelier class,
    ties to the smaller), Arrow batches against d x d matrices."""
    classes = sorted(model)

    @F.pandas_udf("prediction int, prob double")
    def predict(xs: pd.Series) -> pd.DataFrame:
        x = np.stack(list(xs)).astype(float) if len(xs) else np.zeros((0, len(model[classes[0]][1])))
        z = np.column_stack([c + x @ w + np.einsum("ij,jk,ik->i", x, q, x, optimize=True) for c, w, q in (model[y] for y in classes)])
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return pd.DataFrame({"prediction": np.array(classes, np.int32)[p.argmax(axis=1)], "prob": p[:, -1]})

    return df.withColumn("_p", predict(F.col(x_col).cast("array<double>"))).select(*df.columns, "_p.prediction", "_p.prob")
