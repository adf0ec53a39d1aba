"""Cross-validation, out-of-fold stacking and parameter search over MLlib
estimators.  Folds are a column made by a seeded hash, so every run and every
candidate sees the same folds; scores are aggregations, nothing is collected but
one row per fold."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import product

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.operators import evaluate as EV
from postlens.operators.models.linear import positive_prob


def out_of_fold(df: DataFrame, make: Callable, k: int, fold_col: str = "fold", keep: Iterable[str] = ("id", "label")) -> DataFrame:
    """``keep, fold, prob, prediction``: each row scored by the model that was
    fitted on the other folds."""
    out = None
    for i in range(k):
        train, test = df.filter(F.col(fold_col) != i), df.filter(F.col(fold_col) == i)
        scored = positive_prob(make().fit(train).transform(test))
        scored = scored.select(*keep, fold_col, F.round("prob", 9).alias("prob"), F.col("prediction").cast("int").alias("prediction"))
        out = scored if out is None else out.unionByName(scored)
    return out


def cross_validate(df: DataFrame, make: Callable, k: int, fold_col: str = "fold") -> DataFrame:
    """Metrics of each fold."""
    return EV.binary_metrics(out_of_fold(df, make, k, fold_col), [fold_col])


def grid(params: dict[str, list]) -> list[dict]:
    return [dict(zip(params, values)) for values in product(*params.values())]


def search(df: DataFrame, make: Callable, candidates: list[dict], k: int, metric: str = "macro_f1", fold_col: str = "fold") -> list[tuple[dict, float]]:
    """Candidates with their mean fold metric, best first (ties: as given)."""
    scored = []
    for c in candidates:
        m = cross_validate(df, lambda c=c: make(**c), k, fold_col).agg(F.avg(metric)).first()[0]
        scored.append((c, float(m)))
    return sorted(scored, key=lambda x: -x[1])


def halving_search(df: DataFrame, make: Callable, candidates: list[dict], k: int, factor: int = 3, start: float = 1 / 9,
                   metric: str = "macro_f1", fold_col: str = "fold", id_col: str = "id") -> list[tuple[int, float, dict, float]]:
    """Successive halving: ``(round, share of rows, candidate, metric)``; each round
    the best 1/factor go on with factor times the rows (by a hash of the id)."""
    history, share, level = [], start, 0
    while True:
        part = df if share >= 1 - 1e-9 else df.filter(F.pmod(F.xxhash64(id_col), F.lit(10_000)) < int(share * 10_000))
        scored = search(part, make, candidates, k, metric, fold_col)
        history += [(level, min(share, 1.0), c, m) for c, m in scored]
        if len(scored) == 1 or share >= 1 - 1e-9:
            return history
        candidates = [c for c, _ in scored[:max(1, len(scored) // factor)]]
        share, level = share * factor, level + 1


def stack_meta(df: DataFrame, members: dict[str, Callable], meta: Callable, k: int, test: DataFrame, fold_col: str = "fold") -> DataFrame:
    """Stacking: out-of-fold probabilities of the members are the meta model's
    features, so no meta row was scored by a model that saw it; test rows get the
    members fitted on all training rows.  Returns the scored ``test``."""
    def wide(parts: dict[str, DataFrame], base: DataFrame) -> DataFrame:
        for name, p in parts.items():
            base = base.join(p.select("id", F.col("prob").alias(f"_{name}")), "id")
        return base.withColumn("features", array_to_vector(F.array(*[f"_{m}" for m in parts])))

    rows = wide({n: out_of_fold(df, make, k, fold_col) for n, make in members.items()}, df.select("id", "label"))
    fitted = meta().fit(rows.select("id", "label", "features"))
    ask = wide({n: positive_prob(make().fit(df).transform(test)) for n, make in members.items()}, test.select("id", "label"))
    out = positive_prob(fitted.transform(ask))
    return out.select("id", "label", F.col("prediction").cast("int").alias("prediction"), F.round("prob", 6).alias("prob"))
