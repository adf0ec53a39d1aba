"""Runs named pipelines one after the other; one that fails costs its own row only."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.operators.evaluate import binary_metrics

METRICS = ("accuracy", "precision", "recall", "f1", "macro_f1")
OUTCOME = "pipeline string, status string, error string, seconds double, n long, " + ", ".join(f"{m} double" for m in METRICS)


def run_all(spark: SparkSession, pipelines: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """``pipeline, status, error, seconds, n`` and the metrics of each pipeline's rows
    (``label``, ``prediction``), in the order given.

    A pipeline is a function that fits, scores and returns the scored rows.  Whatever it
    raises, on the driver or in a task, is its outcome (status ``failed``, the error's
    class and first line); the others run on.  One without rows is ``empty``.  Only one
    row of metrics of each reaches the driver."""
    rows = []
    for name, run in pipelines.items():
        start, found, status, error = time.time(), None, "ok", None
        try:
            found = binary_metrics(run().select("label", "prediction"), prob_col=None).first()
            if found is None or not found["n"]:
                found, status = None, "empty"
        except Exception as e:  # noqa: BLE001  a pipeline may raise anything
            kind = e.getCondition() if isinstance(e, PySparkException) and e.getCondition() else type(e).__name__
            status, error = "failed", f"{kind}: {str(e).strip().splitlines()[0][:200] if str(e).strip() else ''}"
        rows.append((name, status, error, time.time() - start, found["n"] if found else None, *[float(found[m]) if found else None for m in METRICS]))
    return spark.createDataFrame(rows, OUTCOME)


def rank_outcomes(outcomes: DataFrame, metric: str = "f1") -> DataFrame:
    """The outcomes with ``rank`` by a metric among the pipelines that ended well (ties:
    name) and ``gap`` to the best; null for the others.  One row a pipeline."""
    best = F.max(metric).over(Window.partitionBy("status"))
    place = F.row_number().over(Window.partitionBy("status").orderBy(F.desc(metric), F.asc("pipeline")))
    ok = F.col("status") == "ok"
    return outcomes.select("*", F.when(ok, place).alias("rank"), F.when(ok, best - F.col(metric)).alias("gap"))
