"""Registered queries, part four: what is written and read back (models, prediction
files, reports), and the runner.  Files go to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from postlens.operators import combine as CB
from postlens.operators import evaluate as EV
from postlens.operators import runner as RU
from postlens.plans import sqlfrag as S
from postlens.plans.catalog import NB_FITS, R6, SC, VOTES, _nb_sql, _votes, fx_scores, nb_data, nb_verdicts, r6, register
from postlens.sources import shared_folder, table, write_predictions, write_report
from postlens.sources.models import load_model, save_model


def _place(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@register("save_load_model", _nb_sql("multinomial"))
def q_save_load(spark, sf):
    c, tc, tr, va, v = nb_data(spark, sf)
    path = _place(spark, "model")
    save_model(spark, NB_FITS["multinomial"](tc, tr, v), path)
    return nb_verdicts(load_model(spark, path), c, va)


@register("write_predictions", f"SELECT id, CASE WHEN avg(prob) >= 0.5 THEN 1 ELSE 0 END AS label FROM {SC} GROUP BY id")
def q_write_predictions(spark, sf):
    path = _place(spark, "predictions")
    write_predictions(CB.soft_vote(fx_scores(spark, sf)), path)
    return spark.read.schema("id long, label int").option("header", True).option("enforceSchema", False).csv(path)


@register("write_report", f"""SELECT model, n, {R6('accuracy')} AS accuracy, {R6('f1')} AS f1, {R6('mcc')} AS mcc
FROM (SELECT {S.metrics_select_sql(['model'])} FROM ({S.confusion_sql(VOTES, ['model'])}))""")
def q_write_report(spark, sf):
    path = _place(spark, "report")
    write_report(r6(EV.binary_metrics(_votes(spark, sf), ["model"], prob_col=None).select("model", "n", "accuracy", "f1", "mcc"), {"accuracy", "f1", "mcc"}), path)
    return spark.read.schema("model string, n long, accuracy double, f1 double, mcc double").json(path)


_RUNS = " UNION ALL ".join(f"SELECT '{k}' AS model, label, prediction FROM ({_nb_sql(k)})" for k in sorted(NB_FITS))


@register("run_all_and_compare", f"""WITH m AS (SELECT {S.metrics_select_sql(['model'])} FROM ({S.confusion_sql(f"({_RUNS})", ['model'])}))
SELECT model AS pipeline, 'ok' AS status, n, {R6('accuracy')} AS accuracy, {R6('f1')} AS f1, {R6('macro_f1')} AS macro_f1, (row_number() OVER (ORDER BY f1 DESC, model))::INT AS rank, {R6('max(f1) OVER () - f1')} AS gap FROM m
UNION ALL SELECT 'no_such_column', 'failed', NULL, NULL, NULL, NULL, NULL, NULL
UNION ALL SELECT 'raises_in_task', 'failed', NULL, NULL, NULL, NULL, NULL, NULL""")
def q_run_all(spark, sf):
    c, tc, tr, va, v = nb_data(spark, sf)
    c, v = c.persist(), v.persist()
    runs = {k: (lambda fit=fit: nb_verdicts(fit(tc, tr, v), c, va)) for k, fit in NB_FITS.items()}
    labels = table(spark, sf, "labels")
    # two that fail, one as it is planned and one in its tasks
    runs["no_such_column"] = lambda: labels.select("no_such_column", F.col("toxic").alias("label"))
    runs["raises_in_task"] = lambda: labels.select(F.col("toxic").alias("label"), F.when(F.col("doc_id") >= 0, F.raise_error(F.lit("planted"))).cast("int").alias("prediction"))
    out = RU.rank_outcomes(RU.run_all(spark, runs))
    return r6(out.select("pipeline", "status", "n", "accuracy", "f1", "macro_f1", "rank", "gap"), {"accuracy", "f1", "macro_f1", "gap"})
