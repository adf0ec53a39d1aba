"""Evaluation: confusion counts, accuracy, F1 family, AUC, threshold scans,
prediction summaries.  Each metric is a ``groupBy`` over the scored rows
(map-side partial aggregation); nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.operators.ranking import auc_by_group, exact_medians
from postlens.sources import written


def _confusion_cols(y="label", p="prediction"):
    y, p = F.col(y), F.col(p)
    return [
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).cast("long").alias("tn"),
    ]


def confusion_matrix(scored: DataFrame, group_cols=(), label_col="label", pred_col="prediction") -> DataFrame:
    return (scored.groupBy(*group_cols, F.col(label_col).alias("actual"), F.col(pred_col).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def metrics_from_counts(c: DataFrame, group_cols=()) -> DataFrame:
    """accuracy, precision, recall, f1 (class 1), macro F1, weighted F1,
    kappa, MCC from (tp, fp, fn, tn); undefined ratios are 0."""
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    f1_1 = _safe_div(tp, tp + 0.5 * (fp + fn))
    f1_0 = _safe_div(tn, tn + 0.5 * (fp + fn))
    po = _safe_div(tp + tn, n)
    pe = _safe_div((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp), n * n)
    mcc_den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return c.select(
        *group_cols,
        n.cast("long").alias("n"),
        po.alias("accuracy"),
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(tp, tp + fn).alias("recall"),
        f1_1.alias("f1"),
        f1_0.alias("f1_0"),
        # averages over both classes by their support
        _safe_div(_safe_div(tp, tp + fp) * (tp + fn) + _safe_div(tn, tn + fn) * (tn + fp), n).alias("weighted_precision"),
        _safe_div(_safe_div(tp, tp + fn) * (tp + fn) + _safe_div(tn, tn + fp) * (tn + fp), n).alias("weighted_recall"),
        ((f1_0 + f1_1) / 2).alias("macro_f1"),
        _safe_div(f1_1 * (tp + fn) + f1_0 * (tn + fp), n).alias("weighted_f1"),
        F.when(F.lit(1.0) - pe != 0, (po - pe) / (F.lit(1.0) - pe)).otherwise(F.lit(0.0)).alias("kappa"),
        _safe_div(tp * tn - fp * fn, mcc_den).alias("mcc"),
    )


def binary_metrics(scored: DataFrame, group_cols=(), label_col="label", pred_col="prediction",
                   prob_col: str | None = "prob") -> DataFrame:
    """One row per group: accuracy, precision, recall, F1, ... and AUC."""
    c = scored.groupBy(*group_cols).agg(*_confusion_cols(label_col, pred_col))
    m = metrics_from_counts(c, list(group_cols))
    if prob_col is None:
        return m
    if not group_cols:
        a = auc_by_group(scored.withColumn("_g", F.lit(1)), ["_g"], prob_col, label_col)
        return m.withColumn("_g", F.lit(1)).join(a, "_g", "left").drop("_g")
    a = auc_by_group(scored, list(group_cols), prob_col, label_col)
    return m.join(a, list(group_cols), "left")


def per_class_report(scored: DataFrame, label_col="label", pred_col="prediction") -> DataFrame:
    """Classification report: per class precision/recall/F1/support, then
    macro avg and weighted avg rows."""
    c = scored.agg(*_confusion_cols(label_col, pred_col))
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    rows = []
    for cls, (t, f_p, f_n) in {"0": (tn, fn, fp), "1": (tp, fp, fn)}.items():
        rows.append(c.select(F.lit(cls).alias("class"),
                             _safe_div(t, t + f_p).alias("precision"),
                             _safe_div(t, t + f_n).alias("recall"),
                             _safe_div(t, t + 0.5 * (f_p + f_n)).alias("f1"),
                             (t + f_n).alias("support")))
    per = rows[0].unionByName(rows[1])
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       _safe_div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("precision"),
                       _safe_div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("recall"),
                       _safe_div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1"),
                       F.sum("support").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def threshold_grid(lo: int, hi: int, step: int, scale: int = 100) -> list[tuple[int, float]]:
    """Thresholds as integer/scale (no float drift): [(j, t_j)]."""
    return [(j, k / scale) for j, k in enumerate(range(lo, hi + 1, step))]


def threshold_scan(scored: DataFrame, grid: list[tuple[int, float]], label_col="label", prob_col="prob",
                   group_cols=()) -> DataFrame:
    """Confusion counts and metrics at every threshold (p >= t).

    Each row is binned once by how many thresholds it reaches (a CASE
    sum, exact); counts per (bin, label) are tiny and a suffix sum over
    bins gives every threshold -- no threshold x row product."""
    p = F.col(prob_col)
    reached = sum((p >= F.lit(t)).cast("int") for _, t in grid)
    b = (scored.withColumn("_bin", reached)
         .groupBy(*group_cols, "_bin")
         .agg(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).cast("long").alias("_pos"),
              F.sum(F.when(F.col(label_col) == 1, 0).otherwise(1)).cast("long").alias("_neg")))
    spark = scored.sparkSession
    g = spark.createDataFrame([(j, float(t)) for j, t in grid], "j int, threshold double")
    # a row reaches threshold j iff _bin >= j + 1: per-threshold sums over bins
    ex = b.filter(F.col("_bin") > 0).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("_bin") - 1)))
    tp_fp = ex.groupBy(*group_cols, "j").agg(F.sum("_pos").alias("tp"), F.sum("_neg").alias("fp"))
    tot = b.groupBy(*group_cols).agg(F.sum("_pos").alias("P"), F.sum("_neg").alias("N"))
    full = tot.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(grid) - 1))))
    x = full.join(tp_fp, list(group_cols) + ["j"], "left").fillna(0, ["tp", "fp"]).join(F.broadcast(g), "j")
    x = x.select(*group_cols, "j", "threshold", "tp", "fp",
                 (F.col("P") - F.col("tp")).alias("fn"), (F.col("N") - F.col("fp")).alias("tn"))
    return metrics_from_counts(x.withColumnRenamed("j", "_j"), list(group_cols) + ["_j", "threshold"]).drop("_j")


def best_threshold(scan: DataFrame, metric: str, default: float = 0.5, group_cols=()) -> DataFrame:
    """First threshold with the maximal metric (strictly better wins)."""
    w = Window.partitionBy(*group_cols).orderBy(F.desc(metric), F.asc("threshold"))
    return (scan.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
            .select(*group_cols, F.col("threshold").alias("best_threshold"), F.col(metric).alias("best_" + metric)))


def prediction_distribution(pred: DataFrame, pred_col="prediction") -> DataFrame:
    c = pred.groupBy(F.col(pred_col).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def confidence_summary(scored: DataFrame, prob_col="prob") -> DataFrame:
    conf = F.greatest(F.col(prob_col), F.lit(1.0) - F.col(prob_col))
    aggs = [F.avg("c").alias("mean_confidence"),
            F.sum(F.when(F.col("c") > 0.8, 1).otherwise(0)).cast("long").alias("n_high"),
            F.sum(F.when(F.col("c") < 0.6, 1).otherwise(0)).cast("long").alias("n_low"),
            (F.avg(F.when(F.col("c") > 0.8, 1.0).otherwise(0.0)) * 100).alias("pct_high"),
            (F.avg(F.when(F.col("c") < 0.6, 1.0).otherwise(0.0)) * 100).alias("pct_low")]
    m = exact_medians(written(scored.select(conf.alias("c"))), "c", aggs=aggs)
    return m.select("mean_confidence", F.col("median").alias("median_confidence"), "n_high", "n_low", "pct_high", "pct_low")


def log_loss(scored: DataFrame, label_col="label", prob_col="prob", weight_col: str | None = None) -> DataFrame:
    p = F.least(F.greatest(F.col(prob_col), F.lit(1e-15)), F.lit(1 - 1e-15))
    y = F.col(label_col).cast("double")
    ll = y * F.log(p) + (1 - y) * F.log(1 - p)
    if weight_col is None:
        return scored.agg((-F.avg(ll)).alias("log_loss"))
    return scored.agg((-F.sum(F.col(weight_col) * ll) / F.sum(weight_col)).alias("log_loss"))
