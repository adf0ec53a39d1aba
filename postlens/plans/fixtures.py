"""Derived, deterministic inputs built from the given tables (FIXTURES C).

``scores``: long model scores ``(id, model, prob, label)`` for every
labelled post -- closed formulas of the text through a sigmoid, plus one
model whose scores are all tied.  Probabilities are rounded to 9
decimals so that ties do not depend on the engine's summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.text import sigmoid_clip, text_stat_columns
from postlens.plans import sqlfrag as S
from postlens.sources import train_posts

# model -> (statistic, scale, centre): prob = sigmoid(scale * (stat - centre))
SCORE_MODELS = {
    "m_upper": ("upper_ratio", 40.0, 0.03),
    "m_punct": ("punct_ratio", 30.0, 0.03),
    "m_len": ("log_len", 1.0, 7.5),
    "m_unique": ("unique_word_ratio", 10.0, 0.6),
}
TIED_MODEL = "m_tied"


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = train_posts(spark, sf_dir)
    st = text_stat_columns("post")
    stats = {"upper_ratio": st["upper_ratio"], "punct_ratio": st["punct_ratio"],
             "unique_word_ratio": st["unique_word_ratio"], "log_len": F.log(st["n_chars"] + F.lit(1.0))}
    cols = [F.struct(F.lit(m).alias("model"),
                     F.round(sigmoid_clip(F.lit(k) * (stats[s] - F.lit(c))), 9).alias("prob"))
            for m, (s, k, c) in SCORE_MODELS.items()]
    cols.append(F.struct(F.lit(TIED_MODEL).alias("model"), F.lit(0.5).alias("prob")))
    return p.select("id", "label", F.explode(F.array(*cols)).alias("s")).select(
        "id", "s.model", "s.prob", "label")


def scores_sql() -> str:
    st = S.text_stats_sql("post")
    stats = {"upper_ratio": st["upper_ratio"], "punct_ratio": st["punct_ratio"],
             "unique_word_ratio": st["unique_word_ratio"], "log_len": f"ln({st['n_chars']} + 1.0)"}
    parts = [f"SELECT id, '{m}' AS model, round({S.sigmoid_sql(f'{k} * (({stats[s]}) - {c})')}, 9) AS prob, label FROM ({S.POSTS})"
             for m, (s, k, c) in SCORE_MODELS.items()]
    parts.append(f"SELECT id, '{TIED_MODEL}' AS model, 0.5::DOUBLE AS prob, label FROM ({S.POSTS})")
    return "(" + " UNION ALL ".join(parts) + ")"
