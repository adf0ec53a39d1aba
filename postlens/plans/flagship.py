"""The minimum end-to-end slice.

documents JOIN labels -> clean_post -> tokenize_words -> term_counts ->
stratified_split -> build_vocabulary (train rows) -> multinomial NB
(closed form) -> threshold_predict -> binary_metrics by language.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.text import clean_post
from postlens.operators.evaluate import binary_metrics
from postlens.operators.features import build_vocabulary, term_counts, tokenize_words
from postlens.operators.models.nb import fit_multinomial_nb, score_nb
from postlens.operators.split import stratified_split
from postlens.sources import table, train_posts

FLAGSHIP = dict(val_frac=0.2, seed=42, min_df=2, max_features=2000, alpha=1.0, threshold=0.5)


def nb_scores(spark: SparkSession, sf_dir: str, p: dict = FLAGSHIP) -> DataFrame:
    """Validation rows scored by multinomial NB: (id, label, prob, prediction)."""
    posts = train_posts(spark, sf_dir).withColumn("clean", clean_post("post"))
    posts = stratified_split(posts, p["val_frac"], p["seed"])
    toks = tokenize_words(posts, "clean")
    # reused by vocabulary, fit and scoring: keep it (recomputed from
    # lineage if an executor is lost)
    counts = term_counts(toks.select("id", "tokens")).persist(StorageLevel.MEMORY_AND_DISK)
    train = posts.filter(F.col("split") == "train").select("id", "label")
    val = posts.filter(F.col("split") == "val").select("id", "label")
    train_counts = counts.join(train.select("id"), "id", "left_semi")
    vocab = build_vocabulary(train_counts, min_df=p["min_df"], max_features=p["max_features"])
    model = fit_multinomial_nb(train_counts, train, vocab, alpha=p["alpha"])
    val_counts = counts.join(val.select("id"), "id", "left_semi")
    s = score_nb(model, val_counts, val)
    return (val.join(s, "id")
            .withColumn("prediction", (F.col("prob") >= p["threshold"]).cast("int"))
            .select("id", "label", "prob", "prediction"))


def nb_model(spark: SparkSession, sf_dir: str, p: dict = FLAGSHIP):
    """The flagship's fitted NB model (likelihood and prior tables)."""
    posts = stratified_split(train_posts(spark, sf_dir).withColumn("clean", clean_post("post")), p["val_frac"], p["seed"])
    counts = term_counts(tokenize_words(posts, "clean").select("id", "tokens"))
    train = posts.filter(F.col("split") == "train").select("id", "label")
    train_counts = counts.join(train.select("id"), "id", "left_semi")
    vocab = build_vocabulary(train_counts, min_df=p["min_df"], max_features=p["max_features"])
    return fit_multinomial_nb(train_counts, train, vocab, alpha=p["alpha"])


def flagship(spark: SparkSession, sf_dir: str, p: dict = FLAGSHIP) -> DataFrame:
    """binary metrics of the NB model per document language."""
    s = nb_scores(spark, sf_dir, p).persist(StorageLevel.MEMORY_AND_DISK)
    lang = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    m = binary_metrics(s.join(lang, "id"), ["lang"])
    return m.select("lang", "n", *[F.round(c, 6).alias(c) for c in
                                   ("accuracy", "precision", "recall", "f1", "macro_f1", "auc")])
