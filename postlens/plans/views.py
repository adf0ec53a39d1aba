"""Multi-view feature table: word TF-IDF, hashed counts and text
statistics side by side in one vector per post (the MLlib boundary)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession

from postlens.operators import features as FE
from postlens.operators.hygiene import text_stat_vector
from postlens.sources import train_posts


def multi_view_features(spark: SparkSession, sf_dir: str, max_features: int = 2000,
                        hash_features: int = 1 << 10) -> DataFrame:
    posts = train_posts(spark, sf_dir)
    toks = FE.tokenize_words(posts, "post")
    counts = FE.term_counts(toks)
    n = posts.count()
    vocab = FE.build_vocabulary(counts, n_docs=n, min_df=2, max_df=0.95, max_features=max_features)
    tf = FE.tfidf(counts, vocab, n, sublinear=True)
    size = vocab.count()
    word = FE.to_vectors(tf.select("id", "idx", "value"), size, out="v_word", ids=posts.select("id"))
    hashed = FE.hashed_counts(toks, "tokens", hash_features, out="v_hash").select("id", "v_hash")
    stats = text_stat_vector(posts, "post", out="v_stats")
    # a post without any word of the vocabulary keeps its row, with an empty vector
    x = posts.select("id", "label").join(word, "id").join(hashed, "id").join(stats, "id")
    return VectorAssembler(inputCols=["v_word", "v_hash", "v_stats"], outputCol="features").transform(x).select(
        "id", "label", "features")
