"""TF-IDF of posts into MLlib classifiers, all inside the JVM: count vectors over
a fitted vocabulary, IDF weights, L2 norm, no Python per row and no shuffle but
the vocabulary's and, where a classifier asks for it, one of the feature rows."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, Normalizer
from pyspark.sql import DataFrame

from postlens.operators import features as FE

#: Rows a task of a forest reads: MLlib keeps a row as one int a feature, 20 kB at 5,000
#: features however short the post is, and reads all rows again for every group of nodes.
FOREST_ROWS = 4_096


def tfidf_stages(max_features: int = 5000, min_df: float = 2.0, tokens_col: str = "tokens", out: str = "features") -> list:
    """Vocabulary of the ``max_features`` most frequent terms in at least ``min_df`` posts."""
    return [CountVectorizer(inputCol=tokens_col, outputCol="_tf", vocabSize=max_features, minDF=min_df),
            IDF(inputCol="_tf", outputCol="_tfidf"), Normalizer(inputCol="_tfidf", outputCol=out, p=2.0)]


def fit_text_model(train: DataFrame, classifier, max_features: int = 5000, min_df: float = 2.0, text_col: str = "post",
                   parts: int = 1, id_col: str = "id"):
    """Everything is fitted on the training rows alone, so nothing leaks from the others.  With
    ``parts`` over 1 the classifier's rows are dealt by ``id_col`` to as many partitions and sorted by
    it (a forest draws its samples by partition and place); else they stay as they come."""
    toks = FE.tokenize_words(train, text_col)
    stages = tfidf_stages(max_features, min_df)
    if parts <= 1:
        return Pipeline(stages=[*stages, classifier]).fit(toks)
    tfidf = Pipeline(stages=stages).fit(toks)
    rows = tfidf.transform(toks).drop(text_col, "tokens", "_tf", "_tfidf").repartition(parts, id_col).sortWithinPartitions(id_col)
    return PipelineModel([*tfidf.stages, classifier.fit(rows)])


def predict_text_model(model, df: DataFrame, text_col: str = "post") -> DataFrame:
    return model.transform(FE.tokenize_words(df, text_col))
