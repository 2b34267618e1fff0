"""Quality and toxicity by ordinal regression; both fit on labels and score every whole text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithlink.llm import ordinal


def classify_quality(docs: DataFrame, labels: DataFrame, keep_grade: int = 1, keep_at: float = 0.5, grade_col: str = "quality", max_rows: int = ordinal.MAX_TRAINING_ROWS) -> DataFrame:
    """One row per document: doc_id, expected_grade, tail_probability = P(grade >= keep_grade), keep (tail_probability >= keep_at).

    Words and form of the text share one weight vector under ordered thresholds; grades are whatever integers the labels hold.
    Null texts count as empty, very long ones whole. Repeated rows each give a row. An empty docs gives an empty result. Without labels, or with one grade only, every row gets that
    grade. Only doc_id and text are read. Fit on at most max_rows labels.
    """
    model = ordinal.fit_on(docs, labels, grade_col, ordinal.quality_features, max_rows=max_rows)
    scored = ordinal.score(docs, model, ordinal.quality_features, keep_grade)
    return scored.select("doc_id", F.col("expected").alias("expected_grade"), F.col("tail").alias("tail_probability"), (F.col("tail") >= keep_at).alias("keep"))


def toxicity_model(docs: DataFrame, labels: DataFrame, grade_col: str = "toxic", max_rows: int = ordinal.MAX_TRAINING_ROWS) -> ordinal.OrdinalModel:
    return ordinal.fit_on(docs, labels, grade_col, ordinal.word_features, max_rows=max_rows)


def score_toxicity(docs: DataFrame, labels: DataFrame, reject_grade: int = 1, reject_at: float = 0.35) -> DataFrame:
    """One row per document: doc_id, expected_severity, tail_probability = P(severity >= reject_grade), toxic (tail_probability >= reject_at).

    Null and empty texts have no words and get the severity that the thresholds alone give. Repeated rows each give a row.
    Very long texts count whole. An empty docs gives an empty result. Without labels nothing is toxic. Only doc_id and text are read.
    """
    scored = ordinal.score(docs, toxicity_model(docs, labels), ordinal.word_features, reject_grade)
    return scored.select("doc_id", F.col("expected").alias("expected_severity"), F.col("tail").alias("tail_probability"), (F.col("tail") >= reject_at).alias("toxic"))


def drop_toxic(docs: DataFrame, labels: DataFrame, reject_grade: int = 1, reject_at: float = 0.35) -> DataFrame:
    """The rows of docs, all their columns, but those that score_toxicity() finds toxic."""
    return ordinal.below(docs, toxicity_model(docs, labels), ordinal.word_features, reject_grade, reject_at)
