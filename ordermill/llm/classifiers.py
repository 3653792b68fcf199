"""The two document classifiers fitted on labelled rows and applied to a whole table.

Each reads its bounded training sample (``labelled.SampleBound``), trains on the
driver and adds a score column to every row; no row is shuffled for scoring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import compression_toxicity, subword_classifier
from ordermill.llm.labelled import SampleBound, labelled_sample

#: From which score on a text counts as good, and as toxic.
KEPT_QUALITY = 0.3
TOXIC = 0.5


def quality_scores(rows: DataFrame, docs: DataFrame, labels: DataFrame, score_col: str, text_col: str = "text",
                   bound: SampleBound = SampleBound(per_class=2000)) -> DataFrame:
    """``rows`` with the chance that a text is good, learned from ``docs`` and ``labels.quality``."""
    texts, known = labelled_sample(docs, labels, "quality", bound)
    model = subword_classifier.train(texts, known)
    return rows.withColumn(score_col, subword_classifier.Scorer(rows.sparkSession, model).score(F.col(text_col)))


def toxicity_scores(rows: DataFrame, docs: DataFrame, labels: DataFrame, score_col: str, text_col: str = "text",
                    bound: SampleBound = SampleBound(per_class=1000)) -> DataFrame:
    """``rows`` with the chance that a text is toxic, learned from ``docs`` and ``labels.toxic``."""
    texts, known = labelled_sample(docs, labels, "toxic", bound)
    model = compression_toxicity.train(texts, known)
    return rows.withColumn(score_col, compression_toxicity.Scorer(rows.sparkSession, model).score(F.col(text_col)))
