"""A corpus from raw documents to packed training bins, stage by stage.

Each stage takes the documents that the stage before it kept, as stored and
read again, and returns documents with the same columns; the last returns the
packing.  ``sf_dir`` holds the tables that a stage needs besides (labels).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import classifiers, jaccard_forest, packing, secret_scan
from ordermill.session import materialize, use_checkpoint_folder

#: Columns that stages add for a moment; no table has them.
SCORE = "__score_of_stage"


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    use_checkpoint_folder(spark)
    scored = classifiers.quality_scores(docs, docs, _labels(spark, sf_dir), SCORE)
    return scored.filter(F.col(SCORE) >= classifiers.KEPT_QUALITY).select(*[docs[c] for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    use_checkpoint_folder(spark)
    scored = classifiers.toxicity_scores(docs, docs, _labels(spark, sf_dir), SCORE)
    return scored.filter(F.col(SCORE) < classifiers.TOXIC).select(*[docs[c] for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    use_checkpoint_folder(spark)
    return jaccard_forest.keep_one_per_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark; n_chars follows the text."""
    use_checkpoint_folder(spark)
    cleaned = docs.withColumn("text", secret_scan.scanner(docs).redacted(F.col("text")))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(
            F.col("n_chars").isNotNull(), F.length("text")).cast(dict(docs.dtypes)["n_chars"]))
    return cleaned.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the bins they are packed in."""
    use_checkpoint_folder(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("best-fit packing", packed),
]

#: Trained classifiers and a trained field decide: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each stage's result is stored before the next reads it."""
    use_checkpoint_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
