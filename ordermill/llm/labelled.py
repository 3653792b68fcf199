"""Bounded samples of labelled documents, to fit classifiers on.

Scores never see labels, language, source or id; these only choose the sample.

Defined results: ids may be of any type; a null id, a null label, or one other than 0 and 1 trains
nothing; a labelled id without a document, or with a null text, neither.  An empty table
gives an empty sample, from which no model is trained.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SampleBound:
    """At most ``per_class`` documents of each label, each of ``max_chars`` code points at most.

    These bound what the driver holds; they choose training rows only.
    """

    per_class: int = 2000
    max_chars: int = 30_000


def held_out(doc_id: Column) -> Column:
    """The fifth of all documents that no model learns from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: SampleBound = SampleBound(),
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], list[int]]:
    """Texts and labels (0 or 1), in an order that depends on ids alone.

    Labels of one id that contradict each other are left out, and of repeated
    documents the smallest text stands.
    """
    clear = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("id")).agg(
        F.min(label).cast("int").alias("label"), F.max(label).alias("other")).filter("label = other").drop("other")
    order = F.xxhash64("id")
    chosen = [clear.filter(F.col("label") == value).orderBy(order, "id").limit(bound.per_class) for value in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.length("text") <= bound.max_chars)
    # The sample is bounded, so it may be sent to all executors, and the result to the driver.
    rows = texts.join(F.broadcast(sample), "id").groupBy("id").agg(
        F.min("text").alias("text"), F.min("label").alias("label")).collect()
    rows.sort(key=lambda r: (hash_order(r["id"]), r["id"]))
    return [r["text"] for r in rows], [r["label"] for r in rows]


def hash_order(value: object) -> int:
    """A fixed shuffling of ids."""
    if not isinstance(value, int):
        value = int.from_bytes(hashlib.blake2b(str(value).encode("utf-8", "surrogatepass"), digest_size=8).digest())
    return (value * 0x9E3779B97F4A7C15 ^ value >> 7) & (1 << 64) - 1
