"""Bounded samples of labelled documents, for operators that fit a model on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barloom.llm.common import fold, id_and_text
from barloom.session import settle

#: Labelled rows of either class that a model is fitted on at most.
SAMPLE_PER_CLASS = 4096
FOLDS = 5


def training_labels(labels: DataFrame, label: str, folds: int = FOLDS) -> DataFrame:
    """``(doc_id, label)`` of rows outside the held-out fold.

    Labels other than 0 and 1 and null ids are left out; of several labels of an id the largest holds.
    """
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col(label).cast("int").alias("label"))
            .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
            .where(fold(F.col("doc_id"), folds) != 0)
            .groupBy("doc_id").agg(F.max("label").alias("label")))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str,
                    per_class: int = SAMPLE_PER_CLASS, folds: int = FOLDS
                    ) -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, text, label)`` of at most ``per_class`` documents of each class, and how many
    training labels each class has. Which ones depends on a hash of the id alone. Of documents
    that share an id, the least text counts."""
    known = settle(training_labels(labels, label, folds), "labels")
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    key = F.md5(F.concat(F.lit("sample:"), F.col("doc_id").cast("string")).cast("binary"))
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(key, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    # at most 2 * per_class ids
    texts = id_and_text(docs).join(F.broadcast(settle(chosen, "chosen")), "doc_id")
    sample = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return settle(sample.select("doc_id", "text", "label"), "sample"), sizes
