"""From documents to packed sequences: reject toxic ones, remove copies, mix, pack.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept. All but the last
return the columns of ``docs``, whatever they are called; the last returns the packed pieces. Null
and empty texts pass the first two stages like others (empty ones are copies of each other), are
classes of their own in the third, have no words in the fourth, so the mix takes them as often as
their source's rate says, and are an end token each in the last. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from barloom.llm.arrow_text import settle_texts
from barloom.llm.catalog import byte_bpe, table
from barloom.session import broadcast_if_small, settle


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score is below the threshold; labels of the held-out fold are not used.

    Where labels of one class are missing, nothing can be told apart and all documents stay. A score is that of a
    text, so only texts go through Python: rows leave by the digest of theirs.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    if isinstance(model, float):
        return docs
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    scored = toxicity.with_scores(docs.select(digest.alias("digest"), F.coalesce("text", F.lit("")).alias("text")),
                                  model, carried=["digest"])
    toxic = settle_texts(scored.where(F.col("toxic_score") >= toxicity.THRESHOLD).select("digest"), "toxic")
    digests = broadcast_if_small(toxic.distinct())
    return docs.join(digests, digest == digests["digest"], "left_anti")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row with the smallest id."""
    return near_dedup.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.packed(docs, byte_bpe())


STAGES = [("toxicity", reject_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("source_mix", mix_sources), ("packing", pack)]

#: No SQL expresses nearest neighbours, ProbMinHash or the tokenizer; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
