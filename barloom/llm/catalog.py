"""The queries of these operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm import (
    exact_dedup, importance, language_model, mixing, near_dedup, packing, personal_data, quality_classifier,
    quality_rules, ranked_search, secrets_scan, toxicity, url_filter)
from barloom.llm.common import id_and_text, is_held_out
from barloom.llm.labelled import FOLDS
from barloom.session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts; the largest id stays."""
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


ORACLES["op3_exact_dedup"] = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') as norm
  from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       row_number() over (partition by norm order by doc_id desc) = 1 as kept,
       sha256(norm) as text_sha256
from d window w as (partition by norm)
"""


@query
def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mixed(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


ORACLES["op5_source_mix"] = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
      from s),
p as (select *, sum(source_size) over ()::bigint as total, sum(weight) over ()::bigint as weights,
        coalesce(sum(source_size) over b, 0)::bigint as full_size,
        coalesce(sum(weight) over b, 0)::bigint as full_weight
      from w
      window b as (order by source_size / weight, source nulls last
                   rows between unbounded preceding and 1 preceding)),
l as (select *, (total - 3 * full_size) / (weights - full_weight) as level from p),
k as (select max(level) as level from (
        select level, row_number() over (order by source_size / weight, source nulls last) as n
        from l where level * weight <= 3 * source_size) where n = 1),
t as (select source, source_size,
        coalesce(least(k.level * weight, (3 * source_size)::double), 0.0) as target
      from l, k),
r as (select d.*, t.source_size, t.target,
        case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
        ('0x' || substr(md5('mix-1:' || coalesce(doc_id::varchar, '')), 1, 12))::bigint
          / (1::bigint << 48) as u
      from d join t on d.source is not distinct from t.source)
select doc_id, size::bigint as size, source_size, target,
       (size * (floor(rate) + case when u < rate - floor(rate) then 1 else 0 end))::bigint as taken
from r
"""


@query
def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The class of each document under links of 0.8 between sets of five-word shingles."""
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of each document by its nearest labelled examples."""
    docs = id_and_text(table(spark, folder, "documents"))
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.with_scores(docs, model).select(
        "doc_id", is_held_out(F.col("doc_id"), FOLDS).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "evidence")


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of each document by the log densities of its statistics."""
    docs = id_and_text(table(spark, folder, "documents"))
    described = settle(quality_classifier.with_statistics(docs, carried=["doc_id"]), "statistics")
    model = quality_classifier.fit(described, table(spark, folder, "labels"))
    return quality_classifier.with_scores(described, model).select(
        "doc_id", is_held_out(F.col("doc_id"), FOLDS).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"))


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Exact counts of each document, the fixed rules, and the verdict of the trees."""
    docs = id_and_text(table(spark, folder, "documents"))
    described = settle(quality_rules.counted(docs, carried=["doc_id"]), "counts")
    trees = quality_rules.fit(described, table(spark, folder, "labels"))
    return quality_rules.judged(described, trees).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule_score")


def byte_bpe() -> tuple[str, str, str]:
    """The public byte-level vocabulary: its file, its ranks, and how it splits texts."""
    import public_tokenizers

    return (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
            public_tokenizers.PATTERN)


@query
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.packed(table(spark, folder, "documents"), byte_bpe())


@query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on each page's url."""
    return url_filter.judged_urls(table(spark, folder, "pages"))


ORACLES["op2_url_filter"] = url_filter.oracle()


@query
def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in each document by fixed patterns and by the cost of guessing a value."""
    docs = id_and_text(table(spark, folder, "documents"))
    return secrets_scan.with_secrets(docs, carried=["doc_id"])


@query
def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """The probability of each document under the interpolated model."""
    return language_model.scored(table(spark, folder, "documents"))


@query
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op11_ranked_search"] = ranked_search.oracle()


@query
def op12_importance_sampling(spark: SparkSession, folder: str) -> DataFrame:
    """The weight, score and rank of each document in a draw towards the benchmark's words."""
    return importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op12_importance_sampling"] = importance.oracle()


@query
def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in each document by fixed patterns and by labelers that a classifier weighs."""
    return personal_data.personal_data(id_and_text(table(spark, folder, "documents")), carried=["doc_id"])
