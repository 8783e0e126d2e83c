"""Mixing sources to target weights, in DataFrame operations only.

Words are summed per source, targets follow from weights, and a source's repetition rate is its
target over its size. Each document is taken floor(rate) times, and once more if a number drawn
from a hash of its id lies below the fraction. Nothing is ordered or numbered across documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.llm.common import WORD
from barloom.session import broadcast_if_small, settle

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix-1"


def _key(source: Column) -> Column:
    """A join key that a null source has too."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("")).alias("key")
#: A name that no source has, so that a null source can be a join key.
_NO_SOURCE = "none"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   most: int = MOST_REPEATS) -> DataFrame:
    """``(source, size)`` of documents to ``(source, source_size, target, rate)``.

    Sources in code point order, null last, take ``weights`` in turn and share the sum of all
    sizes. A target ends at ``most`` times the source's size; the excess goes to the others by
    weight until none is above. Sources with the least size per weight end first, so one pass over
    them in that order finds the level at which the others stand. The windows here see one row per
    source, never a document.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weighted = per_source.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long"))
    fullest = Window.orderBy(F.col("source_size") / F.col("weight"),
                             F.col("source").asc_nulls_last())
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    everything = fullest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    level = ((total - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
             / (F.sum("weight").over(everything)
                - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    levels = weighted.withColumn("level", level)
    # the first source that its level does not fill sets the level of all after it
    holds = F.col("level") * F.col("weight") <= most * F.col("source_size")
    stands = F.first(F.when(holds, F.col("level")), ignorenulls=True).over(everything)
    target = F.least(stands * F.col("weight"), (most * F.col("source_size")).cast("double"))
    return levels.select(
        "source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone: 48 bits of a digest."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long") / (1 << 48)


def copies_of(rate: Column, doc_id: Column, seed: str = SEED) -> Column:
    whole = F.floor(rate)
    return whole + F.when(draw(doc_id, seed) < rate - whole, 1).otherwise(0)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
          most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, copies, taken``.

    A null text has no words; a null source is a source. Rows that repeat an id share its draw.
    An empty table gives no rows; where no document has a word, all targets are 0.
    """
    sized = settle(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               words(F.col(text_col)).alias("size")), "sizes")  # texts are read once
    return _with_copies(sized, source_targets(sized, weights, most), seed)


def _with_copies(sized: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    key = _key(F.col("source"))
    rates = broadcast_if_small(targets.select(key, "source_size", "target", "rate"))
    copies = copies_of(F.col("rate"), F.col("doc_id"), seed)
    return (sized.withColumn("key", key).join(rates, "key").withColumn("copies", copies)
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
        most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix itself: each row of ``docs``, all its columns, as often as it is taken."""
    sizes = docs.select(F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"))
    rates = source_targets(sizes, weights, most).select(
        _key(F.col("source")), "rate")
    every = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    held = docs.select(every, _key(F.col(source_col)))
    taken = held.join(broadcast_if_small(rates), "key").select(
        "row", copies_of(F.col("rate"), F.col("row")[id_col], seed).cast("int").alias("copies"))
    return (taken.where("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .select("row.*"))
