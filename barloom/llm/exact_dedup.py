"""Exact duplicates by deterministic block naming, in DataFrame operations only.

Sorting gives equal blocks of text one integer name. Adjacent names are paired and the pairs are
named in the same way, level by level, until each document has a single name. Two documents of the
same length have the same name exactly when their texts are equal: no hash decides anything.

Every row is named. As an option, rows that share their length and first characters with no other row can be
left unsorted, since nothing can equal them.

A block, a pair or a text that more than a thousandth of all rows hold is *hot*. There are fewer than a thousand of
each, so the hot ones are named once and sent to every task; all others meet in the task of their hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.llm.common import lower_ascii
from barloom.session import broadcast_if_small, settle

BLOCK_CHARS = 16_384
#: Fewer keys than this can each hold more than one in so many of the rows.
HOT_KEYS = 1000


def named(values: DataFrame, by: list[str], count: int) -> DataFrame:
    """``values`` with ``name``: one integer for the rows that agree in ``by``, and for no others.

    ``count`` is how many rows there are. Settled, so names stay. Rows are dealt by a hash of ``by`` and sorted, and
    the first row of each run numbers it; hot values are numbered apart, with odd numbers.
    """
    key = F.xxhash64(*by).alias("_key")
    hot = settle(values.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > count // HOT_KEYS).select("_key", F.lit(True).alias("_hot")), "hot")
    keyed = values.select("*", key).join(F.broadcast(hot), "_key", "left")
    often = keyed.where("_hot").drop("_key", "_hot")
    names = settle(often.select(*by).distinct().withColumn(
        "name", F.monotonically_increasing_id() * 2 + 1), "names")
    run = Window.partitionBy(*by)
    first = F.row_number().over(run.orderBy("row")) == 1
    seldom = (keyed.where("_hot is null").drop("_key", "_hot").withColumn("_first", first)
              .withColumn("_id", F.when(F.col("_first"), F.monotonically_increasing_id()))
              .withColumn("name", F.max("_id").over(run) * 2).drop("_first", "_id", *by))
    return settle(seldom.unionByName(often.join(F.broadcast(names), by).drop(*by)), "level")


def text_names(texts: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(row, length, norm)`` to ``(row, length, name)``: rows of one length share a name
    exactly when their ``norm`` is equal."""
    # most texts are one block, which needs no pattern
    pieces = F.when(F.col("length") <= block_chars, F.array("norm")).otherwise(
        F.regexp_extract_all("norm", F.lit("(?s).{1,%d}" % block_chars), F.lit(0)))
    blocks = texts.select("row", "length", F.posexplode_outer(pieces).alias("at", "block")).select(
        "row", "length", F.coalesce("at", F.lit(0)).cast("long").alias("at"),
        F.coalesce("block", F.lit("")).alias("block"))
    size = texts.agg(F.sum(F.greatest(F.ceil(F.col("length") / block_chars), F.lit(1))).alias("n"),
                     F.max("length").alias("longest")).head()
    last = max(-(-(size["longest"] or 0) // block_chars) - 1, 0)
    level = named(blocks, ["block"], size["n"] or 0)
    while last > 0:
        left, right = (F.max(F.when(F.col("at") % 2 == k, F.col("name"))) for k in (0, 1))
        pairs = level.groupBy("row", "length", F.floor(F.col("at") / 2).alias("at")).agg(
            left.alias("left"), F.coalesce(right, F.lit(-1)).alias("right"))
        level = named(pairs, ["left", "right"], level.count())
        last //= 2
    return level.select("row", "length", "name")


def _told(named_rows: DataFrame, groups: DataFrame, keys: list[str], count: int) -> DataFrame:
    """Each row with its group: those of hot groups by a broadcast of fewer than ``HOT_KEYS`` rows."""
    groups = settle(groups, "groups")
    hot = F.col("group_size") > count // HOT_KEYS
    often, seldom = groups.where(hot), groups.where(~hot)
    rest = named_rows.join(F.broadcast(often.select(*keys)), keys, "left_anti")
    return named_rows.join(F.broadcast(often), keys).unionByName(rest.join(seldom, keys))


def _judged(docs: DataFrame, carried: list[str], id_col: str, text_col: str, normalise, block_chars: int,
            probe_chars: int) -> tuple[DataFrame, DataFrame]:
    """The rows, numbered and written once with the ``carried`` columns in a struct, and the verdict on each."""
    every = F.struct(*(F.col(f"`{c}`") for c in carried)).alias("carried")
    norm = normalise(F.coalesce(F.col("carried").getField(text_col), F.lit("")))
    rows = settle(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), every)
        .withColumns({"length": F.length(norm).cast("long"), "text_sha256": F.sha2(norm.cast("binary"), 256)}), "rows")
    texts, alone = rows.select("row", "length", norm.alias("norm")), None
    if probe_chars:
        probe = F.substring("norm", 1, probe_chars)
        shared = settle(texts.groupBy("length", probe.alias("probe")).count().where("count > 1")
                        .select("length", "probe"), "shared")
        match = (texts["length"] == shared["length"]) & (F.substring(texts["norm"], 1, probe_chars) == shared["probe"])
        alone = texts.join(shared, match, "left_anti").select("row").join(rows.select("row", "doc_id"), "row")
        texts = settle(texts.join(shared, match, "left_semi"), "asked")

    names = text_names(texts, block_chars)
    # the largest id first, of equal ids the first row
    best = F.max(F.struct("doc_id", (-F.col("row")).alias("row"))).alias("best")
    groups = names.join(rows.select("row", "doc_id"), "row").groupBy("length", "name").agg(
        best, F.count(F.lit(1)).alias("group_size"))
    judged = _told(names, groups, ["length", "name"], names.count()).select(
        "row", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == -F.col("best.row")).alias("kept"))
    if alone is not None:
        judged = judged.unionByName(alone.select(
            "row", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept")))
    return rows, judged


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 normalise=lower_ascii, block_chars: int = BLOCK_CHARS,
                 probe_chars: int = 0) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if their ``normalise``d forms are; null is empty, and empty texts are equal.
    Of equal texts the row with the largest id stays (null ids come last); of repeated ids, one.
    Other columns are not read. An empty table gives no rows. With ``probe_chars`` only rows that share their length
    and so many first characters with another are sorted; the result is the same.
    """
    rows, judged = _judged(docs, list(dict.fromkeys([id_col, text_col])), id_col, text_col, normalise, block_chars,
                           probe_chars)
    return rows.select("row", "doc_id", "text_sha256").join(judged, "row").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                normalise=lower_ascii, block_chars: int = BLOCK_CHARS,
                probe_chars: int = 0) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever they are called."""
    rows, judged = _judged(docs, docs.columns, id_col, text_col, normalise, block_chars, probe_chars)
    dropped = broadcast_if_small(judged.where("not kept").select("row"))
    return rows.select("row", "carried").join(dropped, "row", "left_anti").select("carried.*")
