"""Importance resampling towards a target distribution, ranked by parallel sorting by regular sampling.

Each feature (a run of words) falls into a bucket by a hash. A bucket's gain is the logarithm of its share in
the target over its share in all documents, in arrays of one number per bucket; a document's weight is the
mean gain of its features, and its score the weight plus Gumbel noise from a hash of its id. The highest
scores are the draw.

Ranks are exact. Each partition is sorted by itself (a run). Every run gives samples at regular
steps, and the samples in order give splitters at regular steps. Rows go to the segment between two
splitters, segments are counted, and prefix sums of the counts say with which rank each begins.
Only segments that hold a drawn row are exchanged; each is merged and numbered from its first rank on.
The order ends with a row number, so a splitter can fall between rows of equal score and id.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from barloom.llm.arrow_text import (
    Words, giving_back, settle_texts, slices, small_batches, texts_of, with_columns_in_arrow)
from barloom.llm.terms import terms_of
from barloom.session import settle, ship_package

LONGEST_RUN = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Rows that a segment holds on average; beyond ``MOST_SEGMENTS`` segments they grow instead.
SEGMENT_ROWS = 1 << 12
MOST_SEGMENTS = 4096
#: Samples per segment, which all come to the driver: 65,536 at most, and one more per run.
SAMPLES = 16


def features(words: Words, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, bucket)`` of each run of 1 to ``longest`` words, joined by one space."""
    names = [n.encode() for n in words.names.to_pylist()]
    crc = np.array([zlib.crc32(n) for n in names], np.int64)
    run, owner = words.ids, words.owners()
    owners, found = [owner], [crc[run] if len(run) else run]
    for size in range(2, longest + 1):
        # a longer run is a shorter one, a space, and the next word; its hash goes on from the shorter one's
        whole = owner[:len(run) - 1] == owner[1:len(run)] if len(run) else np.zeros(0, bool)
        pairs = run[:-1][whole] * max(len(names), 1) + words.ids[size - 1:][whole] if len(run) else run
        distinct, run_of = np.unique(pairs, return_inverse=True)
        crc = np.array([zlib.crc32(b" " + names[p % len(names)], int(crc[p // len(names)]))
                        for p in distinct.tolist()], np.int64)
        # places where no whole run begins keep a run of their own, so that places stay aligned
        again = np.full(len(whole), len(crc), np.int64)
        again[whole] = run_of.reshape(-1)
        crc = np.append(crc, 0)
        kept = np.flatnonzero(whole)
        owners.append(owner[kept])
        found.append(crc[again[kept]])
        run, owner = again, owner[:len(whole)]
        owner = np.where(whole, owner, -1 - np.arange(len(owner)))
    return np.concatenate(owners), np.concatenate(found) % buckets


def bucket_counts(docs: DataFrame, text_col: str = "text", longest: int = LONGEST_RUN,
                  buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; each task adds up its own first."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                _, bucket = features(terms_of(texts_of(part, "text")), longest, buckets)
                total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    with small_batches(docs.sparkSession):
        rows = (docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(giving_back(run), "bucket long, n long")
                .groupBy("bucket").agg(F.sum("n").alias("n")).collect())      # one row per bucket
    counts = np.zeros(buckets, np.int64)
    for row in rows:
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(smoothed share in the target / smoothed share in the source)) per bucket."""
    s, t, buckets = source.astype(np.float64), target.astype(np.float64), float(len(source))
    ratio = (t + 1.0) * (s.sum() + buckets) / ((s + 1.0) * (t.sum() + buckets))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


WEIGHED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()),
                        T.StructField("weight", T.LongType())])


def with_weights(docs: DataFrame, gain: np.ndarray, text_col: str = "text", longest: int = LONGEST_RUN,
                 carried: list[str] | None = None) -> DataFrame:
    """``carried`` columns (all, if not given) and ``WEIGHED``; a text without features weighs 0."""

    def work(texts: pa.Array) -> list[pa.Array]:
        words = terms_of(texts)
        n = len(words.sizes)
        owner, bucket = features(words, longest, len(gain))
        many = np.bincount(owner, minlength=n)
        # sums of whole numbers far below 2^53 are exact in doubles
        total = np.bincount(owner, weights=gain[bucket], minlength=n).astype(np.int64)
        return [pa.array(x) for x in (words.sizes, many, total // np.maximum(many, 1))]

    return with_columns_in_arrow(docs, text_col, WEIGHED, work, docs.columns if carried is None else carried)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))), u from the first 32 bits of a digest of seed and id (a null id: no text)."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((drawn + 0.5) / 4294967296.0))).cast("long")


def _in_order(score: int, doc_id, row: int) -> tuple:
    return (-score, doc_id is None, 0 if doc_id is None else doc_id, row)


def _keys(batch: pa.RecordBatch) -> list[tuple]:
    return [_in_order(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("score", "key", "row")))]


def regular_splitters(rows: DataFrame, order: list[Column], count: int, segments: int) -> list[tuple]:
    """At most ``segments - 1`` keys that part ``rows`` about evenly, from regular samples of sorted runs."""
    step = max(1, count // (segments * SAMPLES))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skip = step - 1
        for batch in batches:
            yield batch.take(pa.array(range(skip, batch.num_rows, step), pa.int64()))
            skip = (skip - batch.num_rows) % step

    keyed = rows.select("score", "key", "row")
    sampled = keyed.sortWithinPartitions(*order).mapInArrow(sample, keyed.schema).collect()
    keys = sorted(_in_order(r["score"], r["key"], r["row"]) for r in sampled)
    every = max(1, -(-len(keys) // segments))
    return keys[every - 1:-1:every] if len(keys) > 1 else []


def ranks(rows: DataFrame, drawn: int, count: int) -> DataFrame:
    """``rows`` (settled; ``score``, ``key`` and a unique ``row`` give the order) with the exact ``rank`` of the first
    ``drawn`` in order, null for the others. ``count`` is how many rows there are."""
    order = [F.desc("score"), F.col("key").asc_nulls_last(), F.col("row")]
    segments = max(1, min(MOST_SEGMENTS, -(-count // SEGMENT_ROWS)))
    splitters = regular_splitters(rows, order, count, segments)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = [bisect.bisect_left(splitters, k) for k in _keys(batch)]
            yield batch.append_column("segment", pa.array(place, pa.int32()))

    dealt = settle(rows.mapInArrow(deal, T.StructType(rows.schema.fields + [
        T.StructField("segment", T.IntegerType())])), "dealt")
    sizes = dict(dealt.groupBy("segment").count().collect())     # at most MOST_SEGMENTS rows
    first, before = [], 0
    for segment in range(len(splitters) + 1):
        if before >= drawn:
            break
        first.append((segment, before))
        before += sizes.get(segment, 0)
    none = F.lit(None).cast("long").alias("rank")
    rest = dealt.where(F.col("segment") >= len(first)).select(*rows.columns, none)
    if not first:
        return rest
    starts = rows.sparkSession.createDataFrame(first, "segment int, before long")
    place = F.row_number().over(Window.partitionBy("segment").orderBy(*order))
    merged = (dealt.where(F.col("segment") < len(first)).withColumn("place", place)
              .join(F.broadcast(starts), "segment").withColumn("rank", F.col("before") + F.col("place")))
    return merged.select(*rows.columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              target_text_col: str = "text", longest: int = LONGEST_RUN, buckets: int = BUCKETS,
              least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_features, weight, score, rank``.

    Of the rows with ``least_words`` words or more, ``percent`` in a hundred (rounded down) are drawn, by the
    highest scores, ties to the smaller id; ``rank`` numbers them from 1 and is null for all others. Ids may
    be of any type that has an order; a null id comes last and its noise is that of an empty text. Rows that
    repeat an id share its noise and each count. A null or empty text has no features and weighs 0. Other
    columns are not read. Empty ``docs`` give no rows; an empty ``target`` is a target without features.
    """
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("key"),
                         F.col(f"`{text_col}`").alias("text"))
    gain = gains(bucket_counts(source, "text", longest, buckets),
                 bucket_counts(target, target_text_col, longest, buckets))
    scored = settle_texts(with_weights(source, gain, "text", longest, ["row", "key"])
                    .withColumn("score", F.col("weight") + noise(F.col("key"), seed)), "scored")
    asked = scored.where(F.col("n_words") >= least_words)
    count = asked.count()
    drawn = count * percent // 100
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranks(asked, drawn, count).unionByName(others).select(
        F.col("key").alias(id_col), "n_features", "weight", "score", "rank")


def oracle() -> str:
    """The same in SQL over ``documents`` and ``benchmark``; crc32 from its polynomial, per distinct word."""
    def words(table: str, key: str) -> str:
        return (f"select {key}, unnest(regexp_extract_all(translate(coalesce(text, ''),"
                f" 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
                r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from " + table)
    return f"""
with d as ({words('documents', 'doc_id')}), b as ({words('benchmark', 'item_id')}),
bits as (select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
           case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i::bigint)) as of_byte),
w as (select word, xor(list_reduce(list_transform(range(1, length(hex(word)) + 1, 2), lambda i:
           ('0x' || substr(hex(word), i, 2))::bigint), lambda c, x:
           xor(c >> 8, of_byte[(xor(c, x) & 255) + 1]), 4294967295::bigint), 4294967295) % {BUCKETS} as bucket
      from (select distinct word from (select word from d union all select word from b)), bits),
s as (select bucket, count(*) as s from d join w using (word) group by bucket),
t as (select bucket, count(*) as t from b join w using (word) group by bucket),
n as (select (select count(*) from d)::double as source, (select count(*) from b)::double as target),
g as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (source + {BUCKETS})
             / ((s + 1) * (target + {BUCKETS}))))::bigint as gain
      from s left join t using (bucket), n),
x as (select doc_id, count(*) as n_features, floor(sum(gain)::double / count(*))::bigint as weight
      from d join w using (word) join g using (bucket) group by doc_id),
y as (select o.doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
        ('0x' || substr(sha256('{SEED}:' || o.doc_id), 1, 8))::bigint as h
      from documents o left join x using (doc_id)),
z as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from y),
r as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as total
      from z where n_features >= {LEAST_WORDS})
select z.doc_id, n_features, weight, score, case when place <= (total * {PERCENT}) // 100 then place end as rank
from z left join r using (doc_id)
"""
