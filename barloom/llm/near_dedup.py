"""Near-duplicates by ProbMinHash signatures, banding, and exact verification.

A document is a set of shingles of five words, weighted by 1 + ln(times it occurs). Each shingle is
a Poisson process whose rate is its weight; each arrival falls on a random slot of the signature,
and a slot keeps the shingle that came first. Two documents agree on a slot with the probability
Jaccard similarity of their weighted shingles. A shingle is done as soon as its next arrival comes
after the latest first arrival of its document, so few shingles need more than one.

Rows with the same weighted shingles are one *text*. Texts that share a band are candidates, and a
pair is linked if its exact probability Jaccard or its plain Jaccard is at least the threshold. A text
that repeats a shingle has a second signature, of weights 1, with bands and bits of its own: slots of two
texts under weights 1 agree with their plain Jaccard. For all others the two signatures are the same.
Buckets are not expanded into pairs: in each of some turns, texts are tested against one text of their
bucket, which joins large groups. Within a class nothing is left to decide. Texts of small buckets
that are in two classes are paired if enough bits of their slots are equal. Those of each large bucket are
compared exactly inside tasks, two blocks of bounded size at a time, which give out links only. Shingles
are not stored: those of candidates are made again from their texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from barloom.llm.arrow_text import Words, give_back, giving_back, mixed_bits, settle_texts, with_columns_in_arrow
from barloom.llm.components import components
from barloom.session import broadcast_if_small, settle, ship_package

WIDTH = 5
THRESHOLD = 0.8
BANDS = 24
ROWS = 5
#: One bit of each slot is kept. Bits of unequal slots differ half the time, so a pair at the threshold
#: differs in a tenth of its bits; this many standard deviations more are still verified.
DEVIATIONS = 5.0
#: Turns in which the texts of a bucket are tested against one of them, before those left are paired.
ROUNDS_OF_STARS = 2
#: Texts of a bucket that are paired by a join; those of a larger one are compared block by block.
CROWD = 32
#: What a block of a larger bucket holds on average: so many shingles, and so many texts.
BLOCK_SHINGLES = 1 << 17
BLOCK_TEXTS = 2000
#: Bytes of text that are sketched at once; a shingle takes some hundred bytes meanwhile.
SKETCH_BYTES = 1 << 20
#: Texts of the left block and shingles that one step of products takes.
TILE_TEXTS = 512
TILE_SHINGLES = 1024
BITS = ("bits_high", "bits_low", "plain_high", "plain_low")
_LOW48 = np.uint64((1 << 48) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(owner, shingle, times)`` of the distinct shingles, by owner and shingle.

    Shingles are 48-bit hashes. A text of fewer than ``width`` words is one shingle.
    """
    hashed = words.hashes()[words.ids] if len(words.ids) else np.zeros(0, np.uint64)
    owners = words.owners()
    if len(hashed) >= width:
        rolled = np.zeros(len(hashed) - width + 1, np.uint64)
        for k in range(width):
            rolled = mixed_bits(rolled * _ODD + hashed[k:len(hashed) - width + 1 + k])
        whole = owners[:len(rolled)] == owners[width - 1:]
        rolled, of = rolled[whole], owners[:len(whole)][whole]
    else:
        rolled, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((words.sizes > 0) & (words.sizes < width))
    alone = []
    for i in short:
        value = np.zeros(1, np.uint64)
        for h in hashed[words.starts[i]:words.starts[i + 1]]:
            value = mixed_bits(value * _ODD + h)
        alone.append(value[0] ^ np.uint64(words.sizes[i]))
    rolled = np.concatenate([rolled, np.array(alone, np.uint64)])
    of = np.concatenate([of, short]).astype(np.uint64)
    keyed = np.sort((of << np.uint64(48)) | (rolled & _LOW48))
    first = np.flatnonzero(np.concatenate([[True], keyed[1:] != keyed[:-1]])) if len(keyed) else \
        np.zeros(0, np.int64)
    times = np.diff(np.concatenate([first, [len(keyed)]]))
    return (keyed[first] >> np.uint64(48)).astype(np.int64), keyed[first] & _LOW48, times


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int,
               slots: int) -> np.ndarray:
    """ProbMinHash signatures, one row per text; a text without shingles has zeros."""
    first = np.full(texts * slots, np.inf)
    found = np.zeros(texts * slots, np.uint64)
    latest = np.full(texts, np.inf)
    time = np.zeros(len(owner))
    arrival = 0
    while len(owner):
        arrival += 1
        bits = mixed_bits(shingle * _ODD + np.uint64(arrival))
        uniform = ((bits >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)
        time = time - np.log(uniform) / weight
        early = time < latest[owner]
        owner, shingle, weight, time, bits = (x[early] for x in (owner, shingle, weight, time, bits))
        slot = owner * slots + (mixed_bits(bits + _ODD) % np.uint64(slots)).astype(np.int64)
        np.minimum.at(first, slot, time)
        wins = time == first[slot]
        found[slot[wins]] = shingle[wins]
        if not len(owner):
            break
        touched = owner[np.concatenate([[True], owner[1:] != owner[:-1]])]
        latest[touched] = first.reshape(texts, slots)[touched].max(axis=1)
    return found.reshape(texts, slots)


def pack48(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, :6] = raw
    return full.reshape(-1).view("<u8")


def weights_of(times: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(times)


def _weighted(packed: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    values = unpack48(packed)
    return values, weights_of(np.frombuffer(times, "<i4")) if times else np.ones(len(values))


def similarities(a: np.ndarray, a_weight: np.ndarray, b: np.ndarray,
                 b_weight: np.ndarray) -> tuple[float, float]:
    """Exact probability Jaccard and plain Jaccard of two sorted weighted sets."""
    if not len(a) or not len(b):
        return 0.0, 0.0
    if len(a) == a_weight.sum() and len(b) == b_weight.sum():       # no shingle occurs twice
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        shared = int((b[at] == a).sum())
        return (shared / (len(a) + len(b) - shared),) * 2
    union = np.sort(np.concatenate([a, b]))
    union = union[np.concatenate([[True], union[1:] != union[:-1]])]
    wa, wb = np.zeros(len(union)), np.zeros(len(union))
    wa[np.searchsorted(union, a)] = a_weight
    wb[np.searchsorted(union, b)] = b_weight
    with np.errstate(divide="ignore"):
        order = np.argsort(wa / wb, kind="stable")
    wa, wb = wa[order], wb[order]
    from_here = np.cumsum(wa[::-1])[::-1]
    before = np.concatenate([[0.0], np.cumsum(wb)[:-1]])
    both = (wa > 0) & (wb > 0)
    chance = float((1.0 / (from_here[both] / wa[both] + before[both] / wb[both])).sum())
    return chance, float(both.sum()) / len(union)


SKETCH = T.StructType([T.StructField(c, T.LongType()) for c in (
    "shingle_count", "key_high", "key_low", "bits_high", "bits_low", "plain_high", "plain_low")]
    + [T.StructField("bands", T.ArrayType(T.LongType()))])
SHINGLED = T.StructType([
    T.StructField("key_high", T.LongType()), T.StructField("key_low", T.LongType()),
    T.StructField("shingles", T.BinaryType()), T.StructField("times", T.BinaryType())])


def _keys(shingle: np.ndarray, times: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two sums that do not depend on order name the weighted set of each text."""
    element = mixed_bits(shingle * _ODD + times.astype(np.uint64))
    sums = []
    for salt in (1, 2):
        total = np.concatenate([np.zeros(1, np.uint64),
                                np.cumsum(mixed_bits(element + np.uint64(salt)))])
        sums.append(mixed_bits(total[ends[1:]] - total[ends[:-1]]).view(np.int64))
    return sums


def _banded(signed: np.ndarray, bands: int, rows: int) -> np.ndarray:
    banded = np.zeros((len(signed), bands), np.uint64)
    for k in range(rows):
        banded = mixed_bits(banded * _ODD + signed[:, k::rows])
    return mixed_bits(banded + np.arange(bands, dtype=np.uint64)[None, :])


def _bits(signed: np.ndarray) -> list[np.ndarray]:
    """One bit of each slot, in two numbers per text."""
    bits = mixed_bits(signed) & np.uint64(1)
    half = bits.shape[1] // 2
    return [(part << np.arange(part.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)
            for part in (bits[:, :half], bits[:, half:])]


def sketch(texts: pa.Array, width: int, bands: int, rows: int) -> list[pa.Array]:
    """The columns of ``SKETCH`` for some texts; nulls and no bands where there is no shingle.

    The plain bits are null, and bands are not doubled, where no shingle is repeated."""
    words = Words(texts)
    n = len(words.sizes)
    owner, shingle, times = shingles(words, width)
    signed = signatures(owner, shingle, weights_of(times), n, bands * rows)
    counts = np.bincount(owner, minlength=n)
    ends = np.concatenate([[0], np.cumsum(counts)])
    twice = np.bincount(owner[times > 1], minlength=n) > 0
    again = twice[owner]
    alike = signed.copy()
    alike[twice] = signatures((np.cumsum(twice) - 1)[owner[again]], shingle[again], np.ones(again.sum()),
                              int(twice.sum()), bands * rows)
    none = counts == 0
    banded, plain = _banded(signed, bands, rows), _banded(alike, bands, rows)
    asked = np.concatenate([np.broadcast_to(~none[:, None], banded.shape), banded != plain], axis=1)
    flat = pa.array(np.concatenate([banded, plain], axis=1)[asked].view(np.int64))
    offsets = np.concatenate([[0], np.cumsum(asked.sum(axis=1))]).astype(np.int32)
    return [pa.array(counts, pa.int64()), *(pa.array(x, mask=none) for x in _keys(shingle, times, ends)),
            *(pa.array(x) for x in _bits(signed)), *(pa.array(x, mask=~twice) for x in _bits(alike)),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)]


def packed_shingles(texts: pa.Array, width: int) -> list[pa.Array]:
    """The columns of ``SHINGLED``: sorted shingles, and how often each occurs if any does twice."""
    words = Words(texts)
    owner, shingle, times = shingles(words, width)
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words.sizes)))])
    packed, repeats = [], []
    for a, b in zip(ends[:-1], ends[1:]):
        packed.append(pack48(shingle[a:b]))
        repeats.append(times[a:b].astype("<i4").tobytes() if (times[a:b] > 1).any() else b"")
    return [*(pa.array(x) for x in _keys(shingle, times, ends)),
            pa.array(packed, pa.binary()), pa.array(repeats, pa.binary())]


def _made_again(texts: DataFrame, sketches: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``(text, shingles, times)`` of the given texts, from the documents."""
    wanted = settle(sketches.join(broadcast_if_small(texts), "text")
                    .select("text", "doc_id", "key_high", "key_low"), "wanted")
    ids = broadcast_if_small(wanted.select(F.col("doc_id").alias("id")).distinct())
    again = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("id"))).select("doc_id", "body")
    shingled = with_columns_in_arrow(again, "body", SHINGLED,
                                     lambda texts: packed_shingles(texts, width), [], SKETCH_BYTES)
    return settle_texts(shingled.join(wanted, ["key_high", "key_low"]).dropDuplicates(["text"])
                  .select("text", "shingles", "times"), "held")


def _verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, width: int,
              threshold: float) -> DataFrame:
    """Those of the pairs ``(a, b)`` that are similar enough, with their similarities."""
    ship_package(pairs.sparkSession)
    pairs = settle(pairs, "pairs")
    asked = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "text")
    held = _made_again(asked, sketches, docs, width)
    left = held.select(F.col("text").alias("a"), F.col("shingles").alias("sa"),
                       F.col("times").alias("ta"))
    right = held.select(F.col("text").alias("b"), F.col("shingles").alias("sb"),
                        F.col("times").alias("tb"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("sa", "ta", "sb", "tb")]
            found = []
            for row in range(batch.num_rows):
                sa, ta, sb, tb = (c[row].as_py() for c in columns)
                found.append(similarities(*_weighted(sa, ta), *_weighted(sb, tb)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"),
                 pa.array([x for x, _ in found], pa.float64()),
                 pa.array([y for _, y in found], pa.float64())],
                ["a", "b", "probability_jaccard", "jaccard"])

    # so many rows to a batch that two texts of a million shingles each fit
    checked = pairs.join(right, "b").join(left, "a").mapInArrow(
        giving_back(verify), "a long, b long, probability_jaccard double, jaccard double")
    return settle_texts(checked.where(F.greatest("probability_jaccard", "jaccard") >= threshold), "links")


def _classes(numbered: DataFrame, docs: DataFrame, width: int, threshold: float, slots: int) -> DataFrame:
    """``(row, class)`` of sketched rows with shingles; the class is its smallest row."""
    keyed = numbered.where("shingle_count > 0")
    texts = keyed.groupBy("key_high", "key_low").agg(F.min("row").alias("text"))
    rows = settle(keyed.select("row", "key_high", "key_low").join(texts, ["key_high", "key_low"])
                  .select("row", "text"), "texts")
    one_each = rows.where("row = text").select("text")
    sketches = numbered.withColumnRenamed("row", "text")
    banded = settle(sketches.join(one_each, "text", "left_semi")
                    .select("text", F.explode("bands").alias("bucket")), "banded")

    buckets = banded.groupBy("bucket").agg(F.min("text").alias("b"), F.max("text").alias("last"))
    shared = buckets.where("b <> last").select("bucket")
    crowded = settle(banded.join(shared, "bucket"), "crowded")
    bits = sketches.select("text", *BITS)
    crowded = settle(crowded.join(bits, "text"), "crowded")
    joined = None           # texts and their components by all links so far
    for turn in range(ROUNDS_OF_STARS):
        undecided = settle(_undecided(_placed(crowded, joined)), "undecided")
        found = _verified(_stars(undecided, turn, threshold, slots), sketches, docs, width, threshold)
        joined = _joined(joined, found.select("a", "b"))
        crowded = undecided.drop("component")     # what is decided stays so
    undecided = settle(_undecided(_placed(crowded, joined)), "undecided")
    more = _verified(_pairs(undecided, threshold, slots), sketches, docs, width, threshold)
    crowds = settle(_crowds(undecided), "crowded_buckets")
    held = _made_again(crowds.select("text").distinct(), sketches, docs, width)
    most = _block_links(crowds, held, threshold)
    classes = _joined(joined, more.select("a", "b").union(most))
    return rows.join(classes.withColumnRenamed("node", "text"), "text", "left").select(
        "row", F.coalesce("component", "text").alias("class"))


def _joined(joined: DataFrame | None, found: DataFrame) -> DataFrame:
    """``(node, component)`` by the links of ``joined``, an earlier result, and those ``found`` since."""
    if joined is None:
        return components(found)
    if found.isEmpty():
        return joined
    return components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(found))


def _placed(crowded: DataFrame, joined: DataFrame | None) -> DataFrame:
    """``crowded`` with the component of each text; one that no link joins is its own."""
    if joined is None:
        return crowded.withColumn("component", F.col("text"))
    return crowded.join(joined.withColumnRenamed("node", "text"), "text", "left").withColumn(
        "component", F.coalesce("component", "text"))


def _undecided(placed: DataFrame) -> DataFrame:
    """Rows of buckets that hold texts of two components or more."""
    open_buckets = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return placed.join(open_buckets.select("bucket"), "bucket")


def _bits_named(suffix: str) -> list[Column]:
    return [F.col(c).alias(c + suffix) for c in BITS]


def _alike(threshold: float, slots: int) -> Column:
    """Whether few enough bits of ``x`` and ``y`` differ, of either signature."""
    share = (1 - threshold) / 2
    most = math.ceil(slots * share + DEVIATIONS * math.sqrt(slots * share * (1 - share)))

    def of(side: str, half: str) -> Column:     # one that repeats nothing has one signature
        return F.coalesce(f"plain_{half}_{side}", f"bits_{half}_{side}")

    weighted = sum(F.bit_count(F.col(f"bits_{half}_x").bitwiseXOR(F.col(f"bits_{half}_y")))
                   for half in ("high", "low"))
    plain = sum(F.bit_count(of("x", half).bitwiseXOR(of("y", half))) for half in ("high", "low"))
    return F.least(weighted, plain) <= most


def _stars(undecided: DataFrame, turn: int, threshold: float, slots: int) -> DataFrame:
    """Each text with one text of its bucket, another one each turn, if they are not yet joined."""
    order = F.struct(F.xxhash64("text", F.lit(turn)).alias("order"), F.col("text").alias("y"),
                     F.col("component").alias("cy"), *_bits_named("_y"))
    centres = undecided.groupBy("bucket").agg(F.min(order).alias("c")).select("bucket", "c.*")
    return (undecided.select("bucket", "text", "component", *_bits_named("_x")).join(centres, "bucket")
            .where((F.col("component") != F.col("cy")) & _alike(threshold, slots))
            .select(F.greatest("text", "y").alias("a"), F.least("text", "y").alias("b")).distinct())


def _pairs(undecided: DataFrame, threshold: float, slots: int) -> DataFrame:
    """Distinct pairs of texts of two components in buckets of ``CROWD`` texts at most, so that a text has a
    bounded number of partners per band. The join tests the bits itself."""
    few = undecided.groupBy("bucket").count().where(F.col("count") <= CROWD).select("bucket")
    held = settle(undecided.join(few, "bucket"), "few")
    one = held.select("bucket", F.col("text").alias("x"), F.col("component").alias("cx"), *_bits_named("_x"))
    other = held.select(F.col("bucket").alias("same"), F.col("text").alias("y"),
                        F.col("component").alias("cy"), *_bits_named("_y"))
    alike = (F.col("bucket") == F.col("same")) & (F.col("cx") < F.col("cy")) & _alike(threshold, slots)
    return one.join(other, alike).select(
        F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _crowds(undecided: DataFrame) -> DataFrame:
    """``(crowd, text, component)``: the texts of each larger bucket. Buckets of the same texts, told by two
    64-bit sums, are one crowd; others are not joined, whatever texts they share."""
    many = undecided.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("text")).alias("one"),
        F.bit_xor(F.xxhash64("text", F.lit(1))).alias("two")).where(F.col("n") > CROWD)
    crowds = many.groupBy("n", "one", "two").agg(F.min("bucket").alias("bucket")).select("bucket")
    return undecided.join(crowds, "bucket").select(F.col("bucket").alias("crowd"), "text", "component")


def _dealt(crowds: DataFrame, held: DataFrame) -> DataFrame:
    """``(crowd, i, j, own, text, component)``: each text of a crowd in its block ``own``, once for each pair
    of blocks ``i <= j`` that has it. Blocks are bounded by shingles and by texts."""
    lengths = held.select("text", (F.octet_length("shingles") / 6).alias("size"))
    rows = settle(crowds.join(lengths, "text"), "crowds")
    sizes = rows.groupBy("crowd").agg(F.greatest(
        F.ceil(F.sum("size") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS)).alias("blocks"))
    dealt = rows.join(sizes, "crowd").withColumn("own", F.pmod(F.xxhash64("text"), F.col("blocks")))
    return dealt.select(
        "crowd", "own", "text", "component",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")).select(
        "crowd", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
        "text", "component")


def _block_links(crowds: DataFrame, held: DataFrame, threshold: float) -> DataFrame:
    """Links ``(a, b)`` between texts of two components of a crowd.

    Each task takes two blocks, counts what their texts share by products of 0-1 matrices, and gives out
    links only, never pairs.
    """
    spread = _dealt(crowds, held).join(held, "text")
    def of_blocks(key, texts):
        try:
            return _links_of_blocks(texts, int(key[1]), int(key[2]), threshold)
        finally:
            give_back()

    return settle(spread.groupBy("crowd", "i", "j").applyInPandas(of_blocks, "a long, b long").distinct(),
                  "block_links")


def _dense(row: np.ndarray, column: np.ndarray, share: np.ndarray, rows: int) -> np.ndarray:
    """Two matrices of ``rows`` texts: which shingles they have, and with what share of their weight."""
    made = np.zeros((2, rows, TILE_SHINGLES), np.float32)
    own = row >= 0
    made[0, row[own], column[own]] = 1
    made[1, row[own], column[own]] = share[own]
    return made


def _links_of_blocks(texts: pd.DataFrame, i: int, j: int, threshold: float) -> pd.DataFrame:
    sets = [_weighted(*x) for x in zip(texts["shingles"], texts["times"])]
    left, right = (np.flatnonzero(texts["own"].to_numpy() == k) for k in (i, j))
    sizes = np.array([len(v) for v, _ in sets])
    owner, values = np.repeat(np.arange(len(sets)), sizes), np.concatenate([v for v, _ in sets])
    share = np.concatenate([w / w.sum() for _, w in sets])
    order = np.argsort(values, kind="stable")
    owner, values, share = owner[order], values[order], share[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(new) - 1
    twice = np.bincount(column)[column] > 1         # what one text alone has is shared with none
    owner, share = owner[twice], share[twice]
    column = np.cumsum(np.concatenate([[0], np.diff(column[twice]) > 0])) if twice.any() else column[:0]
    component, text = texts["component"].to_numpy(), texts["text"].to_numpy()
    plain = np.array([not t for t in texts["times"]])
    at_right = np.full(len(sets), -1)
    at_right[right] = np.arange(len(right))
    found = []
    for top in range(0, len(left), TILE_TEXTS):
        rows = left[top:top + TILE_TEXTS]
        at_left = np.full(len(sets), -1)
        at_left[rows] = np.arange(len(rows))
        both = np.zeros((len(rows), len(right)), np.float32)
        mass_left, mass_right = both.copy(), both.copy()
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, TILE_SHINGLES):
            a, b = np.searchsorted(column, (start, start + TILE_SHINGLES))
            of, at, part = owner[a:b], column[a:b] - start, share[a:b]
            if not (at_left[of] >= 0).any():
                continue
            x, x_mass = _dense(at_left[of], at, part, len(rows))
            y, y_mass = _dense(at_right[of], at, part, len(right))
            both += x @ y.T
            if not plain.all():
                mass_left += x_mass @ y.T
                mass_right += x @ y_mass.T
        jaccard = both / np.maximum(sizes[rows][:, None] + sizes[right][None, :] - both, 1)
        # the probability Jaccard is at most the share of either weight that lies in both
        maybe = (np.minimum(mass_left, mass_right) >= threshold - 1e-4) & (jaccard < threshold)
        maybe &= ~(plain[rows][:, None] & plain[right][None, :])
        other = component[rows][:, None] != component[right][None, :]
        found += [(rows[x], right[y]) for x, y in np.argwhere((jaccard >= threshold - 1e-6) & other)]
        found += [(rows[x], right[y]) for x, y in np.argwhere(maybe & other)
                  if similarities(*sets[rows[x]], *sets[right[y]])[0] >= threshold]
    a = np.array([text[x] for x, _ in found], np.int64)
    b = np.array([text[y] for _, y in found], np.int64)
    return pd.DataFrame({"a": a, "b": b})


def _grouped(numbered: DataFrame, width: int, threshold: float, bands: int, rows: int) -> DataFrame:
    """The class of each of the ``numbered`` rows (``row, doc_id, text``). Their sketches are settled, so row
    numbers stay as they are there."""
    sketched = settle_texts(with_columns_in_arrow(
        numbered, "text", SKETCH, lambda texts: sketch(texts, width, bands, rows), ["row", "doc_id"],
        SKETCH_BYTES), "sketched")
    bodies = numbered.select("doc_id", F.col("text").alias("body"))
    classes = _classes(sketched, bodies, width, threshold, bands * rows)
    ids = sketched.select("row", "doc_id", "shingle_count").join(classes, "row", "left").withColumn(
        "class", F.coalesce("class", "row"))
    ids = settle(ids, "classes")
    # the smallest id first (null ids last), of equal ids the first row
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    groups = ids.groupBy("class").agg(first, F.count(F.lit(1)).alias("class_size"))
    return ids.join(groups, "class").select(
        "row", "doc_id", "shingle_count", F.col("first.doc_id").alias("class_id"), "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = WIDTH, threshold: float = THRESHOLD, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, class_size, kept, shingle_count``.

    A class holds all rows that links join; ``class_id`` is its smallest id, and that row is kept
    (null ids come last; of repeated ids, one row). Words are split at white space, A-Z lower-cased.
    Texts without words, null ones too, have no shingles and are classes of their own. Other columns
    are not read. An empty table gives no rows.
    """
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"))
    return _grouped(numbered, width, threshold, bands, rows).select(
        "doc_id", "class_id", "class_size", "kept", "shingle_count")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            width: int = WIDTH, threshold: float = THRESHOLD, bands: int = BANDS,
                            rows: int = ROWS) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Only ids and texts go through Python."""
    every = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("carried")
    numbered = settle(docs.select(every, F.monotonically_increasing_id().alias("row")), "numbered")
    carried = F.col("carried")
    judged = _grouped(numbered.select("row", carried.getField(id_col).cast("long").alias("doc_id"),
                                      carried.getField(text_col).alias("text")), width, threshold, bands, rows)
    dropped = broadcast_if_small(judged.where("not kept").select("row"))
    return numbered.select("row", "carried").join(dropped, "row", "left_anti").select("carried.*")
