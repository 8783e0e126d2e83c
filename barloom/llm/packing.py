"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

A solution is a set of bins. Crossover takes whole well-filled bins from one parent, removes their pieces from
the other (whose bins that held one are opened), and puts what was displaced anew: where it fits best, or
as fillings, new bins each of which is filled as exactly as up to three further pieces can.
Pieces are dealt into shards of bounded size by a hash. Each shard is evolved by several islands at once, one
Spark group each; between epochs every island hands its best solution to the next one of its shard.
Bins that are not well filled at the end of a round are opened, and the pieces of all shards are
dealt anew for the next round, so that shards leave few gaps.
"""

from __future__ import annotations

import base64
import json
import os
import random
import re
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barloom.llm.arrow_text import give_back, giving_back, settle_texts, slices
from barloom.session import settle, ship_package

CAPACITY = 1024
END_ID = 2
SHARD_PIECES = 4096
ISLANDS = 2
EPOCHS = 2
ROUNDS = 3
POPULATION = 4
GENERATIONS = 6
PATIENCE = 2
#: Chance that a well-filled bin is opened, and first sizes that are tried for a filling of three items.
MUTATED = 0.1
TRIES = 8
#: What a filling leaves of a gap at most, before the largest item that fits is taken instead.
SLACK = 24
#: A bin is well filled from this share of the capacity on.
WELL_FILLED = 0.995
#: The branch of the cutting pattern that looks ahead, where it matters, and runs that are too long for it.
LOOK_AHEAD = r"|\s+(?!\S)"
SPACES = re.compile(r"\s\s")
LONGEST_SPACE = 10_000
LONG_SPACE = re.compile(r"\s{%d}" % LONGEST_SPACE)


class Encoder:
    """Token ids of a public byte-level vocabulary.

    ``path`` is the tokenizer's own file, ``ranks`` the same vocabulary for a faster library, which gives the
    same ids (a test compares them). ``pattern`` cuts a text before pairs are merged; the branch that looks ahead
    only matters where white space follows white space, and without it texts are cut twice as fast. Texts that
    hold a special token, or white space beyond ``LONGEST_SPACE``, are encoded from ``path``, which is
    loaded when it is first needed.
    """

    def __init__(self, path: str, ranks: str, pattern: str) -> None:
        import tiktoken

        self.path = path
        with open(ranks, "rb") as lines:
            vocabulary = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.whole, self.plain = (
            tiktoken.Encoding(f"{os.path.basename(ranks)} {cut}", pat_str=cut, mergeable_ranks=vocabulary,
                              special_tokens={}).encode_ordinary
            for cut in (pattern, pattern.replace(LOOK_AHEAD, "")))
        with open(path, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file)["added_tokens"]]

    @cached_property
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> list[int]:
        if any(t in text for t in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if not SPACES.search(text):
            return self.plain(text)
        if LONG_SPACE.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.whole(text)


@lru_cache(maxsize=2)
def encoder(path: str, ranks: str, pattern: str) -> Encoder:
    return Encoder(path, ranks, pattern)


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: all full but the first, which may be shorter."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized_pieces(docs: DataFrame, tokenizer: tuple[str, str, str], id_col: str = "doc_id",
                     text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each row's tokens and end token: ``PIECES``. ``row`` numbers the rows."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(*tokenizer).ids
        for batch in batches:
            for part in slices(batch, "text"):
                made = []
                columns = (part.column(c).to_pylist() for c in ("row", "doc_id", "text"))
                for row, doc_id, text in zip(*columns):
                    ids = np.array(ids_of(text or "") + [END_ID], "<u4")
                    for k, (start, length) in enumerate(cut(len(ids), capacity)):
                        made.append((row, doc_id, k, start, length,
                                     zlib.crc32(ids[start:start + length].tobytes())))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*made), kinds)],
                    [f.split()[0] for f in PIECES.split(", ")])

    return rows.mapInArrow(giving_back(run), PIECES)


Bins = list[list[int]]


def best_fit(order: list[int], sizes: list[int], bins: Bins, capacity: int = CAPACITY) -> Bins:
    """``bins`` with each item of ``order`` put where the least room is left, or into a new bin."""
    room: dict[int, list[int]] = {}
    rooms = 0                  # bit c: some bin has c left
    for b, items in enumerate(bins):
        left = capacity - sum(sizes[i] for i in items)
        room.setdefault(left, []).append(b)
        rooms |= 1 << left
    for i in order:
        size = sizes[i]
        fitting = rooms >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                rooms ^= 1 << left
            bins[b].append(i)
        else:
            left, b = capacity, len(bins)
            bins.append([i])
        left -= size
        room.setdefault(left, []).append(b)
        rooms |= 1 << left
    return bins


def fitness(bins: Bins, sizes: list[int], capacity: int = CAPACITY) -> tuple[int, float]:
    """Fewer bins are better; of as many, those that are full or empty rather than half full."""
    size_of = sizes.__getitem__
    return -len(bins), sum((sum(map(size_of, b)) / capacity) ** 2 for b in bins)


class Loose:
    """Items that are in no bin, by size: which sizes there are is one number, a bit for each, so that a pair
    of sizes with a given sum is found by one shift."""

    def __init__(self, items: list[int], sizes: list[int], capacity: int = CAPACITY) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.held: dict[int, list[int]] = {}
        self.there = self.mirrored = 0           # bit s, and bit capacity - s: some item has size s
        for i in items:
            self.put(i)

    def put(self, item: int) -> None:
        size = self.sizes[item]
        self.held.setdefault(size, []).append(item)
        self.there |= 1 << size
        self.mirrored |= 1 << (self.capacity - size)

    def take(self, size: int) -> int:
        own = self.held[size]
        item = own.pop()
        if not own:
            del self.held[size]
            self.there ^= 1 << size
            self.mirrored ^= 1 << (self.capacity - size)
        return item

    def largest(self, most: int) -> int:
        """The largest size up to ``most``, 0 if there is none."""
        return max((self.there & ((1 << (most + 1)) - 1)).bit_length() - 1, 0) if most > 0 else 0

    def pair(self, total: int) -> tuple[int, ...]:
        """Two sizes that add up to ``total``, the larger one as large as can be."""
        both = self.there & (self.mirrored >> (self.capacity - total))
        while both:
            one = both.bit_length() - 1
            if 2 * one != total or len(self.held[one]) > 1:
                return one, total - one
            both ^= 1 << one
        return ()

    def filling(self, gap: int, tries: int) -> tuple[int, ...]:
        """Sizes of up to three items that fill ``gap`` but for less than ``SLACK``, as well as can be and with few
        large items; else the largest that fits."""
        for total in range(gap, max(gap - SLACK, 0), -1):
            if self.there >> total & 1:
                return (total,)
            if found := self.pair(total):
                return found
            first, left = self.largest(total - 2), tries
            while first > 0 and left and 3 * first >= total:
                item = self.take(first)
                rest = self.pair(total - first)
                self.put(item)
                if rest:
                    return first, *rest
                first, left = self.largest(first - 1), left - 1
        alone = self.largest(gap)
        return (alone,) if alone else ()


def refill(items: list[int], sizes: list[int], bins: Bins, capacity: int = CAPACITY,
           tries: int = TRIES) -> Bins:
    """``bins`` and new ones: each begins with the largest item that is left and is filled as well as
    up to three others can. What fills no bin well is put where it fits best."""
    loose = Loose(items, sizes, capacity)
    poor: list[int] = []
    while loose.there:
        made = [loose.take(loose.largest(capacity))]
        gap = capacity - sizes[made[0]]
        while gap and (chosen := loose.filling(gap, tries)):
            made += [loose.take(size) for size in chosen]
            gap -= sum(chosen)
        if gap <= (1 - WELL_FILLED) * capacity:
            bins.append(made)
        else:
            poor += made
    poor.sort(key=lambda i: (-sizes[i], i))
    return best_fit(poor, sizes, bins, capacity)


def crossover(giver: Bins, taker: Bins, sizes: list[int], rng: random.Random,
              capacity: int = CAPACITY) -> Bins:
    """Whole well-filled bins of ``giver`` in ``taker``; what was displaced is put anew, by best fit or by
    fillings. Poor bins are opened, and a few others by chance, which is the mutation."""
    least, size_of = WELL_FILLED * capacity, sizes.__getitem__
    injected = [b for b in giver if rng.random() < 0.5 and sum(map(size_of, b)) >= least]
    inside = {i for b in injected for i in b}
    child, displaced = [list(b) for b in injected], []
    for b in taker:
        poor = sum(map(size_of, b)) < least
        if inside.isdisjoint(b) and rng.random() >= (0.8 if poor else MUTATED):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in inside]
    displaced.sort(key=lambda i: (-sizes[i], i))
    put = best_fit if rng.random() < 0.3 else refill
    return put(displaced, sizes, child, capacity)


def evolve(sizes: list[int], known: list[Bins], seed: int, generations: int = GENERATIONS,
           population: int = POPULATION, capacity: int = CAPACITY) -> Bins:
    """The best solution after some generations, beginning with ``known`` ones and fresh ones: by best fit
    from the largest item on, by fillings, and by best fit in a shaken order. Ends when nothing can be better, or
    ``PATIENCE`` generations have brought no fewer bins."""
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    people: list[tuple[tuple[int, float], Bins]] = []       # the fittest first

    def join(bins: Bins) -> bool:
        people.append((fitness(bins, sizes, capacity), bins))
        people.sort(key=lambda p: p[0], reverse=True)
        del people[population:]
        return len(people[0][1]) <= least

    falling = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    for bins in known:
        if join(bins):
            return people[0][1]
    for fresh in range(population - len(known)):
        if fresh > 1:
            order = sorted(falling, key=lambda i: -sizes[i] + rng.random() * 0.1 * capacity)
        if join(refill(falling, sizes, [], capacity) if fresh == 1 else
                best_fit(falling if fresh == 0 else order, sizes, [], capacity)):
            return people[0][1]
    since = 0
    for _ in range(generations):
        fewest = len(people[0][1])
        for _ in range(population):
            giver, taker = rng.sample(people, 2) if len(people) > 1 else (people[0], people[0])
            if join(crossover(giver[1], taker[1], sizes, rng, capacity)):
                return people[0][1]
        since = since + 1 if len(people[0][1]) == fewest else 0
        if since == PATIENCE:
            break
    return people[0][1]


def _bins(solution: list[int]) -> Bins:
    bins: Bins = [[] for _ in range(max(solution, default=-1) + 1)]
    for i, b in enumerate(solution):
        bins[b].append(i)
    return bins


def _solution(bins: Bins, n: int) -> list[int]:
    solution = [0] * n
    for b, items in enumerate(bins):
        for i in items:
            solution[i] = b
    return solution


def _in_order(pieces: pd.DataFrame) -> pd.DataFrame:
    """Every island sees a shard's pieces in one order, so that solutions can be handed on."""
    return pieces.sort_values(["length", "row", "piece"], ascending=[False, True, True],
                              kind="stable", ignore_index=True)


ELITE = "shard long, island int, bins int, quality double, solution array<int>"


def _epoch(spread: DataFrame, elites: DataFrame | None, epoch: int, capacity: int) -> DataFrame:
    """The best solution of each island of each shard, after one more epoch."""
    def one(shard: int, island: int, pieces: pd.DataFrame, known: list[Bins]) -> pd.DataFrame:
        sizes = _in_order(pieces)["length"].tolist()
        seed = (shard * ISLANDS + island) * EPOCHS + epoch
        best = evolve(sizes, known, seed, capacity=capacity)
        bins, quality = fitness(best, sizes, capacity)
        return pd.DataFrame({"shard": [shard], "island": [island], "bins": [-bins],
                             "quality": [quality], "solution": [_solution(best, len(sizes))]})

    if elites is None:
        return settle(spread.groupBy("shard", "island").applyInPandas(
            lambda key, pieces: one(int(key[0]), int(key[1]), pieces, []), ELITE), "elites")
    handed = elites.union(elites.withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int")))

    def more(key, pieces: pd.DataFrame, arrived: pd.DataFrame) -> pd.DataFrame:
        known = [_bins(list(s)) for s in arrived.sort_values(["bins", "quality"])["solution"]]
        return one(int(key[0]), int(key[1]), pieces, known)

    return settle(spread.groupBy("shard", "island").cogroup(handed.groupBy("shard", "island"))
                  .applyInPandas(more, ELITE), "elites")


PLACED = PIECES + ", shard long, bin int, offset long, filled long"


def _round(pieces: DataFrame, count: int, number: int, capacity: int) -> DataFrame:
    """``pieces`` in bins of their shards, with each bin's filling."""
    shards = max(1, -(-count // SHARD_PIECES))
    key = F.pmod(F.xxhash64("row", "piece", F.lit(number)), F.lit(shards)).alias("shard")
    dealt = settle(pieces.select("*", key), "dealt")
    spread = dealt.select("shard", "row", "piece", "length",
                          F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
    elites = None
    for epoch in range(EPOCHS):
        elites = _epoch(spread, elites, epoch, capacity)
    best = elites.groupBy("shard").agg(
        F.max_by("solution", F.struct(-F.col("bins"), "quality", -F.col("island"))).alias("solution"))

    def place(key, group: pd.DataFrame, solutions: pd.DataFrame) -> pd.DataFrame:
        group = _in_order(group)
        group["bin"] = np.array(solutions["solution"].iloc[0], np.int32)
        inside = group.groupby("bin")["length"]
        group["offset"] = inside.cumsum() - group["length"]
        group["filled"] = inside.transform("sum")
        return group[[f.split()[0] for f in PLACED.split(", ")]]

    return settle(dealt.groupBy("shard").cogroup(best.groupBy("shard")).applyInPandas(place, PLACED),
                  "placed")


def packed(docs: DataFrame, tokenizer: tuple[str, str, str], id_col: str = "doc_id",
           text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``tokenizer`` names the files and the pattern that ``Encoder`` takes. Each row of ``docs`` is packed, also those that repeat an id. A null or empty text is its end
    token alone. Only documents longer than ``capacity`` are cut. An empty table gives no rows.
    """
    pieces = settle_texts(tokenized_pieces(docs, tokenizer, id_col, text_col, capacity), "pieces")
    full = pieces.where(F.col("length") == capacity).select(
        *pieces.columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    done, left = full, pieces.where(F.col("length") < capacity)
    ship_package(docs.sparkSession)
    for number in range(ROUNDS):
        count = left.count()
        if not count:
            break
        placed = _round(left, count, number, capacity)
        last = number == ROUNDS - 1 or count <= SHARD_PIECES
        ready = placed if last else placed.where(F.col("filled") >= WELL_FILLED * capacity)
        ids = (F.lit(number) * F.lit(1 << 58) + F.col("shard") * F.lit(1 << 20) + F.col("bin"))
        done = done.unionByName(ready.select(*pieces.columns, ids.alias("sequence_id"), "offset"))
        if last:
            break
        left = placed.where(F.col("filled") < WELL_FILLED * capacity).select(*pieces.columns)
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
