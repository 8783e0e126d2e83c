"""Scores of texts under a bigram model by deleted interpolation, counted over all documents.

``P(w | v) = l2 c(v, w) / c(v) + l1 c(w) / N + l0 / (V + 1)``, the weights depending on how often the context
``v`` occurs (by powers of two). They are learned by expectation-maximisation on the tuning fold, whose
counts are deleted from the model for that. Words and word pairs are 64-bit hashes.

The work goes over *slices* of some thousand documents, each a row of packed arrays. A slice sends its
distinct words and pairs with their counts, dealt by ranges of the hash, so no key is hot: it arrives once per
slice, not once per occurrence. Each range adds up and answers every slice in the slice's own order. A
slice then has the counts of all its tokens at hand.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from barloom.llm.arrow_text import Words, giving_back, mixed_bits, settle_texts, slices, texts_of
from barloom.llm.common import fold
from barloom.session import settle, ship_package

FOLDS = 10
HELD_OUT, TUNING = 0, 1
ADDED = 0.1
#: Tokens whose keys one range of hashes takes in.
TOKENS_PER_RANGE = 2_000_000
EM_STEPS = 60
STEP = 8                    # bins of probabilities per factor of e
_END = np.uint64(0x5851F42D4C957F2D)
_ODD = np.uint64(0x9E3779B97F4A7C15)

PACKED = ("slice long, tokens long, doc_ids binary, known binary, folds binary, sizes binary,"
          " words binary, ranks binary, names binary")


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane: the high bytes of small ones are zeros in a row."""
    planes = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _opened(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").reshape(-1)


def _gaps(keys: np.ndarray) -> bytes:
    """Sorted hashes as the gaps between them, without high bytes that no gap needs."""
    gaps = np.diff(keys, prepend=keys[:1] * np.uint64(0)).astype("<u8")
    planes = gaps.view(np.uint8).reshape(-1, 8).T
    used = 8
    while used > 1 and len(keys) > 1 and not planes[used - 1][1:].any():
        used -= 1
    first = keys[:1].astype("<u8").tobytes()
    return bytes([used]) + first + np.ascontiguousarray(planes[:used, 1:]).tobytes()


def _keys_of(packed: bytes) -> np.ndarray:
    used, first = packed[0], np.frombuffer(packed[1:9], "<u8")
    if not len(first):
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(packed[9:], np.uint8).reshape(used, -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, :used] = planes.T
    return np.cumsum(np.concatenate([first, gaps.reshape(-1).view("<u8")]), dtype=np.uint64)


def packed_slices(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Tokens of some documents as numbers into the hashes ``names``; one end closes each."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       fold(F.col(f"`{id_col}`"), FOLDS).alias("fold"),
                       F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(texts_of(part, "text"))
                hashes = np.append(words.hashes(), _END)
                tokens = np.insert(words.ids, np.cumsum(words.sizes), len(hashes) - 1)
                often = np.argsort(-np.bincount(tokens, minlength=len(hashes)), kind="stable")
                rank = np.empty(len(often), np.int64)       # frequent words get small numbers
                rank[often] = np.arange(len(often))
                order = np.argsort(hashes)
                ids = part.column("doc_id")
                row = (number, len(tokens),
                       ids.fill_null(0).to_numpy(zero_copy_only=False).tobytes(),
                       ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                       part.column("fold").to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                       _squeezed(words.sizes + 1), _squeezed(rank[tokens]), _squeezed(rank[order]),
                       _gaps(hashes[order]))
                number += 1
                kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(row, kinds)],
                    [f.split()[0] for f in PACKED.split(", ")])

    return settle_texts(rows.mapInArrow(giving_back(run), PACKED), "slices")


class Slice:
    """The arrays of a packed slice, and its keys: sorted distinct hashes of words and of pairs.

    ``word``, ``context`` and ``pair`` are each token's places among the keys.
    """

    def __init__(self, row: dict) -> None:
        self.sizes = _opened(row["sizes"])
        self.folds = np.frombuffer(row["folds"], np.uint8)
        names, ranks = _keys_of(row["names"]), _opened(row["ranks"])
        place = np.empty(len(ranks), np.int64)
        place[ranks] = np.arange(len(ranks))
        self.word = place[_opened(row["words"])]
        end = int(np.searchsorted(names, _END))
        self.context = np.concatenate([[end], self.word[:-1]])     # an end, too, before a first word
        # pairs are told apart by their places, which are fewer bits to sort than their hashes
        both = self.context * len(names) + self.word
        pairs = _distinct(both)
        before, after = np.divmod(pairs, len(names))
        hashes = mixed_bits(mixed_bits(names[before] * _ODD) + names[after])
        order = np.argsort(hashes)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.pair = place[np.searchsorted(pairs, both)]
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.keys = {"word": names, "pair": hashes[order]}

    def counts(self, kind: str, folds: np.ndarray) -> np.ndarray:
        """How often each key occurs in documents of the given kind."""
        return np.bincount(getattr(self, kind)[folds[self.owner]], minlength=len(self.keys[kind]))


def _distinct(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def _ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of hashes begins among sorted ``keys``, and their end."""
    edges = np.array([(k << 64) // parts for k in range(parts)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


KEYS = "part int, slice long, kind string, keys binary, learned binary, tuning binary"


def _slice_keys(packed: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = Slice(row)
                for kind, keys in part.keys.items():
                    learned = part.counts(kind, part.folds != HELD_OUT)
                    tuning = part.counts(kind, part.folds == TUNING)
                    edges = _ranges(keys, parts)
                    made = [(p, row["slice"], kind, _gaps(keys[a:b]), _squeezed(learned[a:b]),
                             _squeezed(tuning[a:b]))
                            for p, (a, b) in enumerate(zip(edges, edges[1:]))]
                    kinds = [pa.int32(), pa.int64(), pa.string()] + [pa.binary()] * 3
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*made), kinds)],
                        [f.split()[0] for f in KEYS.split(", ")])

    return packed.mapInArrow(run, KEYS)


TOTALS = ("slice long, kind string, part int, learned binary, tuning binary, all_tokens long,"
          " tuning_tokens long, distinct_words long")


def _totals(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Counts over all slices of the keys of one range, for each slice in its own order."""
    rows = rows.sort_values("slice", kind="stable")
    own = [_keys_of(k) for k in rows["keys"]]
    keys, sizes = np.concatenate(own), np.array([len(k) for k in own])
    order = np.argsort(keys, kind="stable")
    new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]]) if len(keys) else \
        np.zeros(0, bool)
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    groups, ends = int(new.sum()), np.cumsum(sizes)[:-1]
    found, sums = {}, {}
    for column in ("learned", "tuning"):
        counts = np.concatenate([_opened(c) for c in rows[column]])
        sums[column] = np.bincount(group, counts, groups).astype(np.int64)
        found[column] = [_squeezed(x) for x in np.split(sums[column][group], ends)]
    words = rows["kind"].iloc[0] == "word"
    first = np.arange(len(rows)) == 0       # what holds for the range stands in one of its rows
    return pd.DataFrame({
        "slice": rows["slice"].to_numpy(), "kind": rows["kind"].to_numpy(), "part": rows["part"].to_numpy(),
        **found, "all_tokens": first * (words * int(sums["learned"].sum())),
        "tuning_tokens": first * (words * int(sums["tuning"].sum())),
        "distinct_words": first * (words * int((sums["learned"] > 0).sum()))})


def _by_key(answers: pd.DataFrame, kind: str, column: str) -> np.ndarray:
    """The answers for a slice's keys, in their order."""
    own = answers[answers["kind"] == kind].sort_values("part")
    return np.concatenate([_opened(c) for c in own[column]])


def _tuning_tokens(packed: DataFrame) -> DataFrame:
    """Places of pair, context and word of each token of the tuning fold, and no other token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = Slice(row)
                own = (part.folds == TUNING)[part.owner]
                made = [row["slice"], *(_squeezed(x[own]) for x in (part.pair, part.context, part.word))]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in made],
                                                 ["slice", "pair", "context", "word"])

    return packed.mapInArrow(run, "slice long, pair binary, context binary, word binary")


def bucket(context_count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two below its count."""
    return np.where(context_count > 0, np.floor(np.log2(np.maximum(context_count, 1))) + 1, 0).astype(
        np.int64)


def _bin(p: np.ndarray) -> np.ndarray:
    """Probabilities in steps of a constant factor; -1 for zero."""
    return np.where(p > 0, np.round(-STEP * np.log(np.maximum(p, 1e-300))), -1).astype(np.int64)


def _of_bin(q: np.ndarray) -> np.ndarray:
    return np.where(q >= 0, np.exp(-q / STEP), 0.0)


def mixture_weights(bins: np.ndarray, uniform: float, steps: int = EM_STEPS) -> np.ndarray:
    """Weights (pair, word, uniform) per bucket from rows ``bucket, pair bin, word bin, times``."""
    buckets = 64
    weights = np.tile([0.3, 0.6, 0.1], (buckets, 1))
    weights[0] = [0.0, 0.9, 0.1]
    if len(bins):
        of, times = bins[:, 0], bins[:, 3].astype(float)
        p = np.stack([_of_bin(bins[:, 1]), _of_bin(bins[:, 2]), np.full(len(bins), uniform)], axis=1)
        for _ in range(steps):
            share = weights[of] * p
            share *= (times / share.sum(axis=1))[:, None]
            sums = np.stack([np.bincount(of, share[:, k], buckets) for k in range(3)], axis=1)
            sums += 0.5 * np.array([0.3, 0.6, 0.1])      # half a token of what was believed before
            weights = sums / sums.sum(axis=1, keepdims=True)
    return weights


SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
          " base_score double, score double")


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``SCORED``; log10 probabilities of the whole text.

    Documents of fold 0 of 10 (by a hash of the id) are not learned from. A null text is empty: its end is
    its only token. Rows that repeat an id count each. An empty table gives no rows. Without
    training tokens every probability is 1 / (V + 1) with V = 0.
    """
    packed = packed_slices(docs, id_col, text_col)
    tokens = packed.agg(F.sum("tokens")).head()[0] or 0
    parts = max(1, -(-tokens // TOKENS_PER_RANGE))
    totals = settle(_slice_keys(packed, parts).groupBy("kind", "part").applyInPandas(
        lambda key, rows: _totals(key, rows), TOTALS), "totals")
    sums = totals.agg(F.sum("all_tokens").alias("n"), F.sum("tuning_tokens").alias("t"),
                      F.sum("distinct_words").alias("v")).head()
    n, v, kept = sums["n"] or 0, sums["v"] or 0, (sums["n"] or 0) - (sums["t"] or 0)
    answers = totals.select("slice", "kind", "part", "learned", "tuning").groupBy("slice")
    final = totals.select("slice", "kind", "part", "learned").groupBy("slice")
    uniform = 1.0 / (v + 1)

    def probabilities(pair, context, word, total):
        p2 = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
        return p2, word / max(total, 1)

    def binned(key, slices: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        row = slices.iloc[0]
        kept_of = {k: _by_key(counts, k, "learned") - _by_key(counts, k, "tuning") for k in ("word", "pair")}
        pair = kept_of["pair"][_opened(row["pair"])]
        context, word = (kept_of["word"][_opened(row[c])] for c in ("context", "word"))
        p2, p1 = probabilities(pair, context, word, kept)
        frame = pd.DataFrame({"bucket": bucket(context), "pair": _bin(p2), "word": _bin(p1)})
        return frame.groupby(["bucket", "pair", "word"]).size().reset_index(name="times")

    rows = (_tuning_tokens(packed).groupBy("slice").cogroup(answers)
            .applyInPandas(binned, "bucket long, pair long, word long, times long")
            .groupBy("bucket", "pair", "word").agg(F.sum("times").alias("times")).collect())
    bins = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 4)
    weights = mixture_weights(bins, uniform)

    def score(key, slices: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        row = slices.iloc[0].to_dict()
        part = Slice(row)
        learned = {k: _by_key(counts, k, "learned") for k in ("word", "pair")}
        pair, context, word = (learned["pair"][part.pair], learned["word"][part.context],
                               learned["word"][part.word])
        p2, p1 = probabilities(pair, context, word, n)
        w = weights[bucket(context)]
        model = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * uniform)
        base = np.log10((word + ADDED) / (n + ADDED * (v + 1)))
        docs = len(part.sizes)
        known = np.frombuffer(row["known"], np.uint8) > 0
        ids = pd.array(np.frombuffer(row["doc_ids"], "<i8"), dtype="Int64")
        ids[~known] = pd.NA
        return pd.DataFrame({
            "doc_id": ids, "held_out": part.folds == HELD_OUT, "n_tokens": part.sizes,
            "n_known": np.bincount(part.owner[word > 0], minlength=docs),
            "train_tokens": np.full(docs, n), "base_score": np.bincount(part.owner, base, docs),
            "score": np.bincount(part.owner, model, docs)})

    return packed.groupBy("slice").cogroup(final).applyInPandas(score, SCORED)
