"""Toxicity by the nearest labelled examples, found exactly in a block-max inverted index.

Terms are words and the beginnings of words; those that tell the classes apart best are kept. A text
is the TF-IDF vector of its kept terms, with occurrences per thousand words, and one term that stands
for all other words, so that a rare term in a long text weighs little. Labelled examples with equal
vectors are one entry. Entries of similar vectors lie in one block of the index; for each term
a block holds its postings and their largest weight. The largest weights bound the cosine of a query to
any entry of a block; blocks are opened in the order of that bound until it is below the k-th best
cosine found, so no nearer entry is missed.

Neighbours vote with a power of their cosine. Votes of the examples about each other (each without
itself) are compared with their labels, and a rising step function turns votes into probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from barloom.llm.arrow_text import Words, giving_back, slices, small_batches, texts_of, with_columns_in_arrow
from barloom.llm.labelled import FOLDS, SAMPLE_PER_CLASS, labelled_sample
from barloom.session import ship_package

TERMS = 128
NEIGHBOURS = 15
POWER = 6
BLOCK = 64
THRESHOLD = 0.5
PREFIXES = (4, 6, 8)
#: Weight of the term that stands for all words without a term.
OTHER_WORDS = 5.0
EVIDENCE = 3
#: Bytes of text that are compared at once.
SLICE = 2 << 20
_LETTERS = re.compile(r"[^\W\d_]+")


def word_terms(word: str) -> tuple[list[str], int]:
    """The terms of a piece of text between white space, and how many words it holds."""
    runs = _LETTERS.findall(word.lower())
    return [t for run in runs
            for t in [run + ">", *(run[:n] for n in PREFIXES if len(run) >= n)]], len(runs)


@dataclass
class Vocabulary:
    """The kept terms; ``idf`` has one more entry, for all other words."""

    terms: dict[str, int]
    idf: np.ndarray | None = None

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How often each term occurs in each text, and how many words each has."""
        words = Words(texts, lower=False)
        width, n = len(self.terms), len(words.sizes)
        terms, sizes, runs = [], [], []
        for word in words.names.to_pylist():
            found, count = word_terms(word)
            kept = [self.terms[t] for t in found if t in self.terms]
            terms += kept
            sizes.append(len(kept))
            runs.append(count)
        sizes, runs = np.array(sizes, np.int64), np.array(runs, np.float64)
        terms, starts = np.array(terms, np.int64), np.concatenate([[0], np.cumsum(sizes)])
        owners = words.owners()
        length = np.bincount(owners, weights=runs[words.ids] if len(words.ids) else None, minlength=n)
        with_terms = sizes[words.ids] > 0 if len(words.ids) else np.zeros(0, bool)
        ids, of = words.ids[with_terms], owners[with_terms]
        many = sizes[ids]
        at = np.repeat(starts[ids] - np.cumsum(many) + many, many) + np.arange(many.sum())
        cells = np.repeat(of, many) * width + terms[at.astype(np.int64)]
        return np.bincount(cells, minlength=n * width).reshape(n, width), length

    def vectors(self, counts: np.ndarray, length: np.ndarray) -> np.ndarray:
        per_thousand = 1000 * counts / np.maximum(length, 20)[:, None]
        raw = np.concatenate([np.log1p(per_thousand), np.full((len(counts), 1), 1.0)], axis=1)
        raw = raw * self.idf[None, :]
        return (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)


@dataclass
class BlockMaxIndex:
    """Entries in blocks: per block its terms, their postings by entry, and the largest of each."""

    weights: np.ndarray          # of entries, in the order of blocks; with zeros left out below
    postings: list[tuple[np.ndarray, np.ndarray]]
    largest: np.ndarray

    @classmethod
    def build(cls, vectors: np.ndarray, block: int = BLOCK) -> tuple[BlockMaxIndex, np.ndarray]:
        """The index, and the order in which it holds ``vectors``: by strongest terms."""
        strongest = np.argsort(-vectors, axis=1, kind="stable")[:, :3]
        by_term = [strongest[:, k] for k in reversed(range(strongest.shape[1]))]
        order = np.lexsort((-vectors[np.arange(len(vectors)), strongest[:, 0]], *by_term))
        held = vectors[order]
        parts = [held[i:i + block] for i in range(0, len(held), block)]
        largest = np.array([p.max(axis=0) for p in parts], np.float32).reshape(len(parts), -1)
        postings = [(terms := np.flatnonzero(m), np.ascontiguousarray(p[:, terms].T))
                    for p, m in zip(parts, largest)]
        return cls(held, postings, largest), order

    def nearest(self, queries: np.ndarray, k: int, block: int = BLOCK
                ) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines of the ``k`` nearest of each query, nearest first, ties by entry."""
        n, blocks = len(queries), len(self.postings)
        best = np.full((n, k), -1.0, np.float32)
        found = np.full((n, k), len(self.weights), np.int64)
        bounds = queries @ self.largest.T
        opening = np.argsort(-bounds, axis=1, kind="stable")
        for turn in range(blocks):
            bound = np.take_along_axis(bounds, opening[:, turn:turn + 1], axis=1)[:, 0]
            going = np.flatnonzero(bound + 1e-5 >= best[:, -1])
            if not len(going):
                break
            which = opening[going, turn]
            for b in np.flatnonzero(np.bincount(which, minlength=blocks)):
                rows = going[which == b]
                terms, lists = self.postings[b]
                scores = queries[np.ix_(rows, terms)] @ lists
                entries = np.broadcast_to(b * block + np.arange(scores.shape[1]), scores.shape)
                scores = np.concatenate([best[rows], scores], axis=1)
                entries = np.concatenate([found[rows], entries], axis=1)
                order = np.lexsort((entries, -scores), axis=1)[:, :k]
                best[rows] = np.take_along_axis(scores, order, axis=1)
                found[rows] = np.take_along_axis(entries, order, axis=1)
        return found, best


@dataclass
class Model:
    vocabulary: Vocabulary
    index: BlockMaxIndex
    positive: np.ndarray   # toxic examples of each entry, and a last 0 for no entry
    total: np.ndarray
    ids: np.ndarray        # smallest id of each entry
    toxic_weight: float    # documents that one sampled toxic example stands for
    other_weight: float
    prior: float
    neighbours: int = NEIGHBOURS
    steps: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def votes(self, queries: np.ndarray, own: np.ndarray | None = None,
              label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The weighted share of toxic ones among the nearest examples; ``own`` leaves one out.

        Equal examples share what is left of the k places.
        """
        entries, cosines = self.index.nearest(queries, self.neighbours)
        positive, total = self.positive[entries].astype(float), self.total[entries].astype(float)
        if own is not None:
            mine = entries == own[:, None]
            positive -= mine * label[:, None]
            total -= mine
        before = np.cumsum(total, axis=1) - total
        share = np.clip(self.neighbours - before, 0, total) / np.maximum(total, 1)
        weight = share * np.maximum(cosines, 0) ** POWER
        toxic = (weight * positive).sum(axis=1) * self.toxic_weight
        other = (weight * (total - positive)).sum(axis=1) * self.other_weight
        smooth = 0.02 * self.other_weight
        return (toxic + smooth * self.prior) / (toxic + other + smooth), entries, cosines

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vote, entries, cosines = self.votes(self.vocabulary.vectors(*self.vocabulary.counts(texts)))
        return np.interp(vote, *self.steps), entries, cosines


def rising_steps(vote: np.ndarray, label: np.ndarray, weight: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Points of a rising function from votes to probabilities: adjacent violators pooled.

    A little of the vote itself stays in, so that different votes give different scores.
    """
    order = np.argsort(vote, kind="stable")
    pools: list[list[float]] = []   # weight, toxic weight, sum of votes
    for i in order:
        pools.append([weight[i], weight[i] * label[i], weight[i] * vote[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    x = np.array([p[2] / p[0] for p in pools])
    y = np.array([(p[1] + 0.05) / (p[0] + 0.1) for p in pools]) if pools else x
    x, y = np.concatenate([[0.0], x, [1.0]]), np.concatenate([y[:1], y, y[-1:]])
    return x, np.maximum.accumulate(0.98 * y + 0.01 + 0.01 * (2 * x - 1))


def _terms_of(texts: pa.Array) -> list[pa.Array]:
    words = Words(texts, lower=False)
    by_word = [word_terms(w)[0] for w in words.names.to_pylist()]
    found = []
    for i in range(len(words.sizes)):
        own = set()
        for w in set(words.ids[words.starts[i]:words.starts[i + 1]].tolist()):
            own.update(by_word[w])
        found.append(sorted(own))
    return [pa.array(found, pa.list_(pa.string()))]


def choose_terms(sample: DataFrame, size: int = TERMS) -> dict[str, int]:
    """The terms whose presence depends most on the label, by chi-squared; ties by term.

    Of the beginnings of one word that occur in the same documents only one is taken.
    """
    with_terms = with_columns_in_arrow(
        sample, "text", T.StructType([T.StructField("terms", T.ArrayType(T.StringType()))]),
        _terms_of, ["label"])
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    a, b = F.col("toxic"), F.col("seen") - F.col("toxic")
    c, d = F.lit(pos) - a, F.lit(neg) - b
    chi = (pos + neg) * (a * d - b * c) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d) + 1e-9)
    ranked = (with_terms.select("label", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("seen"))
              .where("seen >= 5").withColumn("chi", chi)
              .orderBy(F.desc("chi"), "term").limit(8 * size).collect())
    seen, terms = set(), {}
    for row in ranked:
        key = row["toxic"], row["seen"], row["term"][:PREFIXES[0]]
        if key not in seen and len(terms) < size:
            seen.add(key)
            terms[row["term"]] = len(terms)
    return terms


def _document_frequencies(docs: DataFrame, vocabulary: Vocabulary, text_col: str) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and how many documents there are."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(vocabulary.terms) + 1, np.int64), 0
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                counts, _ = vocabulary.counts(texts_of(part, text_col))
                total[:-1] += (counts > 0).sum(axis=0)
                total[-1] += len(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)],
                                         ["term", "n"])

    with small_batches(docs.sparkSession):
        rows = (docs.select(f"`{text_col}`").mapInArrow(giving_back(count), "term long, n long")
                .groupBy("term").agg(F.sum("n").alias("n")).collect())
    found = np.zeros(len(vocabulary.terms) + 1, np.int64)
    for row in rows:
        found[row["term"]] = row["n"]
    return found[:-1], int(found[-1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text_col: str = "text",
        per_class: int = SAMPLE_PER_CLASS, terms: int = TERMS, neighbours: int = NEIGHBOURS,
        folds: int = FOLDS) -> Model | float:
    """The model; where one class is missing, only the label of the other, and 0 without any label.

    ``per_class`` bounds the labelled examples that are indexed; document frequencies are those
    of all documents.
    """
    sample, sizes = labelled_sample(docs, labels, label, per_class, folds)
    if not sizes.get(0) or not sizes.get(1):
        return float(1 in sizes)
    vocabulary = Vocabulary(choose_terms(sample, terms))
    present, documents = _document_frequencies(docs, vocabulary, text_col)
    vocabulary.idf = np.concatenate([np.log((documents + 1) / (present + 1)) + 0.1, [OTHER_WORDS]])
    counted = with_columns_in_arrow(
        sample, "text", T.StructType([T.StructField("counts", T.ArrayType(T.LongType())),
                                      T.StructField("length", T.DoubleType())]),
        lambda texts: _counted(vocabulary, texts), ["doc_id", "label"])
    rows = sorted(counted.collect(), key=lambda r: r["doc_id"])   # at most 2 * per_class
    if not {r["label"] for r in rows} == {0, 1}:
        return float(sizes[1] / (sizes[0] + sizes[1]))
    label_of = np.array([r["label"] for r in rows])
    vectors = vocabulary.vectors(
        np.array([r["counts"] for r in rows], np.int64).reshape(len(rows), -1),
        np.array([r["length"] for r in rows]))
    distinct, entry = np.unique(vectors, axis=0, return_inverse=True)
    index, order = BlockMaxIndex.build(distinct)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    entry = place[entry.reshape(-1)]
    n = len(distinct)
    ids = np.full(n + 1, np.iinfo(np.int64).max)
    np.minimum.at(ids, entry, np.array([r["doc_id"] for r in rows]))
    weight = {y: sizes[y] / max((label_of == y).sum(), 1) for y in (0, 1)}
    model = Model(vocabulary, index, np.bincount(entry, weights=label_of, minlength=n + 1),
                  np.bincount(entry, minlength=n + 1), ids, weight[1], weight[0],
                  sizes[1] / (sizes[0] + sizes[1]), neighbours)
    vote, _, _ = model.votes(vectors, entry, label_of)
    model.steps = rising_steps(vote, label_of, np.where(label_of == 1, weight[1], weight[0]))
    return model


def _counted(vocabulary: Vocabulary, texts: pa.Array) -> list[pa.Array]:
    counts, length = vocabulary.counts(texts)
    return [pa.array(counts.tolist(), pa.list_(pa.int64())), pa.array(length, pa.float64())]


SCORED = T.StructType([
    T.StructField("toxic_score", T.DoubleType()),
    T.StructField("evidence", T.ArrayType(T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("similarity", T.DoubleType())])))])


def with_scores(docs: DataFrame, model: Model | float, text_col: str = "text",
                carried: list[str] | None = None) -> DataFrame:
    """``carried`` columns (all, if not given) with ``toxic_score`` (0 to 1) and ``evidence``, the nearest examples.

    One that is called like an added one is replaced. A null text is an empty one;
    texts without words are compared by what they lack, so they get a score too.
    """
    if isinstance(model, float):
        kept = [c for c in (docs.columns if carried is None else carried) if c.lower() not in ("toxic_score", "evidence")]
        return docs.select(*(f"`{c}`" for c in kept), F.lit(model).alias("toxic_score"),
                           F.array().cast(SCORED["evidence"].dataType).alias("evidence"))
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64())]))

    def score(texts: pa.Array) -> list[pa.Array]:
        scores, entries, cosines = model.scores(texts)
        ids = model.ids[entries[:, :EVIDENCE]]
        real = entries[:, :EVIDENCE] < len(model.ids) - 1
        shown = [[{"doc_id": i, "similarity": round(float(c), 6)} for i, c, r in zip(*x) if r]
                 for x in zip(ids.tolist(), cosines[:, :EVIDENCE].tolist(), real.tolist())]
        return [pa.array(scores, pa.float64()), pa.array(shown, evidence)]

    return with_columns_in_arrow(docs, text_col, SCORED, score,
                                 docs.columns if carried is None else carried, SLICE)
