"""Ranked lexical search by the Best Position Algorithm over impact lists.

A term's impact list holds the documents with the term, highest impact first. Documents are indexed in shards:
slices of texts become postings once, restricted to terms that an item asks for, and several slices
are one shard. For an item, the lists of its terms are read downwards side by side. Each document met is
looked up in the item's other lists at once (direct access), which gives its whole score *and* its
positions there. The best position of a list is the end of the unbroken run of seen positions from
the top, whether they were read or looked up. No unseen document stands above it, so the weighted sum of the
impacts that follow the best positions bounds the score of all unseen ones. Reading stops when that bound is
strictly below the k-th best score, so that ties are still met. A task carries its k best on from
shard to shard; the k best of all tasks are ranked in two steps.

Items are answered in blocks of bounded size; scores are 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from barloom.llm.arrow_text import giving_back, settle_texts, slices, texts_of
from barloom.llm.terms import terms_of
from barloom.session import ship_package

K = 10
#: Bytes of item texts that are answered in one pass over the index.
BLOCK_BYTES = 8 << 20
#: A shard ends with the slice that brings it to so many postings or documents.
SHARD_POSTINGS = 2_000_000
SHARD_DOCS = 1 << 16
#: Positions of each list that are read first; each further step reads twice as many.
FIRST_READ = 32
#: Groups of tasks whose best are ranked first, each by itself.
SALTS = 64
# A posting as one number, so that a plain sort gives an order: term, then impact or document.
_DOC_BITS, _IMPACT_BITS = 17, 20
_DOCS, _IMPACTS = np.int64((1 << _DOC_BITS) - 1), np.int64((1 << _IMPACT_BITS) - 1)


def term_weight(documents: int, present: Column) -> Column:
    """floor(1000 * ln((2N + 2) / (2df + 1))) in doubles."""
    share = F.lit(2.0 * documents + 2.0) / (2.0 * present.cast("double") + 1.0)
    return F.floor(1000.0 * F.log(share)).cast("long")


def impacts(times: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The impact of ``times`` occurrences in documents of ``length`` terms."""
    damping = 25 + 75 * length * np.int64(documents) // np.int64(total)
    return 1_000_000_000 * times // (1000 * times + 8 * damping)


def counted_items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item, item_id, terms, times)``: a number for each row, its id, and its terms with repeats counted."""
    ship_package(items.sparkSession)
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{id_col}`").alias("item_id"),
                        F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = terms_of(texts_of(part, "text"))
                names = words.names.to_pylist()
                terms, times = [], []
                for a, b in zip(words.starts[:-1], words.starts[1:]):
                    own, many = np.unique(words.ids[a:b], return_counts=True)
                    terms.append([names[i] for i in own])
                    times.append(many.tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("item"), part.column("item_id"), pa.array(terms, pa.list_(pa.string())),
                     pa.array(times, pa.list_(pa.int64()))], ["item", "item_id", "terms", "times"])

    return rows.mapInArrow(run, T.StructType([
        T.StructField("item", T.LongType()), rows.schema["item_id"],
        T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("times", T.ArrayType(T.LongType()))]))


def _indexed(docs: DataFrame, vocabulary: pa.Array, id_col: str, text_col: str) -> DataFrame:
    """One row per slice: ids, lengths, and the postings of the vocabulary's terms, by term and document."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(kind)), T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("present", T.ArrayType(T.LongType())),
        T.StructField("docs", T.BinaryType()), T.StructField("times", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = terms_of(texts_of(part, "text"))
                codes = pc.fill_null(pc.index_in(words.names.cast(vocabulary.type), vocabulary), -1)
                codes = codes.to_numpy(zero_copy_only=False).astype(np.int64)
                of = codes[words.ids] if len(words.ids) else np.zeros(0, np.int64)
                asked = of >= 0
                keys, times = np.unique(of[asked] << _DOC_BITS | words.owners()[asked], return_counts=True)
                own, present = np.unique(keys >> _DOC_BITS, return_counts=True)
                ids = part.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                     pa.array([words.sizes.tolist()], pa.list_(pa.int64())),
                     pa.array([own.tolist()], pa.list_(pa.int64())),
                     pa.array([present.tolist()], pa.list_(pa.int64())),
                     pa.array([(keys & _DOCS).astype("<u2").tobytes()], pa.binary()),
                     pa.array([times.astype("<u4").tobytes()], pa.binary())], schema.names)

    return rows.mapInArrow(giving_back(run), schema)


@dataclass
class Shard:
    """The impact lists of some documents: list ``t`` is ``starts[t]`` to ``starts[t + 1]`` of the arrays."""

    codes: np.ndarray        # terms that occur, ascending
    starts: np.ndarray
    docs: np.ndarray         # by term, impact from the highest, document
    impact: np.ndarray
    looked_up: np.ndarray    # by term and document: the document, and its position in the impact list
    position: np.ndarray
    order: np.ndarray        # of each document among the ids

    @classmethod
    def of(cls, code: np.ndarray, doc: np.ndarray, impact: np.ndarray, order: np.ndarray) -> Shard:
        ranked = np.sort(code << (_IMPACT_BITS + _DOC_BITS) | (_IMPACTS - impact) << _DOC_BITS | doc)
        docs = ranked & _DOCS
        impact = _IMPACTS - (ranked >> _DOC_BITS & _IMPACTS)
        code = ranked >> (_IMPACT_BITS + _DOC_BITS)
        codes, first = np.unique(code, return_index=True)
        starts = np.concatenate([first, [len(code)]])
        position = np.arange(len(code)) - np.repeat(first, np.diff(starts))
        by_doc = np.sort(code << (2 * _DOC_BITS) | docs << _DOC_BITS | position)
        return cls(codes, starts, docs, impact, by_doc >> _DOC_BITS & _DOCS, by_doc & _DOCS, order)

    def best(self, codes: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` best, at least those with ``least`` or more; ties by id.

        ``least`` is a score that ``k`` documents elsewhere reach.
        """
        at = np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))
        held = (self.codes[at] == codes) & (weights > 0) if len(self.codes) else np.zeros(len(codes), bool)
        lists = [(int(w), int(a), int(b)) for w, a, b in
                 zip(weights[held], self.starts[at[held]], self.starts[at[held] + 1])]
        seen = [np.zeros(b - a, bool) for _, a, b in lists]
        run = [0] * len(lists)                   # best positions
        known = np.zeros(len(self.order), bool)
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        read, step = 0, FIRST_READ
        while lists:
            met = np.unique(np.concatenate([self.docs[a + read:min(a + read + step, b)] for _, a, b in lists]))
            met = met[~known[met]]
            known[met] = True
            score = np.zeros(len(met), np.int64)
            for i, (weight, a, b) in enumerate(lists):
                place = np.minimum(np.searchsorted(self.looked_up[a:b], met), b - a - 1) + a
                there = self.looked_up[place] == met
                positions = self.position[place[there]]
                seen[i][positions] = True
                score[there] += weight * self.impact[a + positions]
            found, scores = np.concatenate([found, met]), np.concatenate([scores, score])
            read, step = read + step, 2 * step
            bound = 0
            for i, (weight, a, b) in enumerate(lists):
                rest = seen[i][run[i]:]
                gap = int(np.argmin(rest)) if len(rest) else 0
                run[i] = b - a if len(rest) == 0 or rest[gap] else run[i] + gap
                if run[i] < b - a:
                    bound += weight * int(self.impact[a + run[i]])
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            if bound < least or bound == 0:
                break
        good = scores >= max(least, 1)
        found, scores = found[good], scores[good]
        chosen = np.lexsort((self.order[found], -scores))[:k]
        return found[chosen], scores[chosen]


def _shards(batches: Iterator[pa.RecordBatch], documents: int, total: int) -> Iterator[tuple[Shard, pa.Array]]:
    """Shards made of the rows of ``_indexed``, each with the ids of its documents."""
    def made() -> tuple[Shard, pa.Array]:
        ids = pa.concat_arrays([p[0] for p in held])
        before = np.cumsum([0] + [len(p[0]) for p in held])
        code, doc, times, length = (np.concatenate(x) for x in zip(*(
            (c, d + b, t, n[d]) for (_, n, c, d, t), b in zip(held, before))))
        order = np.empty(len(ids), np.int64)
        ranked = pc.sort_indices(ids, null_placement="at_end").to_numpy(zero_copy_only=False)
        order[ranked.astype(np.int64)] = np.arange(len(ids))
        return Shard.of(code, doc, impacts(times, length, documents, total), order), ids

    held, postings, docs = [], 0, 0
    for batch in batches:
        for row in range(batch.num_rows):
            ids, lengths, codes, present = (batch.column(c)[row].values for c in range(4))
            code = np.repeat(codes.to_numpy(), present.to_numpy())
            doc = np.frombuffer(batch.column(4)[row].as_py(), "<u2").astype(np.int64)
            times = np.frombuffer(batch.column(5)[row].as_py(), "<u4").astype(np.int64)
            if held and (docs + len(ids) > SHARD_DOCS or postings + len(code) > SHARD_POSTINGS):
                yield made()
                held, postings, docs = [], 0, 0
            held.append((ids, lengths.to_numpy(), code, doc, times))
            postings, docs = postings + len(code), docs + len(ids)
    if held:
        yield made()


def _in_order(pair: tuple) -> tuple:
    score, doc_id = pair
    return (-score, doc_id is None, 0 if doc_id is None else doc_id)


def _answers(index: DataFrame, asked: list[tuple[int, np.ndarray, np.ndarray]], documents: int, total: int,
             k: int, id_type: T.DataType) -> DataFrame:
    """``(item, doc_id, score)``: the best of each task for each item."""
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", id_type),
                           T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        kind = None
        for shard, ids in _shards(batches, documents, total):
            kind = ids.type
            for item, codes, weights in asked:
                own = best.get(item, [])
                least = own[-1][0] if len(own) == k else 0
                found, scores = shard.best(codes, weights, k, least)
                if len(found):
                    more = list(zip(scores.tolist(), ids.take(pa.array(found)).to_pylist()))
                    best[item] = sorted(own + more, key=_in_order)[:k]
        rows = [(item, doc_id, score) for item, own in best.items() for score, doc_id in own]
        if rows:
            items, doc_ids, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int64()), pa.array(doc_ids, kind), pa.array(scores, pa.int64())], schema.names)

    return index.mapInArrow(giving_back(run), schema)


def _ranked(best: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item with their ranks: first within groups of tasks, then of all."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    salted = best.withColumn("salt", F.spark_partition_id() % SALTS)
    for by in (["item", "salt"], ["item"]):
        salted = salted.withColumn("rank", F.row_number().over(
            Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    return salted


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each row of ``items``:
    ``item_id, rank, doc_id, score``, columns named as in the inputs; equal scores by ascending id.

    Ids may be of any type that has an order; a null id comes last. Each row of ``docs`` is a document
    and each row of ``items`` an item, also those that repeat an id or a text. A null or empty text has
    no terms, such an item no row. Other columns are not read. Empty tables give no rows.

    ``block_bytes`` bounds the item texts whose terms are sent to tasks at once (a longer text is a block of its
    own); documents are indexed anew for each block.
    """
    counted = settle_texts(counted_items(items, item_col, item_text_col), "items")
    size = counted.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"),
                                         lambda n, t: n + F.octet_length(t) + 8))).head()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    result = None
    for number in range(blocks):
        # items of one block: bounded by block_bytes
        rows = counted.where(block == number).where(F.size("terms") > 0).select("item", "terms", "times").collect()
        if not rows and (result is not None or number < blocks - 1):
            continue
        names = sorted({t for r in rows for t in r["terms"]})
        vocabulary = pa.array(names, pa.large_string())
        index = settle_texts(_indexed(docs, vocabulary, id_col, text_col), "index")
        documents, total = index.select(
            F.size(F.filter("lengths", lambda n: n > 0)).alias("documents"),
            F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n).alias("total")).agg(
            F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).head()
        weight = np.zeros(len(names), np.int64)
        present = index.select(F.explode(F.arrays_zip("codes", "present")).alias("p")).groupBy(
            F.col("p.codes").alias("code")).agg(F.sum("p.present").alias("df"))
        for row in present.select("code", term_weight(documents, F.col("df")).alias("w")).collect():
            weight[row["code"]] = row["w"]          # one row per term of the block
        code_of = {t: i for i, t in enumerate(names)}
        asked = []
        for row in rows:
            codes = np.array([code_of[t] for t in row["terms"]], np.int64)
            asked.append((row["item"], codes, weight[codes] * np.array(row["times"], np.int64)))
        id_type = docs.schema[id_col].dataType
        ranked = _ranked(_answers(index, asked, documents, total, k, id_type), k)
        result = ranked if result is None else result.unionByName(ranked)
    return result.join(counted.select("item", "item_id"), "item").select(
        F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"),
        F.col("doc_id").alias(id_col), "score")


def oracle() -> str:
    """The same in SQL over ``documents`` and ``benchmark``."""
    def terms(table: str, key: str) -> str:
        return (f"select {key}, unnest(regexp_extract_all(translate(coalesce(text, ''),"
                f" 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
                r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from " + table)
    return f"""
with p as (select doc_id, term, count(*) as tf from ({terms('documents', 'doc_id')}) group by all),
d as (select doc_id, sum(tf)::bigint as n from p group by doc_id),
g as (select count(*)::bigint as docs, sum(n)::bigint as total from d),
t as (select term, floor(1000 * ln((2.0::double * docs + 2) / (2.0::double * count(*) + 1)))::bigint as w
      from p, g group by term, docs),
m as (select doc_id, 100 - 75 + (75 * n * docs) // total as m from d, g),
q as (select item_id, term, count(*) as times from ({terms('benchmark', 'item_id')}) group by all),
s as (select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
      from q join t using (term) join p using (term) join m using (doc_id) group by all),
r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank,
        doc_id, score from s where score > 0)
select * from r where rank <= {K}
"""
