"""Ranked search, importance draws and personal data: against plain versions, and inputs at the edge."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from barloom.llm import importance, personal_data, ranked_search
from barloom.llm.catalog import QUERIES
from barloom.llm.terms import terms_of

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, rank string, score double, row long, ids string"
LONG = " ".join(f"w{k % 997}x{k % 89}" for k in range(30_000))
EDGES = [(1, None, "a", 0.1, 1, "x"), (2, "", "a", 0.1, 1, "x"), (3, " .\n", "a", 0.1, 1, "x"), (4, LONG, "a", 0.1, 1, "x"),
         (5, "one two w1x1", "a", 0.1, 1, "x"), (5, "one two w1x1", "a", 0.1, 1, "x"), (None, "ONE two w1x1", None, None, None, None),
         (6, "Zwei drei é" * 20, "a", 0.1, 1, "x")]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_terms(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k):
    """``[(item, rank, doc_id, score)]`` by scoring every document; ids None last."""
    tokens = [(i, plain_terms(t)) for i, t in docs]
    n_docs, total = sum(bool(t) for _, t in tokens), sum(len(t) for _, t in tokens)
    df = collections.Counter(t for _, own in tokens for t in set(own))
    rows = []
    for item, text in items:
        scored = []
        for doc_id, own in tokens:
            tf, m = collections.Counter(own), 25 + (75 * len(own) * n_docs // total if total else 0)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in plain_terms(text) if tf[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return rows


@pytest.mark.parametrize("block_bytes", [ranked_search.BLOCK_BYTES, 40])
def test_search_finds_what_scoring_all_finds(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 64)
    rng = random.Random(block_bytes)
    vocabulary = [f"w{k}" for k in range(40)]
    docs = [(i if i % 9 else None, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(40)], k=rng.randint(0, 30))))
            for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(200)]        # a group of copies, tied for each item
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 12)))) for i in range(12)]
    found = ranked_search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                 spark.createDataFrame(items, "item_id long, text string"), 7)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain_search(docs, items, 7), key=str)


def test_search_reads_no_further_than_needed():
    rng = np.random.default_rng(1)
    docs = np.arange(4000)
    code = np.repeat([0, 1], 4000)
    impact = np.concatenate([rng.integers(1, 1000, 4000), rng.integers(1, 1000, 4000)])
    impact[[17, 4017]] = 100_000                   # one document leads both lists by far
    shard = ranked_search.Shard.of(code, np.concatenate([docs, docs]), impact, docs)
    whole = impact[:4000] * 2 + impact[4000:] * 3
    found, scores = shard.best(np.array([0, 1]), np.array([2, 3]), 1, 0)
    assert (found[0], scores[0]) == (17, whole[17]) and len(found) == 1
    for k in (1, 5, 50):
        found, scores = shard.best(np.array([0, 1]), np.array([2, 3]), k, 0)
        best = np.lexsort((docs, -whole))[:k]
        assert (found == best).all() and (scores == whole[best]).all()
    # a score of that height elsewhere leaves nothing to give, equal ones are still given
    assert len(shard.best(np.array([0, 1]), np.array([2, 3]), 1, int(whole[17]) + 1)[0]) == 0
    assert len(shard.best(np.array([0, 1]), np.array([2, 3]), 1, int(whole[17]))[0]) == 1


def test_search_of_edges(spark, edges, nothing):
    items = spark.createDataFrame([("a", "one ONE two"), ("a", "one ONE two"), ("b", None), (None, "w1x1 é"), ("c", LONG)],
                                  "item_id string, text string")
    rows = [tuple(r) for r in ranked_search.search(edges, items, 3).collect()]
    wanted = plain_search([(r[0], r[1]) for r in EDGES], [tuple(r) for r in items.collect()], 3)
    assert sorted(rows, key=str) == sorted(wanted, key=str)
    assert ranked_search.search(nothing, items).count() == 0
    assert ranked_search.search(edges, items.limit(0)).count() == 0
    texts = ranked_search.search(edges.selectExpr("cast(doc_id as string) as doc_id", "text"), items, 3)
    assert dict(texts.dtypes)["doc_id"] == "string" and texts.count() == len(wanted)


def test_features_are_runs_of_words():
    texts = ["a b c a b", "", "x", "b c", "ñ! 1,2 Ab"]
    owner, bucket = importance.features(terms_of(pa.array(texts)), 3, 10_000)
    found = collections.Counter(zip(owner.tolist(), bucket.tolist()))
    wanted = collections.Counter()
    for i, text in enumerate(texts):
        words = plain_terms(text)
        for size in (1, 2, 3):
            for k in range(len(words) - size + 1):
                wanted[i, zlib.crc32(" ".join(words[k:k + size]).encode()) % 10_000] += 1
    assert found == wanted


def plain_draw(docs, target, least, percent):
    def buckets(text):
        return [zlib.crc32(w.encode()) % 10_000 for w in plain_terms(text)]
    s, t = (collections.Counter(b for x in texts for b in buckets(x)) for texts in ([d[1] for d in docs], target))
    ns, nt = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        own = buckets(text)
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * (ns + 10_000) / ((s[b] + 1) * (nt + 10_000)))) for b in own)
        weight = gain // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    asked = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(asked[:len(asked) * percent // 100]):
        row[4] = rank + 1
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("segment_rows", [1 << 12, 16])
def test_draw_ranks_like_one_sort(spark, monkeypatch, segment_rows):
    monkeypatch.setattr(importance, "SEGMENT_ROWS", segment_rows)
    rng = random.Random(segment_rows)
    docs = [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 9)))) for i in range(500)]
    docs += [(None, "a b c d")] * 400             # a third of all rows with one score and no id
    target = ["a b c", "a a", None]
    found = importance.resampled(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                                 spark.createDataFrame([(x,) for x in target], "text string"), least_words=4, percent=60)
    assert sorted(map(tuple, found.collect()), key=str) == plain_draw(docs, target, 4, 60)


def test_draw_of_edges(edges, nothing):
    rows = importance.resampled(edges, edges, least_words=1, percent=100).collect()
    assert sorted(map(tuple, rows), key=str) == plain_draw([(r[0], r[1]) for r in EDGES], [r[1] for r in EDGES], 1, 100)
    assert importance.resampled(nothing, edges).count() == 0
    assert importance.resampled(edges, nothing).count() == len(EDGES)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in ADDRESS.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        twice = [2 * d if i % 2 else d for i, d in enumerate(reversed(digits))]
        if 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in twice) % 10 == 0:
            spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(spans)


PARTS = ["a@b.c", "@", "..", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111111111111111", "+1 (017) 555-7713",
         "+", "-", "(", ")", " ", "a", "_", "%", "12", "0", "9", "x@y", "b.d", "\n", "é"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_base_spans(parts):
    assert personal_data.base_spans("".join(parts)) == plain_spans("".join(parts))


def test_personal_data_query(spark):
    documents = dict(map(tuple, spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()))
    rows = QUERIES["op13_personal_data"](spark, FOLDER).collect()
    assert len(rows) == len(documents)
    for r in rows:
        base = plain_spans(documents[r["doc_id"]] or "")
        assert [r[c] for c in personal_data.COUNTS] == [sum(s[1] == k for s in base) for k in range(4)]
        text = personal_data.joined(base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(filter(None, r["spans"].split(",")))


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(7)
    n, labelers = 20_000, len(personal_data.LABELERS)
    truth = rng.random(n) < 0.4
    right, voting = np.linspace(0.9, 0.6, labelers), 0.7
    agrees = rng.random((n, labelers)) < right
    said = np.where(rng.random((n, labelers)) < voting, np.where(agrees == truth[:, None], 1, -1), 0)
    pattern, count = np.unique([personal_data.pattern_of(tuple(s)) for s in said.tolist()], return_counts=True)
    table, share, posterior = personal_data.reliabilities(pattern, count)
    assert share == pytest.approx(0.4, abs=0.03)
    assert table[1, :, 2] == pytest.approx(right * voting, abs=0.04)      # for, on true spans
    assert table[0, :, 0] == pytest.approx(right * voting, abs=0.04)      # against, on false spans
    of = dict(zip(pattern.tolist(), posterior))
    guessed = np.array([of[personal_data.pattern_of(tuple(s))] >= 0.5 for s in said.tolist()])
    majority = said.sum(axis=1) > 0
    assert (guessed == truth).mean() > max((majority == truth).mean(), 0.85)


def test_wider_spans_are_judged(spark):
    rng = random.Random(2)
    texts = []
    for i in range(300):
        number = "".join(rng.choice("0123456789") for _ in range(7))
        texts.append(rng.choice([
            f"Please call our phone (2{number[:2]}) 5{number[2:4]}-{number[3:]}.", f"write to anna{i} (at) mail{i % 9} (dot) com please",
            f"My name is Anna Schmidt, phone +49 30 {number}1.", f"e-mail me: joe.{i}@mail.example.org ok",
            f"order no. 555-{number[:3]}-{number[3:]} version 300 1{number[:2]} {number[2:6]} page {i} table {i} {i} {i} {i} {i} {i}"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in personal_data.personal_data(docs).collect()}
    added = {i for i, r in rows.items() if r["n_added"]}
    wanted = {i for i, t in enumerate(texts) if "(at)" in t or "My name" in t or "call our" in t}
    assert len(added & wanted) >= 0.95 * len(wanted)
    assert len({i for i in added if texts[i].startswith("order")}) <= 0.1 * len(texts) / 5


def test_personal_data_of_edges(spark, edges, nothing):
    clashing = edges.withColumnRenamed("rank", "SPANS").withColumnRenamed("ids", "found")
    rows = personal_data.personal_data(clashing).collect()
    assert len(rows) == len(EDGES) and all(r["n_email"] == 0 for r in rows)
    assert personal_data.personal_data(nothing).count() == 0
    long = spark.createDataFrame([(1, "1 " * 100_000 + "a" * 200_000 + " x@y.de"), (1, None)], "doc_id long, text string")
    assert sorted(r["spans"] for r in personal_data.personal_data(long).collect()) == ["", "email:400001:400007"]


def test_adjacent_cards_are_both_found(spark):
    text = "cards 4111111111111111 4012888888881881 end"
    assert personal_data.base_spans(text) == []
    docs = spark.createDataFrame([(i, text) for i in range(5)] + [(9, "card 4111111111111111.")], "doc_id long, text string")
    rows = personal_data.personal_data(docs).where("doc_id < 5").collect()
    assert {r["spans"] for r in rows} == {"card:6:22,card:23:39"}
