"""The registered queries: against their SQL, or against plain versions of what they count."""

import collections
import hashlib
import math
import re
import zlib

import pytest

from __spark_entry__ import oracle_sql, queries
from barloom.llm.catalog import ORACLES, QUERIES
from compare import differences, duck

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@pytest.fixture(scope="module")
def documents():
    rows = duck(FOLDER).execute("select doc_id, coalesce(text, '') from documents").fetchall()
    return dict(rows)


@pytest.fixture(scope="module")
def result(spark):
    made = {}

    def of(name):
        if name not in made:
            made[name] = queries()[name](spark, FOLDER).toPandas()
        return made[name]

    return of


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(result, name):
    assert differences(result(name), duck(FOLDER).execute(ORACLES[name]).df()) == ""


def held_out(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds == 0


@pytest.mark.parametrize("name, threshold", [("op1_toxicity", 0.5), ("op7_quality", 0.3)])
def test_scores(result, documents, name, threshold):
    rows = result(name)
    assert sorted(rows.doc_id) == sorted(documents)
    assert rows.score.between(0, 1).all()
    assert (rows.predicted == (rows.score >= threshold)).all()
    assert list(rows.held_out) == [held_out(i, 5) for i in rows.doc_id]


def test_language_model_base(result, documents):
    tokens = {i: [*WORD.findall(lower(t)), None] for i, t in documents.items()}
    counts = collections.Counter()
    for i, own in tokens.items():
        if not held_out(i, 10):
            counts.update(own)
    n, v = sum(counts.values()), len(counts)
    rows = result("op4_language_model").set_index("doc_id")
    assert len(rows) == len(documents) and (rows.train_tokens == n).all()
    for i, own in tokens.items():
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        assert rows.base_score[i] == pytest.approx(base, rel=1e-9)
        assert rows.n_tokens[i] == len(own)
        assert rows.n_known[i] == sum(counts[t] > 0 for t in own)
    held = rows[rows.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_packing_holds_all_tokens(result, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = result("op6_packing")
    for i, own in rows.groupby("doc_id"):
        ids = tokenizer.encode(documents[i], add_special_tokens=False).ids + [2]
        own = own.sort_values("piece")
        assert list(own.start) == [0, *own.length.cumsum()[:-1]] and own.length.sum() == len(ids)
        assert (own.length[1:] == 1024).all()
        for start, length, crc in zip(own.start, own.length, own.ids_crc32):
            raw = b"".join(t.to_bytes(4, "little") for t in ids[start:start + length])
            assert zlib.crc32(raw) == crc
    for _, own in rows.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert list(own.offset) == [0, *own.length.cumsum()[:-1]] and own.length.sum() <= 1024
    assert rows.sequence_id.nunique() <= math.ceil(rows.length.sum() / 1024) + 2


def test_quality_counts(result, documents):
    rows = result("op8_quality_rules").set_index("doc_id")
    for i, text in documents.items():
        words = WORD.findall(text)
        windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
        often = collections.Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        own = rows.loc[i]
        assert (own.n_words, own.word_chars) == (len(words), sum(map(len, words)))
        assert own.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert own.n_dup_lines == len(lines) - len(set(lines))
        assert own.n_repeat_words == len(covered)
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        assert own.base_failed == failed and not (failed and own.kept)


def test_secrets_base(result, documents):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|"""
                        r"""[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
                        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    rows = result("op9_secrets").set_index("doc_id")
    for i, text in documents.items():
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
                  if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        text_of = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert rows.base_sha256[i] == hashlib.sha256(text_of.encode()).hexdigest()
        assert set(filter(None, text_of.split(","))) <= set(rows.spans[i].split(","))


def sets_of_shingles(documents):
    found = {}
    for i, text in documents.items():
        words = WORD.findall(lower(text))
        found[i] = ({tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5
                    else {tuple(words)} if words else set())
    return found


def test_near_duplicates_lose_no_link(result, documents):
    sets, rows = sets_of_shingles(documents), result("op10_near_duplicates").set_index("doc_id")
    assert len(rows) == len(documents) and (rows.groupby("class_id").kept.sum() == 1).all()
    ids, linked = sorted(sets), set()
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and both / len(sets[a] | sets[b]) >= 0.8:
                assert rows.class_id[a] == rows.class_id[b]
                linked |= {a, b}
    assert set(rows[rows.class_size > 1].index) == linked     # and joins nothing else


def test_pipeline(spark, result, documents):
    rows = result("pipeline")
    assert set(rows.doc_id) <= set(documents) and len(rows) > 0
    copies = rows[rows.piece == 0].groupby("doc_id").size()
    assert copies.max() <= 3
    sets = sets_of_shingles({i: documents[i] for i in set(rows.doc_id)})
    texts = collections.Counter(lower(documents[i]) for i in set(rows.doc_id))
    assert max(texts.values()) == 1
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            assert not both or both / len(sets[a] | sets[b]) < 0.8
