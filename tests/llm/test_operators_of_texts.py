"""Parts of the operators against plain versions, and inputs at the edge."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

import corpus_pipeline
from barloom.llm import (
    document_stats, exact_dedup, language_model, mixing, near_dedup, packing, quality_classifier,
    quality_rules, secrets_scan, toxicity, url_filter)
from barloom.llm.arrow_text import Words, slices, texts_of
from barloom.llm.catalog import byte_bpe
from barloom.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, score double"
LONG = " ".join(f"w{k % 997}x{k % 89}" for k in range(30_000))
EDGES = [(1, None, None, None, None, 1, None), (2, "", "en", "a", 0, 1, 0.5), (3, "  \n\t ", "en", "a", 5, 1, 0.5),
         (4, LONG, "en", "b", len(LONG), 2, 0.1), (5, LONG.upper(), "en", "b", len(LONG), 2, 0.1),
         (5, LONG.upper(), "en", "b", len(LONG), 2, 0.1), (6, "one two three four five six", "en", None, 9, 3, 0.0),
         (7, "One Two Three four five six", "en", None, 9, 3, 0.0), (None, "no id here at all", "fr", "c", 1, 1, 0.0),
         (8, "idiot", "en", "c", 5, 1, 0.0)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 0, 1), (8, 0, 1), (7, 1, 0), (7, None, None), (None, 1, 1)],
                                 "doc_id long, quality int, toxic int")


def operators(labels):
    described = quality_classifier.with_statistics
    return {
        "toxicity": lambda d: toxicity.with_scores(d, toxicity.fit(d, labels)),
        "exact": exact_dedup.exact_groups, "language": language_model.scored, "mix": mixing.mixed,
        "pack": lambda d: packing.packed(d, byte_bpe()),
        "quality": lambda d: quality_classifier.with_scores(
            described(d), quality_classifier.fit(described(d), labels)),
        "rules": lambda d: quality_rules.judged(
            quality_rules.counted(d), quality_rules.fit(quality_rules.counted(d), labels)),
        "secrets": secrets_scan.with_secrets,
        "near": near_dedup.near_duplicates}


NAMES = ["toxicity", "exact", "language", "mix", "pack", "quality", "rules", "secrets", "near"]


@pytest.mark.parametrize("name", NAMES)
def test_edges(edges, labels, name):
    rows = operators(labels)[name](edges).collect()
    if name != "pack":
        assert len(rows) == len(EDGES)
    else:
        assert sum(r["piece"] == 0 for r in rows) == len(EDGES)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(nothing, labels, name):
    assert operators(labels)[name](nothing).count() == 0


def test_edges_of_groups(edges):
    rows = {(r["doc_id"], r["kept"]): r for r in exact_dedup.exact_groups(edges, block_chars=64).collect()}
    assert rows[2, True]["group_size"] == 2 and rows[1, False]["keep_id"] == 2
    assert rows[5, True]["group_size"] == 3 and rows[4, False]["keep_id"] == 5
    assert rows[None, True]["group_size"] == 1
    near = near_dedup.near_duplicates(edges).groupBy("class_id").agg(F.sum(F.col("kept").cast("int")))
    assert all(r[1] == 1 for r in near.where("class_id is not null").collect() if r[0] not in (1, 2, 3))


def test_stages_keep_columns(spark, edges, tmp_path):
    edges.sparkSession.createDataFrame([(6, 0, 1), (7, 1, 0)], "doc_id long, quality int, toxic int"
                                       ).write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edges, str(tmp_path)).columns == edges.columns, name


def test_block_naming_tells_texts_apart(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 3, 8, 9, 17]))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for probe in (0, 2):
        for r in exact_dedup.exact_groups(df, block_chars=3, probe_chars=probe).collect():
            same = [i for i, t in enumerate(texts) if t == texts[r["doc_id"]]]
            assert (r["keep_id"], r["group_size"]) == (max(same), len(same))


@pytest.mark.parametrize("probe", [0, 2])
def test_texts_are_equal_as_they_are_normalised(spark, probe):
    df = spark.createDataFrame(enumerate(["abc", " abc ", "abc  d", "abd", "  abd"]), "doc_id long, text string")
    rows = exact_dedup.exact_groups(df, normalise=F.trim, probe_chars=probe).collect()
    assert {r["doc_id"]: r["keep_id"] for r in rows} == {0: 1, 1: 1, 2: 2, 3: 4, 4: 4}


def test_hot_blocks_and_texts_are_named_apart(spark):
    """Of 5,000 rows more than a thousandth share a block or a whole text; two rows share each of the others."""
    texts = ["hot text"] * 2000 + ["hotblock" + str(k // 2) for k in range(2000)] + [f"own {k // 2}" for k in range(1000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = exact_dedup.exact_groups(df, block_chars=8).collect()
    assert {r["doc_id"]: r["group_size"] for r in rows} == {i: 2000 if i < 2000 else 2 for i in range(5000)}
    assert {r["keep_id"] for r in rows} == {1999, *range(2001, 5000, 2)}
    assert exact_dedup.deduplicate(df, block_chars=8).count() == 1 + 1000 + 500


def test_targets_are_filled_by_weight(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 0), ("d", 90)], "source string, size long")
    rows = {r["source"]: r for r in mixing.source_targets(sizes).collect()}
    assert sum(r["target"] for r in rows.values()) == pytest.approx(1600)
    assert rows["a"]["target"] == 30 and rows[None]["target"] == 0 and rows["d"]["target"] == 270
    free = [rows["b"]["target"] / 2, rows["c"]["target"] / 1]
    assert free[0] == pytest.approx(free[1])


def test_mix_repeats_rows(spark):
    df = spark.createDataFrame([(i, "w " * 10, "s") for i in range(50)], "doc_id long, text string, source string")
    assert mixing.mix(df).count() == 50        # one source: its target is its size


def test_slices_split_like_whole_texts():
    texts = [f"A b{k}  c\n d{k} " * (k % 7) for k in range(9000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    at = 0
    for part in slices(batch, "text"):
        words = Words(texts_of(part, "text"))
        names = words.names.to_pylist()
        for a, b in zip(words.starts[:-1], words.starts[1:]):
            assert [names[k] for k in words.ids[a:b]] == texts[at].lower().split()
            at += 1
    assert at == len(texts)


def plain_probability_jaccard(a, b):
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in set(a) | set(b))
               for d in set(a) & set(b))


@settings(max_examples=60, deadline=None)
@given(*[st.dictionaries(st.integers(0, 12), st.integers(1, 5), min_size=1)] * 2)
def test_probability_jaccard(a, b):
    def arrays(x):
        keys = sorted(x)
        return np.array(keys, np.uint64), near_dedup.weights_of(np.array([x[k] for k in keys]))

    weights = [{k: 1 + math.log(v) for k, v in x.items()} for x in (a, b)]
    found, plain = near_dedup.similarities(*arrays(a), *arrays(b))
    assert found == pytest.approx(plain_probability_jaccard(*weights))
    assert plain == pytest.approx(len(set(a) & set(b)) / len(set(a) | set(b)))


def test_signatures_estimate_it():
    a = {k: 1 + k % 3 for k in range(200)}
    b = {k: 1 + k % 2 for k in range(60, 240)}
    owner = np.repeat([0, 1], [len(a), len(b)])
    values = np.array([*a, *b], np.uint64)
    weight = np.array([*a.values(), *b.values()], float)
    signed = near_dedup.signatures(owner, values, weight, 2, 4000)
    assert (signed[0] == signed[1]).mean() == pytest.approx(plain_probability_jaccard(a, b), abs=0.03)


def test_blocks_give_the_links_of_all_pairs():
    import pandas as pd

    rng = random.Random(3)
    base = [rng.sample(range(10_000), 40) for _ in range(4)]
    sets = [sorted({*(b[:rng.randint(30, 40)]), *rng.sample(range(10_000), 3)}) for b in base for _ in range(15)]
    frame = pd.DataFrame({"own": [k % 2 for k in range(60)], "text": range(60), "component": range(60),
                          "shingles": [near_dedup.pack48(np.array(s, np.uint64)) for s in sets], "times": b""})
    found = set()
    for i, j in ((0, 0), (0, 1), (1, 1)):
        part = frame[frame.own.isin([i, j])].reset_index(drop=True)
        found |= {frozenset(x) for x in near_dedup._links_of_blocks(part, i, j, 0.8).itertuples(index=False)}
    wanted = {frozenset((x, y)) for x in range(60) for y in range(x)
              if len(set(sets[x]) & set(sets[y])) / len(set(sets[x]) | set(sets[y])) >= 0.8}
    assert found == wanted


def test_a_passage_repeated_on_one_side_hides_no_link(spark):
    rows = []
    for pair in range(4):       # plain Jaccard 0.81, probability Jaccard 0.42
        shared = [f"s{pair}x{k}" for k in range(824)]
        own = [f"o{pair}x{k}" for k in range(180)]
        rows += [(2 * pair, " ".join(shared)), (2 * pair + 1, " ".join(shared + own * 200))]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == {k: k - k % 2 for k in range(8)}


def test_texts_without_repeats_have_one_signature():
    once, twice = " ".join(f"a{k}" for k in range(50)), " ".join(f"a{k % 40}" for k in range(90))
    columns = near_dedup.sketch(pa.array([once, twice, ""]), 5, 24, 5)
    assert columns[5].is_null().to_pylist() == [True, False, True]
    assert len(columns[-1][0]) == 24 and 24 < len(columns[-1][1]) <= 48 and len(columns[-1][2]) == 0


def test_larger_buckets_are_compared_one_by_one(spark):
    n = near_dedup.CROWD + 8
    members = [(1, k) for k in range(n)] + [(2, k) for k in range(n)] + [(3, n - 1 + k) for k in range(n)]
    df = spark.createDataFrame([(*x, x[1]) for x in members], "bucket long, text long, component long")
    found = near_dedup._crowds(df).groupBy("crowd").agg(F.collect_set("text").alias("texts")).collect()
    assert {r["crowd"]: sorted(r["texts"]) for r in found} == {
        1: list(range(n)), 3: list(range(n - 1, 2 * n - 1))}


def test_blocks_of_short_texts_are_bounded(spark):
    n = 3 * near_dedup.BLOCK_TEXTS
    crowds = spark.range(n).select(F.lit(7).alias("crowd"), F.col("id").alias("text"), F.col("id").alias("component"))
    held = crowds.select("text", F.lit(bytes(12)).alias("shingles"), F.lit(b"").alias("times"))
    dealt = near_dedup._dealt(crowds, held)
    most = dealt.groupBy("crowd", "i", "j").count().agg(F.max("count")).head()[0]
    assert most <= 2.4 * near_dedup.BLOCK_TEXTS
    met = dealt.groupBy("text").count().agg(F.min("count"), F.max("count"), F.count("text")).head()
    assert tuple(met) == (3, 3, n)


def test_a_pair_of_blocks_fits_a_task():
    import pandas as pd
    import tracemalloc

    n = 2 * near_dedup.BLOCK_TEXTS
    frame = pd.DataFrame({"own": [k % 2 for k in range(n)], "text": range(n), "component": range(n), "times": b"",
                          "shingles": [near_dedup.pack48(np.array([1, 2 + k // 2], np.uint64)) for k in range(n)]})
    tracemalloc.start()
    found = near_dedup._links_of_blocks(frame, 0, 1, 0.8)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == n // 2 and most < 120e6


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 340)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    df = components(spark.createDataFrame(links, "a long, b long"))
    found = {r["node"]: r["component"] for r in df.collect()}
    assert found == {x: root(x) for a, b in links for x in (a, b) if a != b or x in found}


def test_nearest_are_exact():
    rng = np.random.default_rng(0)
    vectors = np.where(rng.random((700, 40)) < 0.15, rng.random((700, 40)), 0)
    vectors[:, -1] = 0.3
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    index, order = toxicity.BlockMaxIndex.build(vectors)
    _, found = index.nearest(vectors[:50], 10)
    wanted = -np.sort(-(vectors[:50] @ vectors.T), axis=1)[:, :10]
    assert np.allclose(found, wanted, atol=1e-5)


def test_trees_obey_their_constraints():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = (rng.random(3000) < 0.2 + 0.6 * x[:, 1] - 0.3 * np.sin(9 * x[:, 0])).astype(int)
    trees = quality_rules.boost(x, y, np.ones(3000), falling=("a",), names=("a", "b", "c"))
    grid = np.repeat(rng.random((40, 3)), 50, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 50), 40)
    assert (np.diff(trees.margins(grid).reshape(40, 50), axis=1) <= 1e-9).all()


def test_density_is_that_of_the_gaussian():
    rng = np.random.default_rng(2)
    c = np.cov(rng.random((50, 4)).T) + np.eye(4)
    g = quality_classifier.Gaussian.of(np.arange(4.0), c, 0.3)
    x = rng.random(4)
    wanted = (math.log(0.3) - 0.5 * math.log(np.linalg.det(c))
              - 0.5 * (x - np.arange(4)) @ np.linalg.inv(c) @ (x - np.arange(4)))
    assert g.log_density(x[None])[0] == pytest.approx(wanted)


def test_mixture_weights_find_the_mixture():
    bins = np.array([[3, 0, 40, 700], [3, -1, 8, 300], [5, -1, 8, 10]])
    w = language_model.mixture_weights(bins, 1e-6)
    assert w.sum(axis=1) == pytest.approx(np.ones(64)) and 0.68 < w[3, 0] < 0.72 and w[5, 0] < 0.1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2 ** 63), min_size=0, max_size=50, unique=True))
def test_gaps_round_trip(values):
    keys = np.sort(np.array(values, np.uint64))
    assert (language_model._keys_of(language_model._gaps(keys)) == keys).all()


@pytest.mark.parametrize("value, least, most", [
    ("password", 0, 2), ("aaaaaaaaaaaa", 5, 12), ("qwertyuiop", 3, 14), ("2019-04-12", 10, 18),
    ("x7$Kq2!vZp9", 40, 80), ("p4ssw0rd", 1, 6)])
def test_guess_bits(value, least, most):
    assert least <= secrets_scan.guess_bits(value, secrets_scan.ranks_of([])) <= most


def test_guessed_values_need_a_place_and_a_price():
    text = 'the pwd is x7$Kq2!vZp9w, ftp://bob:Tr0ub4dor&3xQz@host and pwd: password1'
    spans = secrets_scan.guessed_spans(text, secrets_scan.ranks_of([]), [])
    assert [text[s:e] for s, _, e in spans] == ["x7$Kq2!vZp9w", "Tr0ub4dor&3xQz"]


@pytest.mark.parametrize("text, value", [
    ("pwd: kqzvxwjhptrmbnlcgdys", "kqzvxwjhptrmbnlcgdys"), ("the pwd is kqzvxwjhptrmbnlcgdys.", "kqzvxwjhptrmbnlcgdys"),
    ("auth: 839205716483920571648392057164", "839205716483920571648392057164"),
    ("pwd: \u044f\u0436\u0449\u0444\u044e", "\u044f\u0436\u0449\u0444\u044e"),
    ("credentials_for_the_production_db = x7$Kq2!vZp9w", "x7$Kq2!vZp9w"),
    ("pwd-is x7$Kq2!vZp9w", "x7$Kq2!vZp9w"), ("api key: x7$Kq2!vZp9w", "x7$Kq2!vZp9w"),
    ("the secret is understatements.", None), ("pwd: password", None), ("auth: 12345678901234567890", None),
    ("pass" * 20_000, None)])
def test_price_alone_decides_on_values_in_their_place(text, value):
    spans = secrets_scan.guessed_spans(text, secrets_scan.ranks_of([]), [])
    assert [text[s:e] for s, _, e in spans] == ([value] if value else [])


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://WWW.Example.com/en/1?q", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    ("http://badexample.com/en/x", "badexample.com", "/en/x", "com/", "allow"),
    ("http://x.com", "x.com", "", None, "allow"), (None, "", "", None, "allow"), ("x.net/es/", "", "", None, "allow"),
    ("a://b://c.net/es/", "b:", "//c.net/es/", None, "allow"), ("h://s.net/fr/#a", "s.net", "/fr/", "net/fr/", "block")])
def test_url_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, 2)], "page_id long, url string, host int")
    row = url_filter.judged_urls(pages).head()
    assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, rule, verdict)


def test_templates_learn_from_their_labelled_pages(spark):
    rows = [("h", f"/x/{k}", 1) for k in range(30)] + [("h", "/x/9", None), ("h", "/y/1", None)]
    df = spark.createDataFrame(rows, "host string, path string, bad int").withColumn(
        "lexical", url_filter.lexical_template(F.col("path")))
    found = {r["lexical"]: r["rejected"] for r in url_filter.templates(df).collect()}
    assert found == {"/x/*": True, "/y/*": True}          # nothing but the host's other pages speaks for /y


def judged(spark, rows):
    df = spark.createDataFrame(rows, "host string, path string, bad int").withColumn(
        "lexical", url_filter.lexical_template(F.col("path")))
    return {(r["host"], r["lexical"]): r for r in url_filter.templates(df).collect()}


def test_too_few_labels_are_judged_by_the_nearest_ancestor(spark):
    rows = [("bad", f"/es/p{'x' * k}", 1) for k in range(6)] + [("bad", "/en/some", None), ("bad", "", None)]
    rows += [("mixed", f"/es/p{'x' * k}", 1) for k in range(6)] + [("mixed", f"/en/p{'x' * k}", 0) for k in range(6)]
    rows += [("mixed", "/es/other", None), ("mixed", "/en/other", None), ("mixed", "/fr/other", None)]
    rows += [("good", f"/a/p{'x' * k}", 0) for k in range(6)] + [("good", "/b", None), ("few", "/a", 1), ("few", "/b", None)]
    found = judged(spark, rows)
    told = {key: (r["judged_by"], r["rejected"]) for key, r in found.items()}
    assert told["bad", "/en/some"] == ("", True) and told["bad", ""] == ("", True)
    assert told["mixed", "/es/other"] == ("/es", True) and told["mixed", "/en/other"] == ("/en", False)
    assert told["mixed", "/fr/other"] == ("", False)             # half of the host is good
    assert told["good", "/b"] == ("", False) and told["few", "/b"] == (None, None)


def test_deep_slugs_are_one_template(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [("h", f"/es/2019/05/x/slug{c}", 1 if k < 6 else None) for k, c in enumerate(letters)]
    rows += [("h", f"/es/2019/05/good/text{c}", 0) for c in letters[:8]]
    found = judged(spark, rows)
    assert found["h", "/es/*/*/x/slugz"]["template"] == "/es/*/*/x/*" and found["h", "/es/*/*/x/slugz"]["rejected"]
    assert not found["h", "/es/*/*/good/texta"]["rejected"]


def test_urls_at_the_edge(spark):
    rows = [(1, None, 1), (1, "http://x.net/es/" + "a/" * 300, 1), (2, "", None), (None, "://", 3), (3, "http://h" + "/" * 50, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, template long")
    assert len(url_filter.judged_urls(pages).collect()) == 5
    assert url_filter.judged_urls(pages.limit(0)).count() == 0


def test_statistics_of_nothing():
    counted = document_stats.count(pa.array(["", " ", "a"], pa.large_string()))
    assert counted.n_words.tolist() == [0, 0, 1] and np.isfinite(counted.statistics).all()


def test_pieces():
    assert packing.cut(1024) == [(0, 1024)] and packing.cut(1025) == [(0, 1), (1, 1024)]
    assert packing.cut(2048) == [(0, 1024), (1024, 1024)] and packing.cut(7) == [(0, 7)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(1, 1023), min_size=1, max_size=120))
def test_evolved_bins_hold_each_item_once(sizes):
    bins = packing.evolve(sizes, [], 1)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 1024 for b in bins)
    assert len(bins) <= len(packing.best_fit(sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)), sizes, []))


def test_no_python_in_native_plans(spark):
    from __spark_entry__ import queries

    for name in ("op2_url_filter", "op3_exact_dedup", "op5_source_mix"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow")), name
        assert "Cartesian" not in plan and "NestedLoop" not in plan
