"""The pipeline on tables at the edge."""

import pytest

import corpus_pipeline
from barloom.llm import near_dedup, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, row long, carried int"
TEXT = "these are some plain words of a text that says nothing bad about anyone at all and goes on"


@pytest.fixture
def folder(spark, tmp_path):
    def made(documents, labels):
        spark.createDataFrame(documents, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        return str(tmp_path)

    return made


def rows(n):
    return [(i, f"{TEXT} {i} " + " ".join(f"own{i}x{k}" for k in range(20)), "en", f"s{i % 2}", 9, "d", 1, 2) for i in range(n)]


@pytest.mark.parametrize("labels", [[], [(1, 1, 1), (2, 0, 1)], [(1, 1, 0)], [(None, 1, 1), (1, None, None)]])
def test_without_both_classes_nothing_is_lost(spark, folder, labels):
    place = folder(rows(6), labels)
    docs = spark.read.parquet(f"{place}/documents.parquet")
    assert corpus_pipeline.reject_toxic(spark, docs, place).count() == 6


def test_no_documents(spark, folder):
    place = folder([], [(1, 1, 1), (2, 0, 0)])
    assert corpus_pipeline.run(spark, place).count() == 0


def test_nulls_ties_and_clashing_names(spark, folder):
    odd = [(None, None, None, None, None, None, None, None), (7, "", "en", "s0", 0, "d", 1, 2), (7, None, "en", None, 0, "d", 1, 2),
           (8, rows(1)[0][1], "en", "s0", 0, "d", 1, 2), (8, rows(1)[0][1].upper(), "en", "s0", 0, "d", 1, 2)]
    place = folder(rows(4) + odd, [(1, 1, 1), (2, 0, 0), (3, 0, 0)])
    docs = spark.read.parquet(f"{place}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, place)
        assert kept.columns == docs.columns, name
        kept.collect()
    packed = corpus_pipeline.run(spark, place)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_toxic_rows_leave_with_all_rows_of_their_text(spark, folder):
    words = ["idiot", "moron", "stupid", "trash"]
    bad = [(100 + i, f"{words[i % 4]} you {words[(i + 1) % 4]} are {words[(i + 2) % 4]} " * 3 + f"own{i}", "en", "s", 1, "d", 1, 2)
           for i in range(40)]
    place = folder(rows(40) + bad + bad[:5], [(r[0], 1, 0) for r in rows(40)] + [(r[0], 0, 1) for r in bad])
    docs = spark.read.parquet(f"{place}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.reject_toxic(spark, docs, place).collect()}
    assert kept == {r[0] for r in rows(40)}
    model = toxicity.fit(docs, spark.read.parquet(f"{place}/labels.parquet"))
    assert toxicity.with_scores(docs, model, carried=["doc_id"]).columns == ["doc_id", "toxic_score", "evidence"]


def test_settings_of_the_session_stay(spark):
    keys = [f"spark.sql.execution.arrow.{k}" for k in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(k) for k in keys]
    df = spark.createDataFrame([(r[0], r[1]) for r in rows(5)], "doc_id long, text string")
    assert near_dedup.without_near_duplicates(df).count() == 5
    assert [spark.conf.get(k) for k in keys] == before


def test_components_go_on_from_an_earlier_result(spark, monkeypatch):
    from barloom.llm import components as module
    from barloom.llm.near_dedup import _joined

    plans, settle = [], module.settle

    def noted(df, name="settled", **options):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return settle(df, name, **options)

    monkeypatch.setattr(module, "settle", noted)
    first = [(2, 1), (3, 2), (9, 8), (12, 11), (13, 12), (14, 11)]
    then = [(8, 3), (20, 14), (31, 30)]
    schema = "a long, b long"
    joined = _joined(None, spark.createDataFrame(first, schema))
    assert all("SortMergeJoin" not in plan for _, plan in plans)      # few links are not shuffled to be joined
    assert _joined(joined, spark.createDataFrame([], schema)) is joined
    found = {r["node"]: r["component"] for r in _joined(joined, spark.createDataFrame(then, schema)).collect()}
    whole = {r["node"]: r["component"] for r in module.components(spark.createDataFrame(first + then, schema)).collect()}
    assert found == whole == {**dict.fromkeys((1, 2, 3, 8, 9), 1), **dict.fromkeys((11, 12, 13, 14, 20), 11), 30: 30, 31: 30}
