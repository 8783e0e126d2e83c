"""Recorded bodies: each row group is read once, whatever fails, and large ones are not held whole."""

import pickle

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from barloom.sources import requests as R


def written(folder, names, rows_per_group, body=lambda n: f"body of {n}"):
    folder.mkdir()
    for k in range(0, len(names), 40):
        part = names[k:k + 40]
        pq.write_table(pa.table({"path": part, "body": [body(n) for n in part]}), str(folder / f"part-{k:05d}.parquet"),
                       row_group_size=rows_per_group)
    return str(folder)


def counted(monkeypatch):
    """The row groups whose paths are read."""
    seen, read = [], pq.ParquetFile.read_row_group
    monkeypatch.setattr(pq.ParquetFile, "read_row_group", lambda self, i, **k: (seen.append(i), read(self, i, **k))[1])
    return seen


def test_groups_are_read_once_though_requests_fail(tmp_path, monkeypatch):
    names = [f"p{i:04d}" for i in range(120)]
    look_up = R.archived(written(tmp_path / "archive", names, 10))
    seen = counted(monkeypatch)

    def failing(paths):
        def passed():
            for path in paths:
                if int(path[1:]) % 7 == 0:
                    raise ConnectionError(path)
                yield path

        yield from look_up(passed())

    found = list(R.answers(failing, iter([*names, "p9999"])))
    assert [b for b, _ in found] == [None if i % 7 == 0 else f"body of p{i:04d}" for i in range(120)] + [None]
    assert [e is not None for _, e in found] == [i % 7 == 0 for i in range(120)] + [False]
    assert len(seen) == 12
    assert pickle.loads(pickle.dumps(look_up)).opened is None     # a task opens the archive for itself


def test_any_order_finds_the_last_of_equal_paths(tmp_path):
    names = [f"p{i % 50}" for i in range(200)]
    archive = tmp_path / "archive"
    archive.mkdir()
    for k in range(4):
        pq.write_table(pa.table({"path": names[50 * k:50 * k + 50], "body": [f"{k}-{n}" for n in names[:50]]}),
                       str(archive / f"part-{k}.parquet"), row_group_size=7)
    asked = ["p7", "p49", "none", "p0", None, "p7"]
    assert list(R.archived(str(archive))(iter(asked))) == ["3-p7", "3-p49", None, "3-p0", None, "3-p7"]


def test_large_groups_are_read_by_batches(tmp_path, monkeypatch):
    monkeypatch.setattr(R, "GROUP_BYTES", 1000)
    monkeypatch.setattr(R, "BATCH_BYTES", 1000)
    names = [f"p{i:02d}" for i in range(40)]
    archive = written(tmp_path / "archive", names, 40, lambda n: n * 100)
    group = R._Group(pq.ParquetFile(f"{archive}/part-00000.parquet"), 0, ["body"])
    assert 0 < group.batch_of(5).num_rows < 10
    order = [0, 1, 39, 3, 38, 0]
    asked = [f"{archive}/part-00000.parquet#{i}" for i in order]
    assert list(R.replay(iter(asked))) == [names[i] * 100 for i in order]


def test_waves_are_stretches_of_the_paths(spark, tmp_path):
    requests = spark.range(90).select(
        F.format_string("%02d", "id").alias("request_key"), F.lit("T").alias("ticker"), F.lit(0).alias("flag"),
        F.format_string("p%02d", "id").alias("path"))
    listed = R._dealt(requests, 2, ("path",), 3)
    spans = spark.read.parquet(listed).groupBy("wave").agg(F.min("path").alias("a"), F.max("path").alias("z")).orderBy("wave").collect()
    assert len(spans) == 3 and all(x["z"] < y["a"] for x, y in zip(spans, spans[1:]))
    ledger = str(tmp_path / "ledger")
    found = R.fetch_resumed(requests, lambda paths: (f"b{p}" for p in paths), ledger, wave_requests=30, partitions=2)
    assert {r["body"] for r in found.collect()} == {f"bp{i:02d}" for i in range(90)}


def test_nothing_to_ask_for(spark):
    none = spark.createDataFrame([], "request_key string, ticker string, flag int, path string")
    assert R.fetch(none, lambda paths: iter(paths), partitions=2).count() == 0
