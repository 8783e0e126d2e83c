"""Requests and bodies: build the request list, fetch it in parallel, land the bodies once.

The list stays a distributed table. It is written as files, and a Python data source reads each
file in one task and asks the transport for its paths. The driver sees file names only.
"""

from __future__ import annotations

import bisect
import itertools
import math
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from barloom.functions.timefns import day_bound, is_weekend
from barloom.model import ENDPOINTS
from barloom.session import new_path, observed, settle, ship_package

# A transport takes the paths of one request file, in order, and gives one body (or None) for each.
Transport = Callable[[Iterator[str]], Iterator[str | None]]

BODY_SCHEMA = "request_key string, ticker string, flag int, body string"
SOURCE_NAME = "barloom_bodies"
#: Request files per core: more than one, so that a slow file does not leave the others' cores idle.
FILES_PER_CORE = 4
ATTEMPTS = 3
#: Requests that a resumed fetch lands at once, at least.
WAVE_REQUESTS = 100_000
ERROR_CHARS = 200
#: Of recorded bodies: bytes up to which a row group is held whole, of a batch of a larger one, of the file's buffer.
GROUP_BYTES, BATCH_BYTES, BUFFER_BYTES = 32 << 20, 8 << 20, 1 << 20
#: Characters of bodies after which a batch is handed on.
BATCH_CHARS = 8 << 20


def request_grid(tickers: DataFrame, dataset: str, start: Column | None = None,
                 end: Column | None = None) -> DataFrame:
    """One row per ticker and flag: ``request_key, ticker, flag, path``.

    ``start`` and ``end`` are epoch seconds, for the datasets that are asked for by time.
    """
    endpoint = ENDPOINTS[dataset]
    flags = F.explode(F.sequence(F.lit(0), F.lit(endpoint.flags - 1)))
    path = F.lit(endpoint.path)
    for mark, value in [("{ticker}", F.col("ticker")), ("{flag}", F.col("flag")),
                        ("{start}", start), ("{end}", end)]:
        if value is not None:
            path = F.replace(path, F.lit(mark), value.cast("string"))
    return tickers.select("ticker", flags.alias("flag")).select(
        F.concat_ws("/", F.lit(dataset), "ticker", "flag").alias("request_key"),
        "ticker", "flag", path.alias("path"),
    )


def bar_requests(tickers: DataFrame, first: str, last: str, zone: str = "UTC") -> DataFrame:
    """Requests for the daily bars from midnight of one day to midnight of another."""
    return request_grid(tickers, "stock_history", day_bound(F.lit(first), zone),
                        day_bound(F.lit(last), zone))


def trade_requests(tickers: DataFrame, day: Column) -> DataFrame:
    """Requests for the trades of a session; on a weekend the last session is asked for."""
    last_session = F.when(is_weekend(day), "&headIndex=-1").otherwise("")
    return request_grid(tickers, "stock_intraday_transaction").withColumn(
        "path", F.concat("path", last_session))


def _number(name: str) -> Column:
    return F.get_json_object("body", f"$.{name}").try_cast("bigint")


def page_of(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """The requests for some pages: ``pages`` has ``request_key`` (of the first page) and ``page``."""
    path = F.replace("path", F.lit("page=0"), F.concat(F.lit("page="), F.col("page").cast("string")))
    return requests.join(pages, "request_key").select(
        F.concat_ws("/", "request_key", F.concat(F.lit("page"), "page")).alias("request_key"),
        "ticker", "flag", path.alias("path"))


def page_requests(requests: DataFrame, first_bodies: DataFrame) -> DataFrame:
    """Requests for the pages after the first one, as many as the header of its body asks for.

    ``total`` and ``size`` stand in each body; :func:`fetch_pages` goes on by itself after a body without them.
    """
    pages = F.ceil(_number("total") / F.when(_number("size") > 0, _number("size"))).cast("int")
    more = first_bodies.select("request_key", F.explode(F.when(
        pages > 1, F.sequence(F.lit(1), pages - 1))).alias("page"))
    return page_of(requests, more)


def open_ended(requests: DataFrame, bodies: DataFrame, page: int, ahead: int) -> DataFrame:
    """``(request_key, page)`` of the next ``ahead`` pages to ask for where no total says how many there are.

    Of ``bodies`` those of page ``page`` decide: one that holds as many rows as its size, or as the request's size if
    it has none, may not be the last.
    """
    number = F.regexp_extract("request_key", r"/page(\d+)$", 1)
    rows = F.json_array_length(F.get_json_object("body", "$.data"))
    full = bodies.filter(_number("total").isNull() & (F.coalesce(number.try_cast("int"), F.lit(0)) == page)).select(
        F.regexp_replace("request_key", r"/page\d+$", "").alias("request_key"), rows.alias("rows"),
        _number("size").alias("size"))
    asked = requests.select("request_key", F.regexp_extract("path", r"[?&]size=(\d+)", 1).try_cast(
        "bigint").alias("asked"))
    return full.join(asked, "request_key").filter(
        F.col("rows") >= F.coalesce(F.when(F.col("size") > 0, F.col("size")), "asked")).select(
        "request_key", F.explode(F.sequence(F.lit(page + 1), F.lit(page + ahead))).alias("page"))


def fetch_pages(requests: DataFrame, transport: Transport,
                fetched: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """The bodies of all pages. The first ones say how many there are. Where they do not, further pages are asked
    for, each time twice as many as before, until the last of them is not full: few turns, and no more
    requests in vain than there are pages.

    ``fetched`` lands a list of requests under a name of its own.
    """
    fetched = fetched or (lambda asked, name: fetch(asked, transport))
    first = latest = fetched(requests, "first")
    landed = first.unionByName(fetched(page_requests(requests, first), "counted"))
    page, ahead = 0, 1
    while True:
        asked = Observation()
        more = settle(open_ended(requests, latest, page, ahead).observe(asked, F.count(F.lit(1)).alias("n")), "more")
        if not observed(asked, n=0).get("n"):
            return landed
        latest = fetched(page_of(requests, more), f"pages-{page + 1}")
        landed = landed.unionByName(latest)
        page, ahead = page + ahead, 2 * ahead


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def read_files(paths: Iterator[str]) -> Iterator[str | None]:
    """Transport for bodies kept as one file each; a missing file gives None."""
    for path in paths:
        system, name = _filesystem(path)
        if system.get_file_info(name).type == fs.FileType.NotFound:
            yield None
            continue
        with system.open_input_stream(name) as stream:
            yield stream.read().decode("utf-8")


class _Group:
    """The rows of a row group, in batches that are read on as rows are asked for. A small group is one batch, so any
    order of its rows is as good; a large one is read again to go back."""

    def __init__(self, parquet: pq.ParquetFile, number: int, columns: list[str]):
        self.parquet, self.number, self.columns = parquet, number, columns
        group = parquet.metadata.row_group(number)
        names = [group.column(i).path_in_schema for i in range(group.num_columns)]
        held = sum(group.column(names.index(c)).total_uncompressed_size for c in columns)
        self.rows = group.num_rows if held <= GROUP_BYTES else max(1, group.num_rows * BATCH_BYTES // held)
        self._begin()

    def _begin(self) -> None:
        self.batches = self.parquet.iter_batches(max(self.rows, 1), row_groups=[self.number], columns=self.columns)
        self.first, self.batch = 0, None

    def batch_of(self, row: int) -> pa.RecordBatch:
        """The batch that holds a row, which is number ``row - self.first`` of it."""
        if row < self.first:
            self._begin()
        while self.batch is None or row >= self.first + self.batch.num_rows:
            self.first += self.batch.num_rows if self.batch is not None else 0
            self.batch = next(self.batches)
        return self.batch


def _open(system: fs.FileSystem, name: str) -> pq.ParquetFile:
    """A file that is read through a small buffer, not by whole column chunks."""
    return pq.ParquetFile(system.open_input_file(name), buffer_size=BUFFER_BYTES, pre_buffer=False)


def replay(paths: Iterator[str]) -> Iterator[str | None]:
    """Transport for recorded bodies: ``file.parquet#row``, a batch of rows in memory at a time.

    An empty path, for what was not recorded, gives None.
    """
    opened, group = None, None
    for path in paths:
        name, _, row = path.rpartition("#")
        if not name:
            yield None
            continue
        if name != opened:
            parquet = _open(*_filesystem(name))
            sizes = [parquet.metadata.row_group(i).num_rows for i in range(parquet.num_row_groups)]
            starts = [0, *itertools.accumulate(sizes)][:-1]
            opened, group = name, None
        wanted = bisect.bisect_right(starts, int(row)) - 1
        if group is None or wanted != group.number:
            group = _Group(parquet, wanted, ["body"])
        place = int(row) - starts[wanted]
        yield group.batch_of(place).column(0)[place - group.first].as_py()


class _Recorded:
    """An archive of ``path, body``, looked up path by path: the footers tell which row groups can hold a path, and
    the one read last stays in memory, so that paths in the archive's order read every group once."""

    def __init__(self, archive: str):
        self.system, folder = _filesystem(archive)
        found = self.system.get_file_info(fs.FileSelector(folder))
        self.files = sorted(f.path for f in found if f.is_file and not f.base_name.startswith(("_", ".")))
        groups = []
        for place, name in enumerate(self.files):
            footer = _open(self.system, name).metadata
            for number in range(footer.num_row_groups):
                group = footer.row_group(number)
                columns = [group.column(i) for i in range(group.num_columns)]
                told = next(c for c in columns if c.path_in_schema == "path").statistics
                if told is not None and told.has_min_max:
                    groups.append((told.min, told.max, place, number))
                elif told is None or told.null_count != group.num_rows:
                    groups.append(("", None, place, number))      # nothing is said: it may hold any path
        groups.sort(key=lambda g: g[0])
        self.groups, self.least = groups, [g[0] for g in groups]
        # the greatest path so far; None is greater than any
        self.greatest = list(itertools.accumulate(
            (g[1] for g in groups), lambda a, b: None if a is None or b is None else max(a, b)))
        self.held: tuple | None = None
        self.rows: dict[str, int] = {}
        self.bodies: _Group | None = None

    def _holds(self, place: int, number: int, path: str) -> bool:
        if self.held != (place, number):
            parquet = _open(self.system, self.files[place])
            paths = parquet.read_row_group(number, columns=["path"]).column(0).to_pylist()
            self.rows = {p: row for row, p in enumerate(paths)}
            self.bodies, self.held = _Group(parquet, number, ["body"]), (place, number)
        return path in self.rows

    def body(self, path: str | None) -> str | None:
        """The body of a path; of several the last."""
        if path is None:
            return None
        at = bisect.bisect_right(self.least, path) - 1
        near = []
        while at >= 0 and (self.greatest[at] is None or self.greatest[at] >= path):
            _, most, place, number = self.groups[at]
            if most is None or most >= path:
                near.append((place, number))
            at -= 1
        for place, number in sorted(near, reverse=True):
            if self._holds(place, number, path):
                row = self.rows[path]
                return self.bodies.batch_of(row).column(0)[row - self.bodies.first].as_py()
        return None


class _Archived:
    """A transport that opens its archive once a task, however often it is begun anew."""

    def __init__(self, archive: str):
        self.archive, self.opened = archive, None

    def __getstate__(self) -> dict:
        return {"archive": self.archive, "opened": None}

    def __call__(self, paths: Iterator[str]) -> Iterator[str | None]:
        if self.opened is None:
            self.opened = _Recorded(self.archive)
        for path in paths:
            yield self.opened.body(path)


def archived(archive: str) -> Transport:
    """Transport for recorded bodies that are looked up by the path they were asked for.

    ``archive`` is a Parquet folder with ``path`` and ``body``, in the order of ``path`` and in small row groups, so that
    a task reads the groups of its stretch of paths, each once; a path that was not recorded gives None. It asks for no
    path ahead, so a failure costs one path.
    """
    return _Archived(archive)


def recorded_requests(spark: SparkSession, archive: str) -> DataFrame:
    """The request list of an archive of bodies (``request_key, ticker, flag, body``)."""
    place = F.concat(F.col("_metadata.file_path"), F.lit("#"), F.col("_metadata.row_index"))
    return spark.read.parquet(archive).select("request_key", "ticker", "flag", place.alias("path"),
                                              "_metadata.file_path", "_metadata.row_index")


class _RequestFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


def answers(transport: Transport, paths: Iterator[str]) -> Iterator[tuple[str | None, str | None]]:
    """A body or an error for each path. After an error the transport is begun anew with the next path;
    what it had asked for ahead is asked for again, path by path."""
    waiting: deque[str] = deque()       # handed to the transport and not answered yet

    def handed() -> Iterator[str]:
        for path in paths:
            waiting.append(path)
            yield path

    while True:
        try:
            for body in transport(handed()):
                waiting.popleft()
                yield body, None
            if not waiting:
                return
            failure = RuntimeError("no answer")
        except Exception as raised:  # noqa: BLE001 - whatever a transport raises is a request's failure
            failure = raised
        if not waiting:
            raise RuntimeError("the transport failed before it took a path") from failure
        if len(waiting) == 1:
            waiting.clear()
            yield None, f"{type(failure).__name__}: {failure}"[:ERROR_CHARS]
        else:                # asked for ahead: which of them has failed shows one by one
            alone = list(waiting)
            waiting.clear()
            for path in alone:
                yield next(answers(transport, iter([path])))


class _BodyReader(DataSourceReader):
    def __init__(self, folder: str, transport: Transport, errors: bool = False):
        self.folder, self.transport, self.errors = folder, transport, errors

    def partitions(self) -> list[InputPartition]:
        system, name = _filesystem(self.folder)
        files = system.get_file_info(fs.FileSelector(name, allow_not_found=True))
        # a wave without requests has no folder
        return [_RequestFile(f.path) for f in files if f.base_name.endswith(".parquet")] or [_RequestFile("")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, _ = _filesystem(self.folder)
        requests = pq.ParquetFile(system.open_input_file(partition.path))

        def paths() -> Iterator[str]:
            for batch in requests.iter_batches(columns=["path"]):
                yield from batch.column(0).to_pylist()

        if self.errors:
            bodies = answers(self.transport, paths())
        else:
            bodies = ((body, None) for body in self.transport(paths()))
        names = ["request_key", "ticker", "flag"]
        for batch in requests.iter_batches(4096, columns=names):
            start, texts, errors, held = 0, [], [], 0
            for row in range(batch.num_rows):
                text, error = next(bodies)
                texts.append(text)
                errors.append(error)
                held += len(text or "")
                if held >= BATCH_CHARS or row == batch.num_rows - 1:
                    # bodies are never split; a batch ends with the one that fills it
                    yield pa.RecordBatch.from_arrays(
                        [*batch.slice(start, row + 1 - start).columns, pa.array(texts, pa.string()),
                         *([pa.array(errors, pa.string())] if self.errors else [])],
                        names=[*names, "body", *(["error"] if self.errors else [])])
                    start, texts, errors, held = row + 1, [], [], 0


def body_source(transport: Transport, errors: bool = False) -> type[DataSource]:
    """A data source class that fetches with ``transport``; with ``errors`` a failure is a value."""

    class BodySource(DataSource):
        @classmethod
        def name(cls) -> str:
            return SOURCE_NAME

        def schema(self) -> str:
            return BODY_SCHEMA + (", error string" if errors else "")

        def reader(self, schema) -> DataSourceReader:
            return _BodyReader(self.options["requests"], transport, errors)

    return BodySource


def _dealt(requests: DataFrame, partitions: int | None, order: tuple[str, ...], waves: int = 1) -> str:
    """A request list as files in order, ``partitions`` of them in the folder of each wave (``wave=0`` and so on)."""
    spark = requests.sparkSession
    n = partitions or FILES_PER_CORE * spark.sparkContext.defaultParallelism
    listed = new_path(spark, "requests")
    (requests.repartitionByRange(n * waves, *order)
     .withColumn("wave", F.floor(F.spark_partition_id() / n).cast("int")).sortWithinPartitions("wave", *order)
     .select("request_key", "ticker", "flag", "path", "wave").write.partitionBy("wave").parquet(listed))
    return listed


def _fetched(spark: SparkSession, listed: str, transport: Transport, errors: bool) -> DataFrame:
    """The bodies of a folder of request files, unwritten: a task fetches a file."""
    ship_package(spark)
    spark.dataSource.register(body_source(transport, errors))
    return spark.read.format(SOURCE_NAME).option("requests", listed).load()


def fetch(requests: DataFrame, transport: Transport = read_files,
          partitions: int | None = None, order: tuple[str, ...] = ("request_key",)) -> DataFrame:
    """Fetch every request once and return the landed bodies.

    One task fetches one of ``partitions`` request files, some to a core, so that slow ones even out, and a lost
    task asks again for its own file only. Everything downstream reads the landed copy.
    """
    spark, landed = requests.sparkSession, new_path(requests.sparkSession, "bodies")
    _fetched(spark, f"{_dealt(requests, partitions, order)}/wave=0", transport, False).write.parquet(landed)
    return spark.read.parquet(landed)


def _waves(requests: int, wave_requests: int) -> int:
    """The root of the number of waves of ``wave_requests``, rounded up."""
    least = -(-requests // wave_requests)
    return math.isqrt(least - 1) + 1 if least else 0


def fetch_resumed(requests: DataFrame, transport: Transport, folder: str, attempts: int = ATTEMPTS,
                  wave_requests: int = WAVE_REQUESTS, partitions: int | None = None) -> DataFrame:
    """Fetch what ``folder`` does not hold yet and return its landed bodies.

    ``folder`` belongs to one list of requests and is its ledger: a row for each answer, with the body or the error,
    appended wave by wave, so that a run that dies loses the wave it was in and no other. Waves are stretches of the
    paths in order, dealt at once, so each reads its part of an archive only. Of more than ``wave_requests`` requests,
    waves are as many as the root of what fits that size, so neither they nor their size grow as the list does. A
    request that was
    answered is never asked for again; one that failed is, up to ``attempts`` times in all, and then has no
    body. An answer of None is one. Two runs on one folder must not overlap.
    """
    spark = requests.sparkSession
    schema = BODY_SCHEMA + ", error string"
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)]
    spark.range(0).select(*nothing).write.mode("append").parquet(folder)

    def ledger() -> DataFrame:
        return spark.read.schema(schema).parquet(folder)

    for _ in range(attempts):
        tried = ledger().groupBy("request_key").agg(
            F.max(F.col("error").isNull()).alias("answered"), F.count(F.lit(1)).alias("times"))
        done = tried.filter(F.col("answered") | (F.col("times") >= attempts))
        counted = Observation()
        missing = settle(requests.join(done, "request_key", "left_anti").observe(
            counted, F.count(F.lit(1)).alias("n")), "missing")
        waves, failed = _waves(observed(counted, n=0)["n"], wave_requests), 0
        listed = _dealt(missing, partitions, ("path",), waves) if waves else None
        for number in range(waves):
            seen = Observation()
            _fetched(spark, f"{listed}/wave={number}", transport, True).observe(
                seen, F.count("error").alias("failed")).write.mode("append").parquet(folder)
            failed += observed(seen, failed=0)["failed"]
        if not failed:
            break
    answered = ledger().filter(F.col("error").isNull()).drop("error")
    if not ledger().agg(F.count("error")).head()[0]:        # then who reads the bodies reads them once
        return answered
    given_up = ledger().filter(F.col("error").isNotNull()).select("request_key", "ticker", "flag").distinct().join(
        answered.select("request_key"), "request_key", "left_anti")
    return answered.unionByName(given_up.withColumn("body", F.lit(None).cast("string")))


def fetch_recorded(spark: SparkSession, archive: str, partitions: int | None = None) -> DataFrame:
    """Replay an archive, each task reading its stretch of the files in order."""
    return fetch(recorded_requests(spark, archive), replay, partitions, ("file_path", "row_index"))
