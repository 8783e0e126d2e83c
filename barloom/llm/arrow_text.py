"""Texts as numpy arrays inside Arrow tasks: slices of bounded size, words, word hashes."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, types as T

from barloom.session import settle, ship_package

#: Bytes of text that one step of work holds; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 4096


#: Rows and bytes of a batch where an operator runs a job itself.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches to Python of ``BATCH_ROWS`` rows and ``BATCH_BYTES`` at most, for what runs within; the session
    has its own settings again afterwards."""
    conf, before = spark.conf, {}
    for key, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        before[key] = conf.get(key, None)
        conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def settle_texts(df: DataFrame, name: str) -> DataFrame:
    """``settle`` with small batches. A result that is returned unwritten goes by the settings of whoever writes
    it (64 MB a batch by default)."""
    with small_batches(df.sparkSession):
        return settle(df, name)


def give_back() -> None:
    """Memory that a task has used, back to the system: its worker is kept for later tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):       # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
                ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on a task's batches, with memory given back when the task ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts fill ``most`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (held + size > most or i - start >= SLICE_ROWS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The texts as an array of its own: splitting a slice of a longer array reads wrong places."""
    return pa.array([t or "" for t in batch.column(column).to_pylist()], pa.large_string())


class Words:
    """The words of some texts: ``ids`` into ``names``, and where each text's words end."""

    def __init__(self, texts: pa.Array, lower: bool = True) -> None:
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        texts = texts.cast(pa.large_string())
        pieces = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
        sizes = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pieces.flatten()
        real = pc.greater(pc.binary_length(flat), 0)  # white space at an end leaves an empty piece
        if pc.min(real).as_py() is False:
            kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            sizes = np.diff(kept[ends])
            flat = flat.filter(real)
        coded = flat.dictionary_encode()
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.names = coded.dictionary
        self.sizes = sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def hashes(self) -> np.ndarray:
        """A stable 64-bit hash of each distinct word."""
        names = self.names.to_numpy(zero_copy_only=False)
        if not len(names):
            return np.zeros(0, np.uint64)
        return pd.util.hash_array(names.astype(object), categorize=False)

    def owners(self) -> np.ndarray:
        """Which text each word belongs to."""
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scattered over all 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def with_columns_in_arrow(df: DataFrame, text_col: str, added: T.StructType,
                          work: Callable[[pa.Array], list[pa.Array]],
                          carried: list[str], most: int = SLICE_BYTES) -> DataFrame:
    """The ``carried`` columns of ``df`` and those that ``work`` makes of each slice of texts.

    An added column takes the place of a carried one of the same name.
    """
    ship_package(df.sparkSession)
    names = {f.name.lower() for f in added}
    carried = [c for c in carried if c.lower() not in names]
    fields = [df.schema[c] for c in carried]
    asked = carried + ([] if text_col in carried else [text_col])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, most):
                made = work(texts_of(part, text_col))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in carried] + made, carried + [f.name for f in added])

    return df.select(*(f"`{c}`" for c in asked)).mapInArrow(giving_back(run), T.StructType(fields + added.fields))
