"""Where intermediate results are kept: the shared folder the cluster names."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="barloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, so that a lost executor cannot change it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def plain_numbers(schema: T.StructType) -> dict[str, str]:
    """Writer options that keep real numbers as they are. They seldom repeat, and a dictionary of them costs several
    times what writing them does, and its pages compress worse."""
    return {f"parquet.enable.dictionary#{f.name}": "false" for f in schema if isinstance(f.dataType, T.DoubleType)}


def settle(df: DataFrame, name: str = "settled", **options: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared folder and read that copy.

    Unlike a checkpoint, later reads take only the columns they need. Values that depend on how
    rows were dealt (row ids, range names) stay as written, whatever executor is lost later. ``options`` are
    those of the writer.
    """
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(seen: Observation, **empty) -> dict:
    """What a pass has observed; ``empty`` where Spark saw that there was no row and left the pass out."""
    try:
        return seen.get
    except Py4JJavaError:       # nothing was reported
        return empty


BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS,
                       size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` written once and measured: sent to every task if small, else joined by shuffle.

    For slim rows (a key and a number). Without it the large side of a join would be shuffled
    before Spark knows how small the other one is. Only the plan depends on the size, never the
    result. Texts count with their bytes, other columns with 16 each.
    """
    settled = settle(df, "measured")
    texts = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts),
                F.lit(16 * len(df.columns)))
    found = settled.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size")).head()
    small = found["n"] <= rows and (found["size"] or 0) <= size
    return F.broadcast(settled) if small else settled


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package; only the data source needs it."""
    package = os.path.dirname(os.path.abspath(__file__))
    archive = f"{os.path.basename(package)}.zip"
    if archive in (os.path.basename(f) for f in spark.sparkContext.listFiles):
        return
    folder = tempfile.mkdtemp(prefix="barloom-package-")
    made = shutil.make_archive(os.path.join(folder, archive.removesuffix(".zip")), "zip",
                               os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(made)
