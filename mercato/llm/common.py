"""Helpers shared by the operators: session settings, scratch tables, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import uuid
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes of one Arrow batch sent to a Python worker. Documents can be
#: long, so batches are bounded by size as well as by rows.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application: they
    need not have it installed, nor the driver's working folder."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    name = Path(SparkFiles.getRootDirectory(), f"{package.name}-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(name))
    _SHIPPED.add(app)


def tune(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of the session, so that a worker holds a few
    megabytes of text at a time whatever the documents' lengths; send the
    workers this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.
    Where it is unset (tests), a folder beside the session's warehouse."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return path or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-llm"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; never used twice."""
    return f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    later jobs start from files, so a lost executor costs a reread only."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path, partitionBy=list(partition_by) or None)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def arrow_type(kind: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "binary": pa.binary(), "ints": pa.list_(pa.int32())}[kind]


def batch(schema: str, columns: Iterable[Sequence]) -> pa.RecordBatch:
    """A record batch for a schema text of plain types ("a long, b string")."""
    fields = [f.split() for f in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, arrow_type(t)) for c, (_, t) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def pieces(items: Sequence, size: int) -> Iterator[Sequence]:
    for i in range(0, len(items), size):
        yield items[i:i + size]


@contextmanager
def no_cycles():
    """No search for reference cycles meanwhile: it would walk the large memos
    of a worker again and again, and they hold none."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def tidy(batches: Iterable) -> Iterator:
    """``batches``, and at their end the worker's freed memory goes back to the
    system: workers are reused, and would hold the peak of every earlier stage."""
    try:
        yield from batches
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):      # not the GNU C library
            pass


class Cache(dict):
    """A bounded memo: ``make(key)`` fills a missing key; once ``limit`` keys
    are held all are dropped, so a worker's memory stays bounded."""

    def __init__(self, make, limit: int = 300_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")
