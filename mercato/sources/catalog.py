"""Derived tables written once per data directory, then read back.

The case study keeps its cleaned data as stored tables (UPDATE in place for
the delivery tables, CREATE TABLE AS for the clean sales mart). The same is
done here: a derived table is written as Parquet into the shared folder
named by ``spark.checkpoint.dir`` and later queries scan it, with filter
pushdown and partition pruning. Writing cuts the lineage, so a lost
executor costs a re-read of the written files, not a re-run of the joins.

Tables are keyed by a fingerprint of all source files (path, size, mtime)
and of the code that derives them, so a changed source or rule gets a fresh
table. A table is written under a name of its own and renamed when complete,
its schema with it: of two writers one wins, and no reader sees half a table.
An existing table is opened without planning its builder.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from mercato.session import session_key, shared_dir

# Written tables are immutable: the DataFrame reading one is reused for the
# rest of the session instead of re-analysing its builder plan.
_OPENED: dict[tuple[str, str], DataFrame] = {}
_LOCKS: dict[tuple[str, str], threading.Lock] = {}
_GUARD = threading.Lock()


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        reader.close()


def _files(fs, p) -> list[str]:
    """Every file below a path, with its size and time."""
    if not fs.exists(p):
        return []
    found, names = fs.listFiles(p, True), []
    while found.hasNext():
        st = found.next()
        names.append(f"{st.getPath()}:{st.getLen()}:{st.getModificationTime()}")
    return sorted(names)


def fingerprint(spark: SparkSession, paths: Sequence[str], rules: Sequence[str] = ()) -> str:
    """Digest of the files below ``paths`` and of the texts ``rules``."""
    h = hashlib.sha256()
    for path in sorted(paths):
        fs, p = _fs(spark, path)
        h.update("\n".join([path, *_files(fs, p)]).encode())
    for text in rules:
        h.update(text.encode())
    return h.hexdigest()[:16]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under a new name in the shared folder and read back, so
    that later jobs start from files; the lazy plan itself where no folder is named."""
    folder = shared_dir(df.sparkSession)
    if folder is None:
        return df
    path = f"{folder.rstrip('/')}/steps/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Catalog:
    """Named derived tables, materialised on first use."""

    def __init__(self, spark: SparkSession, key: str):
        self.spark = spark
        folder = shared_dir(spark)
        if folder is None:
            raise ValueError("written tables need spark.checkpoint.dir")
        self.root = f"{folder.rstrip('/')}/tables/{key}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, build: Callable[[], DataFrame],
              partition_by: Sequence[str] = ()) -> DataFrame:
        path = self.path(name)
        key = (session_key(self.spark), path)
        with _GUARD:
            lock = _LOCKS.setdefault(key, threading.Lock())
        with lock:
            if key not in _OPENED:
                schema_file = f"{path}/_mercato_schema.json"
                if _exists(self.spark, f"{path}/_SUCCESS") and _exists(self.spark, schema_file):
                    schema = StructType.fromJson(json.loads(_read_text(self.spark, schema_file)))
                else:
                    df = build()
                    schema = df.schema  # keeps types and column order on read
                    own = f"{self.root}/.{name}-{uuid.uuid4().hex}"
                    df.write.parquet(own, partitionBy=list(partition_by) or None)
                    _write_text(self.spark, f"{own}/_mercato_schema.json", schema.json())
                    fs, source = _fs(self.spark, own)
                    target = _fs(self.spark, path)[1]
                    # Where another application was first, its table stands.
                    if fs.exists(target) or not fs.rename(source, target):
                        fs.delete(source, True)
                _OPENED[key] = self.spark.read.schema(schema).parquet(path).select(*schema.names)
            return _OPENED[key]
