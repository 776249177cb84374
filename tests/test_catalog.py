"""Derived tables are written once, reopened without their builder, and
keep types and column order (also for partition columns)."""
import os
import tempfile

from pyspark.sql import functions as F

from mercato.session import shared_dir
from mercato.sources import catalog as C


def test_written_once_and_reopened(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(10).select(F.col("id").alias("k"), (F.col("id") % 3).alias("year"),
                                      F.lit("x").alias("s"))

    key = f"test-{os.getpid()}"
    cat = C.Catalog(spark, key)
    a = cat.table("t", build, partition_by=("year",))
    assert a.columns == ["k", "year", "s"] and a.schema["year"].dataType.simpleString() == "bigint"
    assert a.count() == 10
    C._OPENED.clear()  # as a later session finds the folder
    b = C.Catalog(spark, key).table("t", build, partition_by=("year",))
    assert len(calls) == 1 and b.schema == a.schema and b.count() == 10
    assert cat.path("t").startswith(shared_dir(spark).rstrip("/"))


def test_fingerprint_follows_source_files(spark):
    d = tempfile.mkdtemp(prefix="mercato-fp-")
    p = os.path.join(d, "x.parquet")
    spark.range(3).write.parquet(p)
    f1 = C.fingerprint(spark, [p])
    assert f1 == C.fingerprint(spark, [p])
    assert f1 != C.fingerprint(spark, [p], ["another rule"])
    spark.range(5).write.mode("overwrite").parquet(p)
    os.utime(p, (1, 1))
    assert C.fingerprint(spark, [p]) != f1


def test_fingerprint_follows_nested_files(spark):
    d = tempfile.mkdtemp(prefix="mercato-fp-")
    p = os.path.join(d, "x.parquet")
    spark.range(3).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(p)
    before, top = C.fingerprint(spark, [p]), os.stat(p).st_mtime_ns
    with open(os.path.join(p, "part=0", "more.parquet"), "wb") as f:
        f.write(b"x")
    assert os.stat(p).st_mtime_ns == top and C.fingerprint(spark, [p]) != before


def test_two_writers_leave_one_whole_table(spark):
    cat = C.Catalog(spark, f"writers-{os.getpid()}")

    def slow():  # while this one builds, another application finishes the table
        C._OPENED.clear()
        C._LOCKS.clear()
        C.Catalog(spark, f"writers-{os.getpid()}").table("t", lambda: spark.range(7))
        C._OPENED.clear()
        return spark.range(9)

    assert cat.table("t", slow).count() == 7
    left = [x for x in os.listdir(cat.root.removeprefix("file:")) if x.startswith(".t-") and not x.endswith(".crc")]
    assert left == []


def test_nothing_is_written_without_a_shared_folder(spark, monkeypatch):
    from mercato.plans import registry
    monkeypatch.setattr(registry, "shared_dir", lambda s: None)
    assert registry.Inputs(spark, "/root/testdata/sf0.001").catalog is None
