"""Sets of tables that change as one: written aside, then a pointer is swapped.

``base`` holds a folder for each version and the file ``CURRENT`` with the name of
the one that readers follow.  A version is complete before the pointer names it, and
the pointer is replaced by one rename, so that a job that ends between any two steps
leaves the version before it in place, and what it has begun is never read.  (A store
without an atomic rename of a file needs another place for the pointer.)
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def pointed(spark: SparkSession, base: str) -> str | None:
    """The name in the pointer of ``base``; None before the first publication."""
    p, fs = _fs(spark, f"{base}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def point(spark: SparkSession, base: str, name: str) -> None:
    """Make readers of ``base`` follow ``name``, in one step."""
    jvm = spark.sparkContext._jvm
    new, fs = _fs(spark, f"{base}/.{POINTER}-{uuid.uuid4().hex}")
    fs.setWriteChecksum(False)
    out = fs.create(new, True)
    out.write(name.encode())
    out.close()
    fs.setWriteChecksum(True)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), conf).rename(
        new, jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}"), options)


def publish(spark: SparkSession, base: str, tables: dict[str, DataFrame], keep: int = 2) -> str:
    """Write all tables as a new version, let readers follow it, and remove versions but the last ``keep``.

    The tables may be computed from the version before.
    """
    name = uuid.uuid4().hex
    before = pointed(spark, base)
    for table, df in tables.items():
        df.write.parquet(f"{base}/{name}/{table}")
    # Each version knows its predecessors, the latest first.
    line = [*([before] if before else []), *(_line(spark, base, before) if before else [])]
    spark.createDataFrame([(k, v) for k, v in enumerate(line[:keep - 1])], "age int, version string").write.parquet(
        f"{base}/{name}/before")
    point(spark, base, name)
    for old in line[keep - 1:]:
        p, fs = _fs(spark, f"{base}/{old}")
        fs.delete(p, True)
    return name


def _line(spark: SparkSession, base: str, version: str) -> list[str]:
    path, fs = _fs(spark, f"{base}/{version}/before")
    if not fs.exists(path):
        return []
    return [r["version"] for r in spark.read.schema("age int, version string").parquet(
        f"{base}/{version}/before").orderBy("age").collect()]  # a handful of names


def history(spark: SparkSession, base: str) -> list[str]:
    """The versions that are there: the one that readers follow, then those before it, the latest first."""
    now = pointed(spark, base)
    return [now, *_line(spark, base, now)] if now else []


def current(spark: SparkSession, base: str, table: str, schema=None) -> DataFrame | None:
    """A table of the version that readers follow; None if there is none."""
    version = pointed(spark, base)
    if version is None:
        return None
    p, fs = _fs(spark, f"{base}/{version}/{table}")
    if not fs.exists(p):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{base}/{version}/{table}")
