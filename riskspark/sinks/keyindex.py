"""Which days hold a key, and what a day holds: the side tables of a keyed table.

``<table>_index`` has, for every key, the 64-bit digest and the day (``dt``) of its row,
in buckets by the digest's low bits, and a zone for every day: its rows, its least and
greatest instant.  A merge reads the buckets of its own keys and replaces them.  A bucket
holds about ``BUCKET_ENTRIES`` at most: where one outgrows twice that, the index is dealt
anew over more buckets, and a pointer is swapped.  So what a small batch reads does not
grow with the table.  Two keys of one digest cost a day read in vain, never a row.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .published import _fs, point, pointed

#: Entries of a bucket when the index is dealt (12 bytes each before compression).
BUCKET_ENTRIES = 500_000
#: The most buckets, as a power of two: beyond 2^14 of them, buckets grow.
MAX_BITS = 14

ENTRY = "h long, dt date, bucket int"
ZONE = "n_rows long, min_ts timestamp_ntz, max_ts timestamp_ntz, dt date"


def base(table: str) -> str:
    return f"{table.rstrip('/')}_index"


def digest(key: str) -> Column:
    """The key's digest; a null key has one too."""
    return F.xxhash64(F.col(f"`{key}`"))


def _bucket(bits: int) -> Column:
    return F.col("h").bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def bits_for(entries: int, target: int | None = None) -> int:
    return min(MAX_BITS, max(0, math.ceil(math.log2(max(1, entries) / (target or BUCKET_ENTRIES)))))


def bits(spark: SparkSession, table: str) -> int | None:
    """How many low bits deal the index; None where there is no index."""
    name = pointed(spark, base(table))
    return None if name is None else int(name.split("=")[1])


def buckets_of(batch: DataFrame, key: str, n_bits: int) -> list[int]:
    """The buckets of a batch's keys (at most 2 ** MAX_BITS numbers)."""
    if n_bits == 0:
        return [0]
    rows = batch.select(digest(key).alias("h")).select(_bucket(n_bits).alias("b")).distinct()
    return sorted(r["b"] for r in rows.collect())


def entries(spark: SparkSession, table: str, n_bits: int, buckets: list[int]) -> DataFrame:
    """The entries of some buckets: other folders are not opened."""
    root = f"{base(table)}/bits={n_bits}"
    paths = [f"{root}/bucket={b}" for b in buckets]
    there = []
    for p in paths:
        path, fs = _fs(spark, p)
        if fs.exists(path):
            there.append(p)
    if not there:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).option("basePath", root).parquet(*there)


def of_rows(rows: DataFrame, key: str) -> DataFrame:
    """Entries of a table's rows."""
    return rows.select(digest(key).alias("h"), "dt").distinct()


def zones_of(rows: DataFrame, ts_col: str) -> DataFrame:
    ts = F.col(f"`{ts_col}`").cast("timestamp_ntz")
    return rows.groupBy("dt").agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def _write_entries(rows: DataFrame, n_bits: int, path: str) -> None:
    (rows.withColumn("bucket", _bucket(n_bits)).repartition("bucket").write.mode("overwrite")
     .partitionBy("bucket").parquet(path))


def ensure(spark: SparkSession, table: str, key: str, ts_col: str, schema: StructType) -> int:
    """The bits of the index of a stored table; one that has none gets it, from a scan of two columns."""
    n_bits = bits(spark, table)
    if n_bits is None:
        rows = spark.read.schema(schema).parquet(table)
        n_bits = bits_for(rows.count())
        _write_entries(of_rows(rows, key), n_bits, f"{base(table)}/bits={n_bits}")
        zones_of(rows, ts_col).write.mode("overwrite").partitionBy("dt").parquet(f"{base(table)}/zones")
        point(spark, base(table), f"bits={n_bits}")
    return n_bits


def _fresh(merged: DataFrame, batch: DataFrame, known: DataFrame, key: str, n_bits: int) -> DataFrame:
    """The entries of the batch's buckets as they will be: those of other keys stay as they are, those of the batch's
    keys are read from the merged days.  Only these are made distinct, so that a bucket is copied, not aggregated."""
    mine = batch.select(digest(key).alias("h")).distinct()
    of_mine = merged.select(digest(key).alias("h"), "dt").join(mine, "h", "left_semi").distinct()
    stay = known.select("h", "dt").join(mine, "h", "left_anti")
    return stay.unionByName(of_mine).withColumn("bucket", _bucket(n_bits)).repartition("bucket")


def stage(staging: str, merged: DataFrame, batch: DataFrame, known: DataFrame | None, key: str,
          ts_col: str, n_bits: int) -> None:
    """Write the new contents of the batch's buckets and of the merged days' zones.

    ``merged``: the rows of all days that hold keys of the batch, as they will be.
    ``known``: the entries that these buckets have now; those of the batch's keys go.
    The rows are dealt by bucket, which is bounded in size, before they are written.
    """
    if known is None:   # (the first batch: what is merged is what the batch has)
        _write_entries(of_rows(merged, key), n_bits, f"{staging}/index/bits={n_bits}")
    else:
        _fresh(merged, batch, known, key, n_bits).write.partitionBy("bucket").parquet(f"{staging}/index/bits={n_bits}")
    zones_of(merged, ts_col).coalesce(1).write.partitionBy("dt").parquet(f"{staging}/zones")


def replace(spark: SparkSession, staged: str, into: str) -> None:
    """Move the partitions of a staged folder over those of another; again, it moves what is left."""
    src, fs = _fs(spark, staged)
    dst, _ = _fs(spark, into)
    fs.mkdirs(dst)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for entry in fs.listStatus(src):
        if entry.isDirectory():
            target = Path(dst, entry.getPath().getName())
            fs.delete(target, True)
            if not fs.rename(entry.getPath(), target):
                raise OSError(f"{entry.getPath()} was not moved to {target}")


def put(spark: SparkSession, table: str, staging: str, n_bits: int) -> None:
    """Replace the staged buckets and zones; again, it changes nothing."""
    replace(spark, f"{staging}/index/bits={n_bits}", f"{base(table)}/bits={n_bits}")
    replace(spark, f"{staging}/zones", f"{base(table)}/zones")
    if bits(spark, table) is None:
        point(spark, base(table), f"bits={n_bits}")


def _may_be_large(spark: SparkSession, table: str, n_bits: int, buckets: list[int]) -> bool:
    """Whether a bucket's files could hold too many entries: a digest takes its 8 bytes."""
    for b in buckets:
        path, fs = _fs(spark, f"{base(table)}/bits={n_bits}/bucket={b}")
        if fs.exists(path) and fs.getContentSummary(path).getLength() > 8 * 2 * BUCKET_ENTRIES:
            return True
    return False


def grow(spark: SparkSession, table: str, buckets: list[int]) -> int:
    """Deal the index over more buckets if one of those just written has outgrown its size."""
    n_bits = bits(spark, table)
    if not buckets or n_bits >= MAX_BITS or not _may_be_large(spark, table, n_bits, buckets):
        return n_bits
    largest = (entries(spark, table, n_bits, buckets).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
               .agg(F.max("n")).first()[0]) or 0
    more = min(MAX_BITS, n_bits + bits_for(largest))
    if largest <= 2 * BUCKET_ENTRIES or more == n_bits:
        return n_bits
    root = base(table)
    _write_entries(spark.read.schema(ENTRY).parquet(f"{root}/bits={n_bits}").select("h", "dt"), more, f"{root}/bits={more}")
    point(spark, root, f"bits={more}")
    path, fs = _fs(spark, f"{root}/bits={n_bits}")
    fs.delete(path, True)
    return more


def zones(spark: SparkSession, table: str) -> DataFrame | None:
    """One row a day (dt, n_rows, min_ts, max_ts); None where the table has no index."""
    if pointed(spark, base(table)) is None:
        return None
    path, fs = _fs(spark, f"{base(table)}/zones")
    return spark.read.schema(ZONE).parquet(f"{base(table)}/zones") if fs.exists(path) else spark.createDataFrame([], ZONE)
