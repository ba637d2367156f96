"""Keyed Parquet tables.

Bundled Parquet has no row-level MERGE, so a keyed upsert rewrites only the
date partitions that hold a batch's dates or keys: read those partitions,
merge latest-wins (one keyed aggregation), write to a staging folder by day, then
move its days over the table's: a row is written once.  A plan never reads and overwrites the same path.
The partitions that hold a batch's keys come from the key index (``keyindex``), so that a
batch reads the index buckets of its own keys and the days it changes, not the table.
The staged merge goes when the table has it: if the move ends midway, the next
merge first puts the table right from it (a table has one writer).
"""
from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..operators.merge import dedup_keep_last, upsert
from . import keyindex as IX
from .published import current, point, pointed, publish

PART = "dt"


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, table: str, schema: StructType | None = None) -> DataFrame:
    """A keyed table with its ``dt`` column; with ``schema`` also one without rows."""
    if schema is None:
        return spark.read.parquet(table)
    full = StructType([*[f for f in schema.fields if f.name != PART], StructField(PART, DateType())])
    if not exists(spark, table):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(table)


def merge_into(spark: SparkSession, table: str, new: DataFrame, key: str = "_id",
               ts_col: str = "timestamp", order: tuple[str, ...] = (), left_behind: str | None = None) -> None:
    """K1: idempotent latest-wins upsert of ``new`` into the Parquet table at ``table``.

    A key has one row afterwards, also if its date has moved: the partitions
    that hold keys of the batch are looked up in the key index, and
    rewritten together with the dates of the batch.  Within a batch the row with
    the greatest ``order`` columns (which are not stored) wins; then the one with the
    latest ``ts_col``, then the one with the greater hash, so that no partitioning
    changes the result.  A batch without rows leaves the table as it is, or
    makes an empty one.  A null key is a key.  ``left_behind``: a folder that gets the instants
    (``ts_col``) which keys of the batch have left; before the table changes, so that a retry still has them.
    """
    rank = F.struct(*[F.col(c) for c in order], F.col(ts_col),
                    F.xxhash64(*[F.col(f"`{c}`") for c in new.columns]))
    stored = [c for c in new.columns if c not in order]
    batch = dedup_keep_last(new.withColumn("__rank", rank), key, ("__rank",)).select(*stored)
    batch = batch.withColumn(PART, F.to_date(F.col(ts_col)))
    finish_pending(spark, table)
    staging = f"{_staging(table)}/{uuid.uuid4().hex}"
    buckets: list[int] = []
    try:
        there = exists(spark, table)
        # The first batch of a table is the table: it is staged by day at once, and not written again.
        if there:
            batch.write.parquet(f"{staging}/batch")
            batch = spark.read.schema(batch.schema).parquet(f"{staging}/batch")
        else:
            _by_day(batch).write.partitionBy(PART).parquet(f"{staging}/merged")
            batch = spark.read.schema(batch.schema).parquet(f"{staging}/merged").select(*batch.columns)
        # Lists of days: metadata, one value for each partition.
        days = {r[0] for r in batch.select(PART).distinct().collect()}
        if not days and there:
            return
        n_bits = IX.ensure(spark, table, key, ts_col, batch.schema) if there else IX.bits_for(batch.count())
        buckets = IX.buckets_of(batch, key, n_bits)
        held: set = set()
        merged, known = batch, None
        if there:
            known = IX.entries(spark, table, n_bits, buckets)
            mine = batch.select(IX.digest(key).alias("h"))
            held = {r[0] for r in known.join(mine, "h", "left_semi").select(PART).distinct().collect()}
            old = read_table(spark, table, batch.schema).where(_days(days | held)).select(*batch.columns)
            merged = upsert(old, batch, key)
            if left_behind and held:
                _left(old, batch, key, ts_col).write.mode("append").parquet(left_behind)
            _by_day(merged).write.partitionBy(PART).parquet(f"{staging}/merged")
            merged = spark.read.schema(batch.schema).parquet(f"{staging}/merged")
        IX.stage(staging, merged, batch, known, key, ts_col, n_bits)
        left = _day_folders(spark, f"{staging}/merged")
        # Days all of whose rows have moved to another date.  This is written last: with it the merge is whole.
        gone = {str(d) if d else None for d in held} - left
        spark.createDataFrame([(d,) for d in gone], "day string").coalesce(1).write.parquet(f"{staging}/gone")
        _put(spark, table, staging)
    finally:
        if not _whole(spark, staging):
            _delete(spark, staging)
    _delete(spark, staging)
    IX.grow(spark, table, buckets)


def _by_day(rows: DataFrame) -> DataFrame:
    """Rows of a day in few tasks (a large day's in more), so that not every task writes a file for every day."""
    return rows.hint("rebalance", PART)


def _days(days: set):
    """Partitions of these days; None is that of rows without a date."""
    known = [d for d in days if d is not None]
    touched = F.col(PART).isin(known) if known else F.lit(False)
    return touched | F.col(PART).isNull() if None in days else touched


def _day_folders(spark: SparkSession, path: str) -> set[str | None]:
    """The days that a written table has, from its folders' names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [e.getPath().getName().split("=")[1] for e in fs.listStatus(p) if e.isDirectory()]
    return {None if n == "__HIVE_DEFAULT_PARTITION__" else n for n in names}


def _left(old: DataFrame, batch: DataFrame, key: str, ts_col: str) -> DataFrame:
    """Instants of stored rows whose key now has another one."""
    now = batch.select(F.col(key).alias("__key"), F.col(ts_col).alias("__now"))
    moved = old[key].eqNullSafe(now["__key"]) & ~old[ts_col].eqNullSafe(now["__now"])
    return old.join(now, moved, "left_semi").select(ts_col).distinct()


def _staging(table: str) -> str:
    return f"{table.rstrip('/')}_staging"


def _whole(spark: SparkSession, staging: str) -> bool:
    return exists(spark, f"{staging}/gone/_SUCCESS")


def _put(spark: SparkSession, table: str, staging: str) -> None:
    """Replace the table's days by the staged merge's; again, it replaces what is left."""
    IX.replace(spark, f"{staging}/merged", table)
    for r in spark.read.schema("day string").parquet(f"{staging}/gone").collect():  # a few days
        for folder in (table, f"{IX.base(table)}/zones"):
            _delete(spark, f"{folder}/{PART}={r['day'] or '__HIVE_DEFAULT_PARTITION__'}")
    spark.catalog.refreshByPath(table)
    if exists(spark, f"{staging}/index"):
        IX.put(spark, table, staging, _staged_bits(spark, staging))


def _staged_bits(spark: SparkSession, staging: str) -> int:
    """The bits that a merge has staged its index buckets with (its one folder's name)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{staging}/index")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.listStatus(p)[0].getPath().getName().split("=")[1])


def finish_pending(spark: SparkSession, table: str) -> None:
    """Put whole merges that an earlier job has staged into the table; remove what is not whole."""
    base = _staging(table)
    if not exists(spark, base):
        return
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for entry in fs.listStatus(p):  # one, if any
        staging = f"{base}/{entry.getPath().getName()}"
        if _whole(spark, staging):
            _put(spark, table, staging)
        _delete(spark, staging)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """The rows of one micro-batch; a retry of the batch replaces them."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def append(df: DataFrame, path: str) -> None:
    """K7/K8: append-only audit tables (alert log, outbox)."""
    df.write.mode("append").parquet(path)


def save_model(spark: SparkSession, base: str, version: str, forest: DataFrame,
               baseline: DataFrame, meta: dict, **more: DataFrame) -> None:
    """Model tables (``more``: others, by name) under ``version=...`` partitions.

    Readers follow a pointer that is swapped when all tables are there.  A write
    that ended midway is overwritten by the next one of that version; a version
    that readers follow is complete and not written again.
    """
    if pointed(spark, base) == version:
        return
    rows = [(str(k), str(v)) for k, v in meta.items()]
    meta_table = spark.createDataFrame(rows, "key string, value string")
    for name, df in {"forest": forest, "baseline": baseline, **more, "meta": meta_table}.items():
        (df.withColumn("version", F.lit(version)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{base}/{name}"))
    point(spark, base, version)


def model_table(spark: SparkSession, base: str, name: str, version: str) -> DataFrame:
    """A table of one version (as text, whatever its name looks like)."""
    return spark.read.parquet(f"{base}/{name}/version={version}")


def load_latest_model(spark: SparkSession, base: str):
    """M13 + T5: forest and baseline of the version that was published last (None when absent)."""
    version = pointed(spark, base)
    if version is None:
        return None
    return version, model_table(spark, base, "forest", version), model_table(spark, base, "baseline", version)


PROGRESS = "cycle int, last_scored_until string, saved_at timestamp"


def save_progress(spark: SparkSession, path: str, cycle: int, last_scored_until, **more: DataFrame) -> None:
    """The progress (cycle, last scored instant, saved_at) and the tables that belong to it
    (``more``: the online detector's state), published as one."""
    row = spark.createDataFrame([(cycle, str(last_scored_until))], "cycle int, last_scored_until string")
    publish(spark, path, {"progress": row.withColumn("saved_at", F.current_timestamp()), **more})


def load_progress(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The last cycle and scored instant; (0, None) before the first cycle."""
    got = current(spark, path, "progress", PROGRESS)
    r = got.first() if got is not None else None
    return (r["cycle"], r["last_scored_until"]) if r else (0, None)


def drop_versions(spark: SparkSession, base: str, versions: list[str]) -> None:
    """Delete the partitions of expired model versions."""
    if not versions:
        return
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in ("forest", "baseline", "offset", "limits", "meta"):
        for v in versions:
            p = jvm.org.apache.hadoop.fs.Path(f"{base}/{name}/version={v}")
            p.getFileSystem(conf).delete(p, True)


def replay_exports(spark: SparkSession, csv_dir: str, schema, table: str,
                   key: str = "_id") -> None:
    """Re-upsert exported CSV snapshots into a keyed table (idempotent)."""
    from ..schemas import align_to
    from .files import read_csv
    merge_into(spark, table, align_to(read_csv(spark, csv_dir, schema), schema), key)


def write_embedded_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """K10 re-aimed: keep a failed batch, each record as JSON text in an array of one (read with S11)."""
    write_batch(df.select(F.to_json(F.array(F.struct(*df.columns))).alias("records")), path, batch_id)


def drain_pending(spark: SparkSession, path: str, table: str, schema: StructType, key: str = "_id") -> list[int]:
    """Upsert every pending batch, oldest first; what succeeds leaves the folder.

    Returns the ids of the batches that failed again and stay.
    """
    from ..sources.pages import read_embedded_records
    if not exists(spark, path):
        return []
    pending = spark.read.schema("records string, batch_id int").parquet(path)
    failed = []
    for b in sorted(r[0] for r in pending.select("batch_id").distinct().collect()):  # a few batches
        try:
            merge_into(spark, table, read_embedded_records(
                pending.where(F.col("batch_id") == b), "records", schema), key)
        except PySparkException:
            failed.append(b)
        else:
            _delete(spark, f"{path}/batch_id={b}")
    return failed
