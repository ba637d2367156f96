"""File sinks: CSV export snapshots (K5) and JSON landing pages (test/replay feed)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header; written by the executors, one file per partition."""
    (df.write.mode(mode).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
     .csv(path))


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with header read with an explicit schema (no inference pass)."""
    return (spark.read.schema(schema).option("header", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
            .csv(path))


def export_splits(records: DataFrame, base: str, stamp: str) -> dict:
    """K5: three-way export (all / LLM / system) under one time-stamped folder."""
    from ..operators.prepare import split_by_prefix
    llm, system = split_by_prefix(records)
    out = {"all": f"{base}/{stamp}/all", "llm": f"{base}/{stamp}/llm",
           "system": f"{base}/{stamp}/system"}
    export_csv(records, out["all"])
    export_csv(llm, out["llm"])
    export_csv(system, out["system"])
    return out


def land_pages(records: DataFrame, path: str, page_col: str = "page") -> None:
    """Write records as paged feed documents ``{"page": N, "data": [...]}``, one to a line.

    Pages are bounded (page size is fixed by the producer), so collecting one
    page's records into an array is bounded too.  Files hold the pages of a task: their
    number does not grow with that of pages.  Timestamps are written as
    ISO text with a ``Z`` suffix, the way the feed delivers them.
    """
    fields = [c for c in records.columns if c != page_col]
    conv = [F.date_format(F.col(c), TS_FORMAT + "'Z'").alias(c)
            if records.schema[c].dataType.simpleString().startswith("timestamp")
            else F.col(f"`{c}`") for c in fields]
    # Dealt by page first: a partial aggregate would sort every row and merge none, and one stage that derives records
    # and also makes documents of them is a method too long for the JVM to compile.
    pages = (records.repartition(page_col).select(F.col(page_col).alias("page"), F.struct(*conv).alias("r"))
             .groupBy("page").agg(F.collect_list("r").alias("data")))
    pages.write.mode("overwrite").json(path)
