"""Paged JSON log feed and window manifests.

A landing directory holds JSON page documents, one to a line: ``{"page": N, "data":
[record, ...]}``, many to a file (:func:`..sinks.files.land_pages`), or ``{"data":
[record, ...]}`` in folders ``page=N``, where the number comes from the path (a
directory may have both).  A file for every page would cost a folder, a listing and a
rename each, which at a hundred records outweigh the records.  Files of documents are
split by lines, so a large window is read by many tasks at once.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .. import schemas

#: Where a streamed record stands in its delivery: page number and place in the page.
POSITION = ("__page", "__place")
FILE = "__file"


#: Text of a page document that is not what the schema says.
CORRUPT = "_corrupt_record"

#: How a document of many to a file begins, also one that was cut off behind its number.
NUMBERED = r'^\{"page":(\d+)[,}]'


def page_schema() -> StructType:
    return StructType([StructField("page", IntegerType()), StructField("data", ArrayType(schemas.RAW_RECORD))])


def _documents(reader):
    """Page documents; those that cannot be read keep their text in ``CORRUPT``."""
    schema = StructType([*page_schema().fields, StructField(CORRUPT, StringType())])
    return (reader.schema(schema).option("recursiveFileLookup", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT))


def _folder() -> Column:
    """The page number of a file's folder; null where that is none of ``page=N``."""
    return F.regexp_extract("_metadata.file_path", r"/page=(\d+)/[^/]*$", 1).try_cast("int")


def _number(text: str) -> Column:
    """The page number that a document's text begins with; null where it has none."""
    return F.regexp_extract(text, NUMBERED, 1).try_cast("int")


def _pages(spark: SparkSession, path: str, max_pages: int) -> DataFrame:
    pages = _documents(spark.read).json(path)
    capped = max_pages and max_pages > 0
    if capped:   # (files of other pages' folders are not opened)
        pages = pages.where((_folder() <= F.lit(max_pages)) | _folder().isNull())
    pages = pages.select(F.coalesce(_folder(), "page", _number(CORRUPT)).alias("page"), F.col("_metadata.file_name").alias(FILE), "data", CORRUPT)
    return pages.where(F.col("page") <= F.lit(max_pages)) if capped else pages


def page_texts(spark: SparkSession, path: str) -> DataFrame:
    """(page, value): the text of every document of a landing directory."""
    return spark.read.option("recursiveFileLookup", True).text(path).select(
        F.coalesce(_folder(), _number("value")).alias("page"), "value")


def read_pages(spark: SparkSession, path: str, max_pages: int = 0, strict: bool = True
               ) -> DataFrame:
    """S1 + S2 + S3: records of every page (or the first ``max_pages``; 0 = all).

    A malformed page ends the job (``strict``, as the main path does), or has no
    rows here; :func:`bad_pages` has it then.
    """
    pages, data = _pages(spark, path, max_pages), F.col("data")
    if strict:
        stop = F.raise_error(F.concat(F.lit("malformed page document, page "), F.coalesce(F.col("page").cast("string"), F.lit("?"))))
        data = F.when(F.col(CORRUPT).isNull(), data).otherwise(stop)
    else:
        pages = pages.where(F.col(CORRUPT).isNull())
    return pages.select("page", F.explode(data).alias("r")).select("page", "r.*")


def _document() -> list:
    return [F.octet_length(CORRUPT).cast("long").alias("n_bytes"), F.col(CORRUPT).alias("document")]


def bad_pages(spark: SparkSession, path: str, max_pages: int = 0) -> DataFrame:
    """S3: (page, file, n_bytes, document) of every malformed page document.

    A document among others in its file, whose text does not begin with its number, has none here.
    """
    # (data is read too: Spark refuses a query of the corrupt column alone)
    pages = _pages(spark, path, max_pages).select("page", F.col(FILE).alias("file"), F.size("data").alias("n"), CORRUPT)
    return pages.where(F.col(CORRUPT).isNotNull() & (F.coalesce("n", F.lit(0)) >= -1)).select("page", "file", *_document())


def stream_documents(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     archive_dir: str | None = None) -> DataFrame:
    """The same landing directory as a file stream (new files = new pages): a row for every
    record, with its place, and one for a document without records or that cannot be read.

    K12: with ``archive_dir`` processed page files are moved out of the
    landing folder once committed (``cleanSource=archive``).
    """
    rs = _documents(spark.readStream)
    if max_files_per_trigger:
        rs = rs.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        rs = rs.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    page = F.coalesce(_folder(), "page", _number(CORRUPT)).cast("long")
    # The page number is found before the records are unfolded: once a document, not once a record.
    pages = rs.json(path).select(page.alias(POSITION[0]), F.col("_metadata.file_name").alias(FILE), CORRUPT, "data")
    return pages.select(POSITION[0], FILE, CORRUPT, F.posexplode_outer("data").alias(POSITION[1], "r")).select(
        POSITION[0], FILE, CORRUPT, POSITION[1], "r.*")


def records_of(documents: DataFrame) -> DataFrame:
    """The records of streamed page documents that can be read, with ``POSITION``."""
    return documents.where(F.col(CORRUPT).isNull() & F.col(POSITION[1]).isNotNull()).drop(FILE, CORRUPT)


def bad_documents(documents: DataFrame) -> DataFrame:
    """The streamed page documents that cannot be read, as in :func:`bad_pages`."""
    return documents.where(F.col(CORRUPT).isNotNull() & (F.coalesce(POSITION[1], F.lit(0)) == 0)).select(
        F.col(POSITION[0]).alias("page"), F.col(FILE).alias("file"), *_document())


def stream_pages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 archive_dir: str | None = None) -> DataFrame:
    """:func:`stream_documents` as records; malformed pages have none."""
    return records_of(stream_documents(spark, path, max_files_per_trigger, archive_dir))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per pulled window."""
    return spark.read.schema(schemas.MANIFEST).json(path)


def reconcile(manifest: DataFrame, records: DataFrame, window: str = "30 minutes",
              ts_col: str = "timestamp") -> DataFrame:
    """S4 + F12: records actually scanned per window vs the manifest, and
    whether each window differs from the previous one (the change trigger).

    The manifest has one row per window (bounded by the time span); the
    ordered ``lag`` runs over it, not over records.
    """
    from pyspark.sql import Window
    got = (records.select(F.window(ts_col, window).start.alias("ws"))
           .groupBy("ws").agg(F.count(F.lit(1)).alias("scanned")))
    m = manifest.withColumn("ws", F.col("window_start").try_cast("timestamp_ntz"))
    j = m.join(got, "ws", "left").fillna(0, subset=["scanned"])
    w = Window.orderBy("ws")
    prev = F.lag("window_start").over(w)
    return j.select(
        "window_start", "window_end", "total_pages", "total_records", "scanned",
        (F.col("scanned") == F.col("total_records")).alias("complete"),
        F.coalesce(prev != F.col("window_start"), F.lit(True)).alias("changed"))


def read_embedded_records(df: DataFrame, col: str, schema: StructType) -> DataFrame:
    """Records stored as JSON text (an array of objects per row) back as rows."""
    arr = F.from_json(F.col(col), ArrayType(schema))
    return df.select(F.inline(arr))
