"""Small helpers shared by the text operators."""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: Rows in one Arrow batch handed to Python: some texts have 100,000 characters.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ident(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text is empty.

    Every other column of the input, whatever its name, is left behind here.
    """
    return df.select(ident(id_col).alias("doc_id"),
                     F.coalesce(ident(text_col), F.lit("")).alias("text"))


def sampled(id_col: str, n: int, most: int) -> Column:
    """True for about ``most`` of ``n`` rows, by a hash of the id, however large ``n`` is:
    whole millionths by one hash, and what is left of a millionth by a second one."""
    key = ident(id_col).cast("string")
    whole, rest = divmod(min(most, max(n, 1)) * 1_000_000, max(n, 1))
    part = F.pmod(F.xxhash64(key), F.lit(1_000_000))
    fine = F.shiftrightunsigned(F.xxhash64(F.lit(1), key), 1)
    return (part < whole) | ((part == whole) & (fine < F.lit(2 ** 63 * rest // max(n, 1))))


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that a Python worker's memory has a bound."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back (lineage is cut,
    and a lost executor costs no more than its own tasks)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of at most ``most`` bytes of text (one row at least)."""
    for b in batches:
        at = b.schema.get_field_index(text)
        sizes = [len(x) if x is not None else 0 for x in _bytes(b.column(at))]
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > most:
                yield b.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < b.num_rows:
            yield b.slice(start)


def _bytes(col: pa.Array) -> list:
    import pyarrow.compute as pc
    lens = pc.binary_length(col)
    return [range(n) if n is not None else None for n in lens.to_pylist()]
