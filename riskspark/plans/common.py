"""Shared inputs of the registered queries (whole tables, no subsets)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators.prepare import clean_llm, clean_system, flatten, prepared_logs
from ..sources.fixture import raw_logs

# Queries at sf0.01 hold ~14 rows per hour, so checked queries use hourly
# buckets (the bucket is a parameter everywhere; production default 5 min).
QUERY_BUCKET = "1 hour"
TS_FIELD = "event_ts"


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns as floor(x*10^d + 0.5)/10^d, identical in both engines."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            x = F.col(f"`{f.name}`")
            m = float(10 ** digits)
            r = F.when(F.abs(x) < F.lit(1e9), F.floor(x * m + F.lit(0.5)) / F.lit(m)).otherwise(x)
            out.append((r + F.lit(0.0)).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def flat_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(raw_logs(spark, sf_dir), TS_FIELD)


def logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(system logs with security flag, LLM logs) derived from ``events``."""
    return prepared_logs(raw_logs(spark, sf_dir), TS_FIELD)


def cleaned(spark: SparkSession, sf_dir: str, bucket: str = QUERY_BUCKET
            ) -> tuple[DataFrame, DataFrame]:
    system, llm = logs(spark, sf_dir)
    return clean_system(system, bucket), clean_llm(llm, bucket)
