"""Combining the two detectors."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_flags(forest: DataFrame, online: DataFrame, keys: list[str] | None = None
                  ) -> DataFrame:
    """Full outer join of two (keys, bucket, flag) tables.

    both -> HIGH (intersection, U1), one side -> IFOREST_ONLY / HST_ONLY
    (the two differences, U2), any -> the union (U3); ``hst_confirmed`` is
    the membership flag of J6.  The online side must already be gated by its
    warm-up (R12: gated on both uses).
    """
    k = [*(keys or []), "bucket"]
    j = (forest.select(*k, F.col("flag").alias("if_flag"))
         .join(online.select(*k, F.col("flag").alias("hst_flag")), k, "full_outer"))
    i = F.coalesce(F.col("if_flag"), F.lit(False))
    h = F.coalesce(F.col("hst_flag"), F.lit(False))
    conf = F.when(i & h, "HIGH").when(i, "IFOREST_ONLY").otherwise("HST_ONLY")
    return j.select(*k, i.alias("if_flag"), h.alias("hst_flag"), (i & h).alias("hst_confirmed"),
                    conf.alias("confidence")).where(i | h)
