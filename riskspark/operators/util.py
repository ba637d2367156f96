"""Small planning helpers shared by operators."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side broadcast without a shuffle (rows); above it a shuffle join is used.
BROADCAST_MAX_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only behind a checked row count.

    The side is counted first (it is an aggregate, so cheap); if it is larger
    than ``max_rows`` the plain DataFrame is returned and Spark plans a
    shuffle join instead.
    """
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage of a reused intermediate: reliable checkpoint into the
    cluster's shared ``spark.checkpoint.dir`` (survives executor loss; never a
    local checkpoint)."""
    from ..session import shared_dir
    shared_dir(df.sparkSession, "checkpoints")
    return df.checkpoint(eager=True)


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where a null equals a null; the keys of ``left`` stay."""
    other = right.select([F.col(f"`{c}`").alias(f"__right_{c}" if c in keys else c) for c in right.columns])
    on = [left[c].eqNullSafe(other[f"__right_{c}"]) for c in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    joined = left.join(other, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__right_{c}" for c in keys])
