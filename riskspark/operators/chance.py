"""Random choices that any engine can make again: fractions from a digest of what they are for."""
from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column
from pyspark.sql import functions as F


def fraction(*parts) -> float:
    """A number in [0, 1), evenly spread over its arguments: 32 bits of the digest of their text."""
    return int(md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2.0 ** 32


def shuffled(*parts: Column) -> Column:
    """A text by which rows are in random order: the digest of the parts' text."""
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
