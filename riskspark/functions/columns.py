"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

ZONE_SUFFIX = r"(Z|[+-]\d{2}:?\d{2})$"


def col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column if the frame has it, else a typed null (missing field)."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast(dtype)


def to_text(c: Column) -> Column:
    """Any scalar as text (numbers keep their plain form)."""
    return c.cast("string")


def to_double(c: Column) -> Column:
    """Numeric coercion: unparsable or missing -> null (pd.to_numeric errors='coerce')."""
    return c.try_cast("double")


def utc_timestamp(df: DataFrame, name: str) -> Column:
    """Parse a timestamp field to timestamp_ntz holding UTC wall-clock.

    Strings with an offset or ``Z`` are converted to UTC; strings without one
    are taken as UTC; unparsable text gives null.  Typed inputs are passed
    through (timestamp_ntz) or converted (timestamp with zone).
    """
    if name not in df.columns:
        return F.lit(None).cast("timestamp_ntz")
    c = F.col(f"`{name}`")
    dtype = df.schema[name].dataType
    if isinstance(dtype, TimestampNTZType):
        return c
    if isinstance(dtype, TimestampType):
        return F.convert_timezone(None, F.lit("UTC"), c)
    s = F.trim(c.cast("string"))
    zoned = F.convert_timezone(None, F.lit("UTC"), s.try_cast("timestamp"))
    return F.when(s.rlike(ZONE_SUFFIX), zoned).otherwise(s.try_cast("timestamp_ntz"))


def bucket_start(ts: Column, bucket: str) -> Column:
    """Floor a timestamp to its tumbling bucket (e.g. '5 minutes', '1 hour')."""
    return F.window(ts, bucket).start


def entropy_term(p: Column) -> Column:
    return -p * F.log(p + F.lit(1e-10))


def safe_rate(num: Column, den: Column) -> Column:
    """num / den as double, 0 when den is 0."""
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def half_even(x: Column, digits: int) -> Column:
    """Round half to even at ``digits`` decimals on y = x * 10^digits.

    Written out with floor/compare so that every engine evaluating the same
    IEEE operations gets the same double (``bround`` rounds the shortest
    decimal text instead, which differs on values such as 0.04155).
    """
    m = float(10 ** digits)
    y = x.cast("double") * F.lit(m)
    f = F.floor(y).cast("double")
    d = y - f
    r = (F.when(d > 0.5, f + 1).when(d < 0.5, f)
         .otherwise(F.when(F.pmod(f, F.lit(2.0)) == 0, f).otherwise(f + 1)))
    return F.when(F.abs(y) < F.lit(1e15), r / F.lit(m)).otherwise(x.cast("double"))


def py_float_text(c: Column, digits: int) -> Column:
    """Text of a value rounded to ``digits`` decimals the way Python prints a float.

    Positional notation with the shortest digits and at least one decimal
    (``12.0``, ``0.0005``, ``-3.25``); null stays null.
    """
    dec = half_even(c, digits).cast(f"decimal(38,{digits})").cast("string")
    trimmed = F.regexp_replace(dec, r"0+$", "")
    return F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)


def fixed_text(c: Column, digits: int) -> Column:
    """printf('%.Nf') of a value first rounded half-even to N digits."""
    return F.format_string(f"%.{digits}f", half_even(c, digits))


def signed_fixed_text(c: Column, digits: int) -> Column:
    return F.format_string(f"%+.{digits}f", half_even(c, digits))


def thousands_text(c: Column) -> Column:
    """Integer text with thousands separators ('{:,}' / '{:,.0f}')."""
    return F.format_number(half_even(c, 0), 0)


def lookup(mapping: dict, key: Column) -> Column:
    """Dictionary lookup with fallback to the key (dict.get(k, k))."""
    if not mapping:
        return key
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, key), key)


def empty_to_null(c: Column) -> Column:
    return F.when(c == F.lit(""), F.lit(None).cast(StringType())).otherwise(c)
