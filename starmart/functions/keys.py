"""Key expressions: hash surrogate keys and integer date keys (all JVM-side Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the warehouse macro package for keys to match:
# the NULL placeholder and the separator of generate_surrogate_key.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"

# Scale kept when a floating-point value is written into a published hash key.  Engines print doubles
# differently (1.0E7 vs 10000000.0), so numbers go through a fixed decimal first.  Keys name versions;
# whether a value changed is decided on the values themselves (history.dedupe_changes).
FLOAT_KEY_SCALE = 6


def canonical_string(col: Column, dtype: T.DataType) -> Column:
    """Engine-independent text of a value, used inside hash keys."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        # NaN, infinities and numbers beyond the decimal keep the engine's own text.
        return F.coalesce(col.try_cast(T.DecimalType(38, FLOAT_KEY_SCALE)).cast("string"), col.cast("string"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return col.cast("string")


def surrogate_key(df: DataFrame, cols: list[str]) -> Column:
    """md5 over the '-'-joined text of ``cols`` with NULLs replaced by a placeholder.

    Parts are joined with '-', so ('a-b','c') and ('a','b-c') give the same key; use
    :func:`length_prefixed_key` where that matters.
    """
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    parts = [F.coalesce(canonical_string(F.col(c), types[c.lower()]), F.lit(NULL_PLACEHOLDER)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def length_prefixed_key(df: DataFrame, cols: list[str]) -> Column:
    """Collision-safe variant: every part is prefixed by its length."""
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    parts = []
    for c in cols:
        s = F.coalesce(canonical_string(F.col(c), types[c.lower()]), F.lit(NULL_PLACEHOLDER))
        parts.append(F.concat(F.length(s).cast("string"), F.lit(":"), s))
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def date_key(col: Column | str) -> Column:
    """YYYYMMDD as BIGINT, computed arithmetically (no string formatting)."""
    c = F.col(col) if isinstance(col, str) else col
    d = F.to_date(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def date_from_key(col: Column | str) -> Column:
    """Parse a YYYYMMDD key back to a DATE; an impossible date gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(F.lpad(c.cast("string"), 8, "0"), F.lit("yyyyMMdd")).cast("date")
