"""Column-expression helpers shared by every builder (all JVM-side built-ins, no UDF)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TXN_TYPE_PATTERNS


def cutoff_lit(cutoff_date: str) -> Column:
    """The as-of date as a literal; Catalyst folds it."""
    return F.lit(cutoff_date).cast("date")


def days_before(date_col: Column | str, cutoff_date: str) -> Column:
    """Whole days from the row date to the cutoff (>= 1 once the as-of filter ran)."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.datediff(cutoff_lit(cutoff_date), c)


def window_sql(lo: int | None, hi: int | None, d: str = "d") -> str:
    """True when the day offset lies in [lo, hi]; an open window is always true.

    SQL text, because long expression lists are built as SQL strings: one py4j call per
    expression instead of one per operator keeps driver planning short.
    """
    if lo is None:
        return "TRUE"
    if lo == hi:
        return f"{d} = {lo}"
    return f"{d} BETWEEN {lo} AND {hi}"


def normalized_type(type_col: str = "TXN_TYPE") -> Column:
    return F.lower(F.coalesce(F.col(type_col).cast("string"), F.lit("")))


def type_flags(type_col: str = "TXN_TYPE") -> list[Column]:
    """One 0/1 int column per (overlapping) transaction type class."""
    t = normalized_type(type_col)
    return [t.rlike(pattern).cast("int").alias(f"is_{name}") for name, pattern in TXN_TYPE_PATTERNS]


NUMERIC_TYPES = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Dtype-driven selection (double, float, int, bigint, smallint)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, NUMERIC_TYPES)]


def as_timestamp(col: str, dtype: T.DataType) -> Column:
    """Parse a raw time column without throwing on malformed values (ANSI-safe).

    A bigint is seconds since the epoch, as in Spark's own cast; nanosecond Parquet columns
    are timestamps by the time they come here (S6).
    """
    c = F.col(col)
    if isinstance(dtype, T.TimestampType):
        return c
    if isinstance(dtype, T.TimestampNTZType):
        return c.cast("timestamp")
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp")
    if isinstance(dtype, T.LongType):
        return F.timestamp_seconds(c)
    return F.try_to_timestamp(c.cast("string"))


def as_date(col: str, dtype: T.DataType) -> Column:
    """Date of a raw column, null (not an error) when malformed.

    One rule for every type: an instant's day is its day in the session's time zone.
    """
    c = F.col(col)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_date(c)  # a wall-clock time has its day whatever the zone
    return F.to_date(as_timestamp(col, dtype))


def round_half_up(c: Column, digits: int = 4) -> Column:
    """Half-up rounding on the decimal value of a double (stable across engines on ties).

    Whole numbers stay as they are (-0 becomes 0), without the way by decimals.
    """
    whole = (c == F.rint(c)) & (F.abs(c) < F.lit(1e15))
    return F.when(whole, c + F.lit(0.0)).otherwise(F.round(c.cast("decimal(38,10)"), digits).cast("double"))


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column (used by the oracle checks so both engines compare equal)."""
    return df.select(
        *[
            round_half_up(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
