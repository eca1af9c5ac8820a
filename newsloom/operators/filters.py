"""Row filters of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed as v
from ..functions.text import is_low_value


def as_timestamp(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def lookback(df: DataFrame, as_of, hours: int = v.LOOKBACK_HOURS,
             column: str = "timestamp") -> DataFrame:
    """Rows of the last ``hours`` before ``as_of``, the boundary included.

    ``as_of`` is a parameter and not the clock, so a run can be repeated. The bound is a constant of
    the column's own type, so the comparison reaches the scan.
    """
    bound = as_timestamp(as_of) - F.make_interval(hours=F.lit(hours))
    return df.where(F.col(column) >= bound.cast(df.schema[column].dataType))


def non_empty(df: DataFrame, column: str = "text") -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def drop_low_value(df: DataFrame, column: str = "text") -> DataFrame:
    """Drop greetings and wordless messages; the test reads the raw text."""
    return df.where(~is_low_value(F.col(column)))


def kept(collected: DataFrame) -> DataFrame:
    """Messages of a collected frame that go on to the digest."""
    return collected.where(~F.col("low_value")).drop("low_value")
