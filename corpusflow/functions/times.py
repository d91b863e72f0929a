"""Column expressions over points in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since the epoch. Wall-clock times without a zone do not meet the session's zone."""
    ts = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        since = (ts - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).cast("interval second")
        return (since.cast("decimal(20,6)") * 1_000_000).cast("long")
    return F.unix_micros(ts)


def seconds(start: Column, end: Column) -> Column:
    """Seconds between two counts of microseconds."""
    return (end - start) / 1e6
