"""Positions and running totals over ordered groups of any size.

A window over a whole group would sort that group in one task. Here the order is cut into
buckets first: the order columns alone, sorted by all of them in ranges, give a table of
borders, and each (group, bucket) becomes its own window. What precedes a bucket comes from a
small table of per-bucket totals. Buckets depend only on the borders and the row's own values,
so retried tasks agree. Order columns may be of any type that sorts, texts included.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.functions.once import computed
from corpusflow.session import stored

ROWS_PER_BUCKET = 1_000_000
#: Rows whose keys one task sorts to find borders; larger buckets mean larger tasks.
SORTED_ROWS = 250_000
_B = "_bucket"
#: Steps of a bisection that the optimizer may write out in each other.
_STEPS = 3


def _key(order: Sequence[str]) -> Column:
    """The order columns as one value that compares like them, rows without a value last."""
    parts = [(F.col(f"`{c}`").isNull().alias(f"n{i}"), F.col(f"`{c}`").alias(f"v{i}")) for i, c in enumerate(order)]
    return F.struct(*[c for part in parts for c in part])


def borders(df: DataFrame, order: Sequence[str], rows: int, rows_per_bucket: int) -> DataFrame:
    """``key``: every ``rows_per_bucket``-th of the sorted keys of ``rows`` rows, in their own types.

    Keys are sorted in ranges of ``SORTED_ROWS`` or so, however small the buckets are: Spark samples
    a hundred keys or more for each range on the driver. A stored table, so that every use of it
    sees the same borders.
    """
    dealt = df.select(_key(order).alias("key")).repartitionByRange(_ranges(rows, rows_per_bucket), "key")
    # The number of a row is its partition above 33 bits that count from 0 in the partition's order.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = dealt.sortWithinPartitions("key").withColumn("place", place)
    return stored(numbered.filter(F.col("place") % rows_per_bucket == 0).select("key"), "borders")


def _ranges(rows: int, rows_per_bucket: int) -> int:
    return max(1, math.ceil(rows / max(rows_per_bucket, SORTED_ROWS)))


def bucketed(df: DataFrame, order: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` with ``_bucket``, which rises with the order columns.

    One value of the first column may fill many buckets, since the borders hold all columns, and
    hold them exactly. The sorted borders, one for each bucket, are a subquery's value;
    a row finds the range it falls into by bisection. A step names the one before three times:
    written out in each other by the optimizer, thirteen steps would fill the driver.
    """
    rows = df.count()
    if rows == 0:
        return df.withColumn(_B, F.lit(0))
    listed = borders(df, order, rows, rows_per_bucket).agg(F.sort_array(F.collect_list("key"))).scalar()
    most = rows // rows_per_bucket + 2 * _ranges(rows, rows_per_bucket)
    work, at = df.withColumn(_B, F.lit(0)), F.col(_B)
    for i in reversed(range(most.bit_length())):
        work = work.withColumn(_B, F.when(F.get(listed, at + ((1 << i) - 1)) <= _key(order), at + (1 << i)).otherwise(at))
        if i % _STEPS == 0:
            work = work.select(*df.columns, computed(**{_B: at}))
    return work


def running(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    group_totals: Mapping[str, str] | None = None,
    group_mins: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Running sums per group in the given order, the current row included.

    ``totals`` maps an output name to the summed expression. ``group_totals`` maps an output
    name to an entry of ``totals`` whose sum over the whole group is attached as well, and
    ``group_mins`` to an expression whose minimum over the group is. The order columns
    together must be unique within a group.
    """
    mins = group_mins or {}
    cells = [*groups, _B]
    work = bucketed(df, order, rows_per_bucket)
    per_cell = work.groupBy(*cells).agg(
        *[F.sum(e).alias(f"_t_{n}") for n, e in totals.items()],
        *[F.min(e).alias(f"_m_{n}") for n, e in mins.items()],
    )
    by_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = by_group.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_cell.select(
        *cells,
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in totals],
        *[F.sum(f"_t_{n}").over(by_group).alias(out) for out, n in (group_totals or {}).items()],
        *[F.min(f"_m_{n}").over(by_group).alias(n) for n in mins],
    )
    ranked = [F.asc_nulls_last(c) for c in order]
    within = Window.partitionBy(*cells).orderBy(*ranked).rowsBetween(Window.unboundedPreceding, 0)
    # A hash table of the few cells of a partition; a merge join would sort the rows twice. Rows
    # without a value in a group column are a group like any other.
    named = offsets.select(*[F.col(c).alias(f"_c_{i}") if c in cells else c for i, c in enumerate(offsets.columns)])
    same = [F.col(c).eqNullSafe(F.col(f"_c_{i}")) for i, c in enumerate(cells)]
    summed = work.join(named.hint("shuffle_hash"), same, "left")
    return summed.select(
        *df.columns,
        *[(F.col(f"_o_{n}") + F.sum(e).over(within)).alias(n) for n, e in totals.items()],
        *list(group_totals or {}),
        *list(mins),
    )


def positions(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    out: str = "idx",
    group_size: str | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """0-based position of each row in its group, optionally with the group's row count."""
    numbered = running(
        df, groups, order, {out: F.lit(1)}, rows_per_bucket, {group_size: out} if group_size else None
    )
    return numbered.withColumn(out, (F.col(out) - 1).cast("long"))
