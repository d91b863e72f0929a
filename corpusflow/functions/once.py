"""Evaluate a costly expression once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def computed(**columns: Column) -> Column:
    """Several columns from one row, behind a generator.

    Filters on such columns are not pushed below it, where they would compute them again.
    """
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
