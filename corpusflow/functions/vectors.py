"""Column expressions over vectors stored as arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusflow.functions.once import once

_EPS = 1e-12


def _doubles(v: Column) -> Column:
    return v.cast("array<double>")


def _sum(v: Column, term) -> Column:
    return F.aggregate(_doubles(v), F.lit(0.0), lambda acc, x: acc + term(x))


def dim(v: Column) -> Column:
    return F.size(v)


def head(v: Column, n: int = 5) -> Column:
    return F.slice(v, 1, n)


def norm(v: Column) -> Column:
    return F.sqrt(_sum(v, lambda x: x * x))


def l2_normalised(v: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    length = F.greatest(norm(v), F.lit(_EPS))
    return F.transform(_doubles(v), lambda x: x / length)


def mean_of(vectors: Column) -> Column:
    """Component-wise mean of an array of equally long vectors."""
    first = F.get(vectors, F.lit(0))
    zero = F.transform(_doubles(first), lambda _: F.lit(0.0))
    added = F.aggregate(vectors, zero, lambda acc, v: F.zip_with(acc, _doubles(v), lambda a, b: a + b))
    return F.transform(added, lambda x: x / F.size(vectors))


def deviation(v: Column) -> Column:
    """Population standard deviation."""
    n = F.size(v)
    squares = once(_sum(v, lambda x: x) / n, lambda mean: _sum(v, lambda x: (x - mean) * (x - mean)))
    return F.sqrt(squares / n)


def stats(v: Column) -> dict[str, Column]:
    """Minimum, maximum, mean, population standard deviation, norm and first components."""
    return {
        "dim": F.size(v),
        "min": F.array_min(v).cast("double"),
        "max": F.array_max(v).cast("double"),
        "mean": _sum(v, lambda x: x) / F.size(v),
        "std": deviation(v),
        "norm": norm(v),
        "head": head(v),
    }


def _special(v: Column, value: str) -> Column:
    return F.coalesce(F.array_contains(_doubles(v), F.lit(float(value))), F.lit(False))


def nan_count(v: Column) -> Column:
    """NaN components. The compiled membership test spares clean vectors the lambda."""
    counted = F.size(F.filter(_doubles(v), lambda x: F.isnan(x)))
    return F.when(_special(v, "nan"), counted).otherwise(F.lit(0))


def inf_count(v: Column) -> Column:
    counted = F.size(F.filter(_doubles(v), lambda x: F.abs(x) == float("inf")))
    return F.when(_special(v, "inf") | _special(v, "-inf"), counted).otherwise(F.lit(0))
