"""A bounded training sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_RANGE = 1 << 31


def sample(docs: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows, chosen by the hash of their ids: the same ones in every run.

    A hash below the wanted share of its range lets a row through, so that no more than about
    ``rows`` rows are sorted. NULL ids have a hash as well. Equal ids pass or fail together;
    beyond the bound the hash of the text decides.
    """
    share = min(1.0, rows / max(1, docs.count()))
    h = F.xxhash64(F.col("doc_id"), F.lit("train"))
    passed = docs.filter(h.bitwiseAND(F.lit(_RANGE - 1)) < round(share * _RANGE))
    return passed.orderBy(h, F.xxhash64("text")).limit(rows)
