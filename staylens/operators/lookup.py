"""Join rows to a table that is unique per key, whatever the key distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def skew_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to a lookup (``left`` or ``inner``); one plan at every size.

    Adaptive execution broadcasts a lookup that turns out small and splits a
    partition that a heavy key (or many rows without a key) makes large, but only
    where both sides of the join are shuffled for it. A lookup that comes out of an
    aggregation on the same key is not: it stays in the aggregation's partitions. So
    the join also compares a hash of the key, which no side is partitioned by: both
    are shuffled once more, the lookup with one row per key, and may be split. Two
    bits of the hash serve as well as all, and do not add 8 bytes to every row.
    """
    keys = list(on)
    extra = F.pmod(F.xxhash64(*keys), F.lit(4))
    joined = rows.withColumn("_route", extra).join(lookup.withColumn("_route", extra), [*keys, "_route"], how)
    return joined.drop("_route")
