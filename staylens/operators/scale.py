"""Min-max scaling over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Position between ``low`` and ``high``; NULL when the two are equal."""
    return F.try_divide(value - low, F.nullif(high - low, F.lit(0.0)))


def with_min_max_scaled(df: DataFrame, column: str, over: DataFrame | None = None) -> DataFrame:
    """Replace ``column`` by its min-max scaled value over all rows of ``df``.

    The extremes are a partial aggregate per task and one final row that is
    broadcast back; a window without partitions would move every row to one
    task. When ``df`` ends in an aggregation both sides reuse its shuffle. ``over``
    may name the frame ``df`` was made from, where that has the same values of
    ``column`` and is cheaper to read again.
    """
    extremes = (df if over is None else over).agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    return (
        df.crossJoin(F.broadcast(extremes))
        .withColumn(column, min_max(F.col(column), F.col("_low"), F.col("_high")))
        .drop("_low", "_high")
    )
