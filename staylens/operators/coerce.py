"""Bring loosely typed rows to a declared schema, one expression per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _whole_number(value: Column, source: T.DataType) -> Column:
    """Integers as they are, whole decimals ("3.0") too, anything else NULL."""
    as_double = value.try_cast("double")
    whole = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
    if isinstance(source, (T.FractionalType, T.DecimalType)):  # a cast would cut 3.7 to 3
        return whole
    return F.coalesce(value.try_cast("bigint"), whole)


def _real_number(value: Column) -> Column:
    as_double = value.try_cast("double")
    return F.when(~F.isnan(as_double), as_double)


def coerce_column(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast one value; what cannot be read becomes NULL (False for flags)."""
    if isinstance(target, T.BooleanType):
        return F.coalesce(value.try_cast("boolean"), F.lit(False))
    if isinstance(target, T.LongType):
        exact = isinstance(source, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
        return value.cast("bigint") if exact else _whole_number(value, source)
    if isinstance(target, T.DoubleType):
        return _real_number(value)
    return value.cast(target)


def _default(target: T.DataType) -> Column:
    if isinstance(target, T.BooleanType):
        return F.lit(False)
    return F.lit(None).cast(target)


def coerce_to(df: DataFrame, schema: T.StructType, *kept: str) -> DataFrame:
    """Exactly the columns of ``schema``: cast, reordered, absent ones filled; then ``kept`` ones as they are."""
    present = {field.name: field.dataType for field in df.schema.fields}
    return df.select(
        *[
            (
                coerce_column(F.col(f"`{field.name}`"), present[field.name], field.dataType)
                if field.name in present
                else _default(field.dataType)
            ).alias(field.name)
            for field in schema.fields
        ],
        *kept,
    )


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Like :func:`coerce_to` but keeps NULL flags: failing casts are NULL per row."""
    present = set(df.columns)
    return df.select(
        *[
            (
                F.col(f"`{field.name}`").try_cast(field.dataType)
                if field.name in present
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in schema.fields
        ]
    )
