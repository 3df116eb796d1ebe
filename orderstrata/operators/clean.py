"""Raw text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType


def strictly(df: DataFrame, name: str, kind: DataType, told_as: str) -> Column:
    """A column of ``df`` in a type; a value that does not fit fails the job in any session.

    In ANSI mode Spark's own cast fails on text; without it the cast gives NULL, which
    then is the error.
    """
    value = F.col(name)
    given = df.select(value).schema.fields[0].dataType
    if given == kind:
        return value
    cast = value.cast(kind) if isinstance(given, StringType) else value.try_cast(kind)
    told = F.concat(F.lit(f"{told_as} does not take "), value.cast(StringType()))
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(told)).otherwise(cast)


def _typed(df: DataFrame, column: StructField) -> Column:
    if isinstance(column.dataType, StringType):
        return F.trim(F.col(column.name)).cast(column.dataType).alias(column.name)
    return strictly(df, column.name, column.dataType, column.name).alias(column.name)


def fitted(df: DataFrame, column: StructField) -> Column:
    """A column of ``df`` in its type, texts trimmed; NULL for a value that does not fit."""
    if isinstance(column.dataType, StringType):
        return F.trim(F.col(column.name)).cast(column.dataType)
    given = df.select(F.col(column.name)).schema.fields[0].dataType
    value = F.col(column.name)
    return value if given == column.dataType else value.try_cast(column.dataType)


def clean(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns in its order and types, texts trimmed; other columns are dropped.

    A value that does not fit its type fails the job, whether or not the session is in
    ANSI mode.
    """
    return df.select([_typed(df, column) for column in schema.fields])
