"""Tables without rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderstrata.contracts import Contract


def empty_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """The schema's columns and no rows, in one partition."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0, 0, 1, 1).select(columns)


def empty_table(spark: SparkSession, contract: Contract) -> DataFrame:
    return empty_rows(spark, contract.schema)
