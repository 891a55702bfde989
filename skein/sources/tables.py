"""Parquet tables of one data folder, read by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table `name` of `folder`; columns and filters applied later reach the Parquet scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_json(df: DataFrame) -> DataFrame:
    """Rows as JSON text in one column `value`, fields in alphabetical order, ready for write.text."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value"))
