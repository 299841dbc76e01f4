"""Dimension and seed files: CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderpulse import schemas


def read_dimension(spark: SparkSession, name: str, path: str, infer: bool = False) -> DataFrame:
    """A dimension by its fixed schema, or with inferred types."""
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schemas.DIMENSIONS[name]).csv(path)


def write_dimension(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def read_seed_events(spark: SparkSession, path: str) -> DataFrame:
    """Flat seed events, typed as in the clean layer."""
    return spark.read.option("header", True).schema(schemas.SEED_EVENT).csv(path)
