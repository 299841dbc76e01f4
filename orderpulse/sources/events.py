"""Event files: JSON lines under one folder per date and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse import schemas
from orderpulse.functions.clock import parse_time

DATE_COLUMN, HOUR_COLUMN = "event_date", "event_hour"


def read_events(spark: SparkSession, path: str, schema: str | None = schemas.RAW_EVENT) -> DataFrame:
    """All event files below `path`; pass schema=None to infer it from the files."""
    reader = spark.read.option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def stream_events(
    spark: SparkSession,
    path: str,
    schema: str | None = schemas.RAW_EVENT,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New event files as they arrive, oldest first.

    Streams need a schema up front, so schema=None infers it from the files present now.
    """
    if schema is None:
        schema = read_events(spark, path, None).schema
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def with_date_and_hour(events: DataFrame) -> DataFrame:
    moment = parse_time(F.col("occurred_at").cast("string"))
    return events.withColumns(
        {DATE_COLUMN: F.to_date(moment), HOUR_COLUMN: F.date_format(moment, "HH")}
    )


def write_events(
    events: DataFrame, path: str, by_hour: bool = True, rows_per_file: int = 5_000_000
) -> None:
    """Append events as JSON lines, by default one folder per event date and hour.

    The rebalance hint gathers each hour for few, large files, and lets AQE split an hour
    that is too large for one task.
    """
    if by_hour:
        hours = with_date_and_hour(events).hint("rebalance", F.col(DATE_COLUMN), F.col(HOUR_COLUMN))
        writer = hours.write.partitionBy(DATE_COLUMN, HOUR_COLUMN)
    else:
        writer = events.write
    (
        writer.mode("append")
        .option("maxRecordsPerFile", rows_per_file)
        .option("ignoreNullFields", False)
        .json(path)
    )


def events_per_hour(events: DataFrame) -> DataFrame:
    """Rows per event date and hour, as the sink lays them out."""
    return (
        with_date_and_hour(events)
        .groupBy(DATE_COLUMN, HOUR_COLUMN)
        .agg(F.count(F.lit(1)).alias("events"))
    )


def files_per_hour(spark: SparkSession, path: str) -> DataFrame:
    """Rows per date and hour folder, counted from the files written."""
    layout = f"{DATE_COLUMN} date, {HOUR_COLUMN} string"
    return (
        spark.read.schema(f"event_id string, {layout}")
        .json(path)
        .groupBy(DATE_COLUMN, HOUR_COLUMN)
        .agg(F.count(F.lit(1)).alias("events"))
    )


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    return rows.limit(n)
