"""Exact deduplication with bounded state: each micro-batch inserts what its table does not hold yet.

No id is kept in streaming state. A batch drops the rows behind the watermark and its own repeats, then the rest that the
table already holds, of which only the date folders are read that rows before the watermark cannot have left: what a batch
reads grows with the days that it can touch, not with the age of the table.

The table lies in folders by event date and batch. A batch that is run again, after a failure between writing and noting
it, replaces exactly its own folders and counts the same, so it is idempotent. One row per batch (input, late, repeated,
written, newest time) is kept in a ledger beside the table; it survives restarts, and the watermark is taken from it.

An id is known again if it comes within `lookback` days before the oldest date that the watermark lets through; with an
event of an id always bearing the same time, every repeat is either known or late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from orderpulse import vocabulary as v
from orderpulse.operators.cleaning import dedup, flatten, with_event_time
from orderpulse.sources.landing import whole_records

DATE, BATCH = "event_date", "batch_id"
LEDGER = "batch_id bigint, input bigint, late bigint, repeated bigint, written bigint, newest timestamp"


def _held(spark: SparkSession, path: str, columns: str) -> DataFrame | None:
    """What a folder holds, without listing it through a schema of its own; None before the first write."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(columns).parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch so far."""
    held = _held(spark, f"{path}-ledger", LEDGER)
    return spark.createDataFrame([], LEDGER) if held is None else held


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def insert_new(
    batch: DataFrame, batch_id: int, path: str, key: str = "event_id", watermark: str = v.WATERMARK, lookback: int = 1
) -> None:
    """Write the rows of `batch` (with the event time `occurred_at`) that are new to the table at `path`, and note the counts."""
    spark = batch.sparkSession
    newest = read_ledger(spark, path).filter(F.col(BATCH) < batch_id).agg(F.max("newest")).first()[0]
    border = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {watermark}")
    is_late = F.coalesce(F.col("occurred_at") < border, F.lit(False))
    seen, put = Observation(), Observation()
    rows = batch.withColumn("_late", is_late)
    rows = rows.observe(
        seen, F.count(F.lit(1)).alias("input"), F.coalesce(F.sum(F.col("_late").cast("int")), F.lit(0)).alias("late"),
        F.max("occurred_at").alias("newest"),
    )
    rows = dedup(rows.filter("NOT _late").drop("_late"), key).withColumn(DATE, F.to_date("occurred_at"))
    held = _held(spark, path, f"{key} string, {DATE} date, {BATCH} bigint")
    if held is not None:
        near = F.col(DATE).isNull() | (F.col(DATE) >= F.date_sub(F.to_date(border), lookback)) if newest else F.lit(True)
        known = held.filter(near & (F.col(BATCH) != batch_id)).select(F.col(key).alias("_known"))
        rows = rows.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    rows = rows.observe(put, F.count(F.lit(1)).alias("written")).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    writer = rows.write.mode("overwrite").partitionBy(DATE, BATCH).option("partitionOverwriteMode", "dynamic")
    writer.option("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS").parquet(path)
    counts = seen.get | put.get
    if not counts["input"]:
        return
    late, written = int(counts["late"]), counts["written"]
    line = (counts["input"], late, counts["input"] - late - written, written, counts["newest"] or newest)
    ledger = spark.createDataFrame([line], LEDGER.split(", ", 1)[1])
    ledger.coalesce(1).write.mode("overwrite").parquet(f"{path}-ledger/{BATCH}={batch_id}")


def merge_stream(bronze: DataFrame, path: str, checkpoint: str, watermark: str = v.WATERMARK, lookback: int = 1) -> DataStreamWriter:
    """Raw events to the clean table at `path`: parse, drop late rows and repeats, flatten; no streaming state."""

    def put(batch: DataFrame, batch_id: int) -> None:
        insert_new(flatten(with_event_time(whole_records(batch))), batch_id, path, watermark=watermark, lookback=lookback)

    return bronze.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def ledger_totals(ledger: DataFrame) -> DataFrame:
    return ledger.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("input", "late", "repeated", "written")])
