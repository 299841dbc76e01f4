"""The streaming layers: landing raw events, and cleaning them.

Each flow is a function from a streaming DataFrame to a streaming DataFrame; `append` and
`run_available` start it, take what has arrived, and stop, as a scheduled job would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from orderpulse import vocabulary as v
from orderpulse.operators.cleaning import flatten, with_event_time
from orderpulse.session import store_times_with_statistics

# Copies of one event are thinned out in up to this many lanes before they meet in one task.
# More lanes cost nothing for events without copies.
LANES = 4096


def dedup_stream(events: DataFrame, key: str = "event_id", lanes: int = LANES) -> DataFrame:
    """First arrival of each key, for good; needs a watermark on the event time.

    The final step keeps every key it has seen, so a replay adds nothing however late it
    comes. It must bring all copies of a key to one task; the step before it drops copies
    per lane (the input task, modulo `lanes`), with state that expires, so that a key holding
    a large share of the rows reaches that task as at most one row per lane and watermark
    period.
    """
    if lanes > 1:
        lane = F.pmod(F.spark_partition_id(), F.lit(lanes))
        events = (
            events.withColumn("_lane", lane)
            .dropDuplicatesWithinWatermark([key, "_lane"])
            .drop("_lane")
        )
    return events.dropDuplicates([key])


def dedup_stream_within_watermark(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Bounded-state variant: a key that returns after the watermark passed is emitted again."""
    return events.dropDuplicatesWithinWatermark([key])


def silver_stream(
    bronze: DataFrame, watermark: str = v.WATERMARK, lanes: int = LANES, bounded: bool = False
) -> DataFrame:
    """Raw events to clean events: parse, drop late rows, deduplicate, flatten."""
    timed = with_event_time(bronze).withWatermark("occurred_at", watermark)
    unique = dedup_stream_within_watermark(timed) if bounded else dedup_stream(timed, lanes=lanes)
    return flatten(unique)


def append(
    rows: DataFrame,
    checkpoint: str,
    path: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> DataStreamWriter:
    """Append sink into a folder, or into a table named at the start.

    The checkpoint records which input was taken, so each input row counts exactly once.
    """
    store_times_with_statistics(rows.sparkSession)
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if path is not None:
        writer = writer.option("path", path)
    return writer.partitionBy(*partition_by) if partition_by else writer


def run_available(writer: DataStreamWriter, table: str | None = None) -> list:
    """Process everything that has arrived, then stop. Returns the progress reports of all batches.

    Spark keeps the newest reports only, so they are taken over while the query runs."""
    query = writer.toTable(table) if table else writer.start()
    reports, done = {}, False
    while not done:
        done = query.awaitTermination(0.2)
        reports |= {report.batchId: report for report in query.recentProgress}
    if reports and len(reports) <= max(reports) - min(reports):
        raise RuntimeError("progress reports of some batches are missing")
    return [reports[batch] for batch in sorted(reports)]


def drop_counts(progress: list) -> dict[str, int]:
    """Input, late and repeated rows of a run, from its progress reports."""
    operators = [op for report in progress for op in report.stateOperators]
    return {
        "input": sum(report.numInputRows for report in progress),
        "late": sum(op.numRowsDroppedByWatermark for op in operators),
        "repeated": sum(
            int(dict(op.customMetrics).get("numDroppedDuplicateRows", 0)) for op in operators
        ),
    }
