"""Layer statistics, reconciliation, freshness and gaps."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderpulse import vocabulary as v
from orderpulse.functions.clock import ago_text, as_time, duration_text, minutes_since, parse_time
from orderpulse.functions.measures import percent_of


def layer_stats(
    bronze: DataFrame, silver: DataFrame, gold: DataFrame, model_count: int
) -> DataFrame:
    """Rows and newest event per layer, plus a row with the number of gold tables."""

    def stats(name: str, rows: DataFrame, time: Column) -> DataFrame:
        return rows.agg(
            F.count(F.lit(1)).alias("row_count"), F.max(time).alias("last_event_at")
        ).select(F.lit(name).alias("layer"), "row_count", "last_event_at")

    layers = [
        stats("bronze", bronze, parse_time("occurred_at")),
        stats("silver", silver, F.col("occurred_at").cast("timestamp")),
        stats("gold", gold, F.col("occurred_at").cast("timestamp")),
    ]
    models = bronze.sparkSession.range(1).select(
        F.lit("models").alias("layer"),
        F.lit(model_count).cast("bigint").alias("row_count"),
        F.lit(None).cast("timestamp").alias("last_event_at"),
    )
    return reduce(DataFrame.unionByName, [*layers, models])


def every_layer(stats: DataFrame) -> DataFrame:
    """One row per layer in order, whether it has statistics or not."""
    ranked = F.posexplode(F.array(*[F.lit(name) for name in v.LAYERS])).alias("_place", "layer")
    layers = stats.sparkSession.range(1).select(ranked)
    layers = layers.select((F.col("_place") + 1).alias("layer_rank"), "layer")
    return layers.join(stats, "layer", "left")


def layer_reconciliation(stats: DataFrame) -> DataFrame:
    """Rows each layer dropped against the layer before; NULL when either is unknown."""
    notes = F.create_map(*[F.lit(text) for pair in v.LAYERS.items() for text in pair])
    # One row per layer.
    before = F.lag("row_count").over(Window.orderBy("layer_rank"))
    dropped = F.col("_before") - F.col("row_count")
    return (
        every_layer(stats)
        .withColumn("_before", before)
        .select(
            "layer_rank",
            F.initcap("layer").alias("layer"),
            "row_count",
            dropped.alias("dropped"),
            F.when(dropped.isNotNull(), percent_of(dropped, F.col("_before"))).alias("dropped_pct"),
            F.element_at(notes, F.col("layer")).alias("why"),
        )
        .orderBy("layer_rank")
    )


def freshness_state(minutes: Column, live_minutes: int = v.LIVE_MINUTES) -> Column:
    return (
        F.when(minutes.isNull(), "unknown")
        .when(minutes < live_minutes, "live")
        .otherwise("delayed")
    )


def outage_verdict(minutes: Column, outage_minutes: int = v.OUTAGE_MINUTES) -> Column:
    return (
        F.when(minutes.isNull(), "data-missing")
        .when(minutes >= outage_minutes, "data-stale")
        .otherwise("ok")
    )


def freshness(stats: DataFrame, now: datetime, stale_hours: int = v.STALE_HOURS) -> DataFrame:
    """Age, state, texts and alerts of every layer at the time `now`."""
    age = F.col("age_minutes")
    return (
        every_layer(stats)
        .select("layer", "last_event_at", minutes_since(F.col("last_event_at"), now).alias("age_minutes"))
        .withColumns(
            {
                "state": freshness_state(age),
                "age_text": duration_text(age),
                "ago_text": ago_text(age),
                "stale_alert": F.coalesce(age > stale_hours * 60, F.lit(False)),
                "outage": outage_verdict(age),
            }
        )
    )


def missing_hours(
    rows: DataFrame,
    time: str,
    now: datetime | None = None,
    cap_hours: int | None = None,
) -> DataFrame:
    """Hours without a row, up to the hour before `now` (default: up to the newest row).

    Looks at everything since the oldest row, or with a cap only at the last `cap_hours` of it. Expected hours are generated
    month by month, so one stray time of long ago makes many rows but no large one.
    """
    hour = F.date_trunc("HOUR", time)
    known = rows.filter(F.col(time).isNotNull())
    ends = known.agg(F.min(hour).alias("oldest"), F.max(hour).alias("newest"))
    last = F.col("newest")
    if now is not None:
        this_hour = F.date_trunc("HOUR", as_time(now))
        last = this_hour - F.make_interval(hours=F.lit(1))
        known = known.filter(F.col(time) < this_hour)
        if cap_hours is not None:
            known = known.filter(F.col(time) >= this_hour - F.make_interval(hours=F.lit(cap_hours)))
    first = F.col("oldest")
    if cap_hours is not None:
        first = F.greatest(first, last - F.make_interval(hours=F.lit(cap_hours - 1)))
    months = F.sequence(F.date_trunc("MONTH", first), F.date_trunc("MONTH", last), F.make_interval(months=F.lit(1)))
    each = ends.filter(first <= last).select(first.alias("_first"), last.alias("_last"), F.explode(months).alias("_month"))
    one = F.make_interval(hours=F.lit(1))
    end = F.least(F.col("_last"), F.col("_month") + F.make_interval(months=F.lit(1)) - one)
    expected = each.select(F.explode(F.sequence(F.greatest("_first", "_month"), end, one)).alias("hr"))
    return expected.join(known.select(hour.alias("hr")).distinct(), "hr", "left_anti")


def last_write(spark: SparkSession, layers: dict[str, str], pattern: str = "*.parquet") -> DataFrame:
    """Newest file time per layer folder; only the file listing is read, no data."""

    def newest(name: str, path: str) -> DataFrame:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .load(path)
        )
        return files.agg(F.max("modificationTime").alias("last_write_at")).select(
            F.lit(name).alias("layer"), "last_write_at"
        )

    return reduce(DataFrame.unionByName, [newest(name, path) for name, path in layers.items()])
