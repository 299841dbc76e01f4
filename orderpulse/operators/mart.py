"""Daily KPI mart and the range queries over it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderpulse import vocabulary as v
from orderpulse.functions.clock import stage_seconds
from orderpulse.functions.measures import mean_minutes_where, mean_where, share, sum_where

TREND_METRICS = (
    "delivered_orders",
    "cancelled_orders",
    "total_gmv",
    "cancellation_rate",
    "avg_delivery_time_minutes",
)


def daily_metrics(orders: DataFrame) -> DataFrame:
    """One row per order date; orders that were never placed form the NULL date."""
    status = F.col("final_status")
    delivered = status == "delivered"
    total, done = F.col("total_orders"), F.col("delivered_orders")
    return (
        orders.groupBy(F.to_date("placed_at").alias("order_date"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.count_if(delivered).alias("delivered_orders"),
            F.count_if(status == "cancelled").alias("cancelled_orders"),
            F.count_if(status.isin(*v.IN_PROGRESS)).alias("in_progress_orders"),
            sum_where(delivered, "gmv").alias("total_gmv"),
            mean_where(delivered, F.col("gmv")).alias("avg_order_value"),
            sum_where(delivered, "discount").alias("total_discount_given"),
            mean_minutes_where(delivered, stage_seconds("placed_at", "delivered_at")).alias(
                "avg_delivery_time_minutes"
            ),
            mean_minutes_where(delivered, stage_seconds("confirmed_at", "prepared_at")).alias(
                "avg_prep_time_minutes"
            ),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.count_distinct("vendor_id").alias("unique_vendors_active"),
            F.count_distinct("driver_id").alias("unique_drivers_active"),
        )
        .withColumns(
            {
                "avg_order_value": F.round("avg_order_value", 2),
                "avg_delivery_time_minutes": F.round("avg_delivery_time_minutes", 2),
                "avg_prep_time_minutes": F.round("avg_prep_time_minutes", 2),
                "cancellation_rate": F.round(F.col("cancelled_orders") / total, 4),
                "completion_rate": F.round(done / total, 4),
            }
        )
    )


def date_range(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("order_date").isNotNull()).agg(
        F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date")
    )


def metrics_between(mart: DataFrame, start: date, end: date) -> DataFrame:
    day = F.col("order_date")
    return mart.filter(day.isNotNull() & day.between(F.lit(start), F.lit(end))).orderBy("order_date")


def preset_bounds(oldest: Column, newest: Column, preset: str, today: date) -> tuple[Column, Column]:
    """First and last day of a preset: the running day is skipped, the start is clamped."""
    days = v.RANGE_DAYS[preset]
    last = F.when(newest == F.lit(today), F.date_sub(newest, 1)).otherwise(newest)
    first = oldest if days is None else F.greatest(oldest, F.date_sub(last, days - 1))
    return first, last


def preset_range(mart: DataFrame, preset: str, today: date) -> DataFrame:
    """First and last day of a preset range, one row, to filter other tables by."""
    first, last = preset_bounds(F.col("min_date"), F.col("max_date"), preset, today)
    return date_range(mart).select(first.alias("start_date"), last.alias("end_date"))


def metrics_in_preset(mart: DataFrame, preset: str, today: date) -> DataFrame:
    """Mart rows of a preset range, found in the same pass over the mart."""
    # The mart has one row per calendar day, so the unpartitioned window stays small.
    whole = Window.partitionBy()
    first, last = preset_bounds(
        F.min("order_date").over(whole), F.max("order_date").over(whole), preset, today
    )
    day = F.col("order_date")
    return (
        mart.filter(day.isNotNull())
        .withColumns({"_first": first, "_last": last})
        .filter(day.between(F.col("_first"), F.col("_last")))
        .drop("_first", "_last")
        .orderBy("order_date")
    )


def kpi_header(mart: DataFrame) -> DataFrame:
    """Headline figures as ratios of sums, not means of daily rates; zero-safe."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0).cast("bigint"))

    sums = mart.agg(
        total("total_orders").alias("orders"),
        total("total_gmv").alias("gmv"),
        total("delivered_orders").alias("delivered"),
        total("cancelled_orders").alias("cancelled"),
    )
    return sums.withColumns(
        {
            "average_order": share(F.col("gmv"), F.col("delivered")),
            "cancellation_rate": share(F.col("cancelled"), F.col("orders")),
        }
    )


def metric_trend(mart: DataFrame) -> DataFrame:
    """The plotted series in long form: order_date, metric, value."""
    values = [F.col(name).cast("double").alias(name) for name in TREND_METRICS]
    return mart.select("order_date", *values).unpivot(
        "order_date", list(TREND_METRICS), "metric", "value"
    )
