"""Operational questions over the gold layer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderpulse import vocabulary as v
from orderpulse.functions.clock import days_until_today, weekday_label, within_days
from orderpulse.functions.lifecycle import actor_rank, cancel_actor, readable

HOURS = range(24)


def placed_between(orders: DataFrame, start: date, end: date) -> DataFrame:
    """Orders placed in an inclusive date range; never-placed orders drop out."""
    return orders.filter(within_days(F.col("placed_at"), start, end))


def hourly_volume(orders: DataFrame) -> DataFrame:
    return (
        orders.filter(F.col("placed_at").isNotNull())
        .groupBy(F.date_trunc("HOUR", "placed_at").alias("hr"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def volume_vs_baseline(
    orders: DataFrame, window: int | str = "72h", exclude_current: bool = False
) -> DataFrame:
    """Orders per hour against the mean of the same hour of day over the last seven days.

    `window` is a number of hours or one of the presets. Both spans end at the newest
    order, and by default the seven days include the displayed hours. Orders are reduced to hours once; both figures and the join on the
    hour of day then work on a few hundred rows.
    """
    window_hours = int(v.WINDOW_HOURS.get(window, window))
    placed = F.col("placed_at").cast("timestamp")
    longest = max(window_hours, 24 * v.BASELINE_DAYS)
    # One subquery that gives the bound itself: only such a value is pushed to the scan.
    earliest = orders.agg(F.max(placed) - F.make_interval(hours=F.lit(longest))).scalar()
    shown_from = earliest + F.make_interval(hours=F.lit(longest - window_hours))
    baseline_from = earliest + F.make_interval(hours=F.lit(longest - 24 * v.BASELINE_DAYS))
    in_window = placed >= shown_from
    in_baseline = placed >= baseline_from
    if exclude_current:
        in_baseline = in_baseline & ~in_window
    hours = (
        orders.filter(placed >= earliest)
        .groupBy(F.date_trunc("HOUR", placed).alias("hr"))
        .agg(F.count_if(in_window).alias("orders"), F.count_if(in_baseline).alias("_past"))
    )
    same_hour = Window.partitionBy(F.hour("hr"))
    past = F.when(F.col("_past") > 0, F.col("_past"))
    return (
        hours.withColumn("expected", F.round(F.avg(past).over(same_hour), 0))
        .filter((F.col("orders") > 0) & F.col("expected").isNotNull())
        .select("hr", "orders", "expected")
        .orderBy("hr")
    )


def hour_heatmap(orders: DataFrame) -> DataFrame:
    """Orders per weekday (1 is Sunday) and hour."""
    return (
        orders.filter(F.col("placed_at").isNotNull())
        .groupBy(
            F.dayofweek("placed_at").alias("dow"), F.hour("placed_at").alias("hour_of_day")
        )
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def hour_heatmap_wide(orders: DataFrame, today: date) -> DataFrame:
    """The heatmap as a grid, hours with no orders as 0, today's weekday last."""
    cells = {f"h{hour:02d}": F.coalesce(F.col(str(hour)), F.lit(0)) for hour in HOURS}
    return (
        hour_heatmap(orders)
        .groupBy("dow")
        .pivot("hour_of_day", list(HOURS))
        .agg(F.sum("orders"))
        .select(
            weekday_label(F.col("dow")).alias("day"),
            days_until_today(F.col("dow"), today).alias("day_rank"),
            *[cell.cast("bigint").alias(name) for name, cell in cells.items()],
        )
        .orderBy("day_rank")
    )


def vendor_leaderboard(orders: DataFrame, vendors: DataFrame) -> DataFrame:
    """Orders, delivered GMV and cancellation rate per vendor name and cuisine.

    Orders are summed per vendor id before the join, so the join sees one row per vendor
    however many orders one vendor holds.
    """
    delivered = F.col("final_status") == "delivered"
    per_vendor = orders.groupBy("vendor_id").agg(
        F.count("order_id").alias("orders"),
        F.sum(F.when(delivered, F.col("gmv"))).alias("gmv"),
        F.count_if(F.col("final_status") == "cancelled").alias("cancelled"),
        F.count(F.lit(1)).alias("rows"),
    )
    names = vendors.select("vendor_id", F.col("name").alias("vendor_name"), "cuisine_type")
    rate = F.round(F.sum("cancelled") / F.sum("rows"), 3)
    return (
        per_vendor.join(names, "vendor_id")
        .groupBy("vendor_name", "cuisine_type")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("gmv").alias("gmv"),
            rate.alias("cancellation_rate"),
        )
    )


def top_vendors(orders: DataFrame, vendors: DataFrame, n: int = 10) -> DataFrame:
    board = vendor_leaderboard(orders, vendors)
    return board.orderBy(F.desc_nulls_last("gmv"), "vendor_name", "cuisine_type").limit(n)


def cancellation_reasons(orders: DataFrame) -> DataFrame:
    """Cancelled orders by actor and reason, in the fixed actor order, largest first."""
    actor = cancel_actor(F.col("cancelled_by"))
    return (
        orders.filter((F.col("final_status") == "cancelled") & F.col("placed_at").isNotNull())
        .groupBy("cancelled_by", "cancel_reason")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumns(
            {
                "actor": actor,
                "actor_rank": actor_rank(actor),
                "reason_label": readable(F.col("cancel_reason")),
            }
        )
        .orderBy("actor_rank", F.desc("cnt"), "cancelled_by", "cancel_reason")
    )


def customer_history(events: DataFrame, customer_id: str, n: int = 50) -> DataFrame:
    """A customer's first n events by time."""
    return (
        events.filter(F.col("customer_id") == customer_id)
        .orderBy("occurred_at", "event_id")
        .limit(n)
    )
