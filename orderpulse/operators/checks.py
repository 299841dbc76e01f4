"""Rules of the order process, checked over clean events and order facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse import vocabulary as v
from orderpulse.functions.lifecycle import is_legal_step
from orderpulse.operators.skew import with_previous

DRIVER_EVENTS = ("order_picked_up", "order_delivered")


def illegal_transitions(events: DataFrame) -> DataFrame:
    """Events that may not follow the one before them in their order."""
    steps = with_previous(
        events.select("order_id", "event_id", "occurred_at", "event_type"),
        key="order_id",
        time="occurred_at",
        tie="event_id",
        value="event_type",
        alias="previous_type",
    )
    return steps.filter(~is_legal_step(F.col("previous_type"), F.col("event_type")))


def amount_mismatches(orders: DataFrame) -> DataFrame:
    """Orders whose GMV is not food cost plus fees minus discount."""
    expected = F.col("food_cost") + F.col("delivery_fee") + F.col("service_fee") - F.col("discount")
    return _mismatches(orders, "gmv", "order_id", expected, F.col("gmv"))


def line_mismatches(items: DataFrame) -> DataFrame:
    """Items whose line total is not unit price times quantity."""
    expected = F.col("unit_price") * F.col("quantity")
    return _mismatches(items, "line_total", "order_id", expected, F.col("line_total"))


def food_cost_mismatches(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose food cost is not the sum of their lines; orders without lines are left out.

    Lines are summed per order before the join.
    """
    sums = items.groupBy("order_id").agg(F.sum("line_total").alias("_lines"))
    joined = orders.select("order_id", "food_cost").join(sums, "order_id")
    return _mismatches(joined, "food_cost", "order_id", F.col("_lines"), F.col("food_cost"))


def _mismatches(rows: DataFrame, rule: str, key: str, expected: Column, actual: Column) -> DataFrame:
    return rows.filter(expected != actual).select(
        F.lit(rule).alias("rule"),
        F.col(key),
        expected.cast("bigint").alias("expected"),
        actual.cast("bigint").alias("actual"),
    )


def amount_identity(orders: DataFrame, items: DataFrame) -> DataFrame:
    """All three amount rules: rule, order_id, expected, actual."""
    return (
        amount_mismatches(orders)
        .unionByName(line_mismatches(items))
        .unionByName(food_cost_mismatches(orders, items))
    )


def conflicting_duplicates(events: DataFrame) -> DataFrame:
    """Event ids shared by different events, with two of the events that clash.

    Deduplication would silently delete a real event here. Ids with one event only have
    equal smallest and largest identities, so one combinable aggregate finds the others.
    """
    identity = F.struct("order_id", "event_type")
    return (
        events.filter(F.col("event_id").isNotNull())
        .groupBy("event_id")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(identity).alias("_low"),
            F.max(identity).alias("_high"),
        )
        .filter(F.col("_low") != F.col("_high"))
        .select(
            "event_id",
            "copies",
            F.col("_low.order_id").alias("first_order_id"),
            F.col("_low.event_type").alias("first_event_type"),
            F.col("_high.order_id").alias("last_order_id"),
            F.col("_high.event_type").alias("last_event_type"),
        )
    )


def null_key_profile(events: DataFrame) -> DataFrame:
    """Missing keys per event type; a driver is only due from pickup on."""
    no_driver = F.col("driver_id").isNull() & F.col("event_type").isin(*DRIVER_EVENTS)
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("customer_id").isNull()).alias("no_customer"),
        F.count_if(F.col("vendor_id").isNull()).alias("no_vendor"),
        F.count_if(no_driver).alias("no_driver_after_pickup"),
    )


def known_issues(orders: DataFrame, events: DataFrame, vendors: DataFrame) -> DataFrame:
    """Tracked defects in one row: negative GMV, unknown event types, orphaned vendors.

    Orders are read once: both of their counts are taken per vendor and the vendors are
    matched afterwards.
    """
    per_vendor = orders.groupBy("vendor_id").agg(
        F.count_if(F.col("gmv") < 0).alias("negative"), F.count(F.lit(1)).alias("rows")
    )
    known = vendors.select("vendor_id").distinct().withColumn("_known", F.lit(True))
    orphan = F.col("_known").isNull() & F.col("vendor_id").isNotNull()
    of_orders = per_vendor.join(known, "vendor_id", "left").agg(
        _total(F.sum("negative")).alias("negative_gmv"),
        F.lit(0).cast("bigint").alias("unknown_event_types"),
        _total(F.sum(F.when(orphan, F.col("rows")))).alias("orphan_vendors"),
    )
    unknown = F.count_if(~F.col("event_type").isin(*v.EVENT_TYPES))
    of_events = events.agg(
        F.lit(0).cast("bigint").alias("negative_gmv"),
        unknown.alias("unknown_event_types"),
        F.lit(0).cast("bigint").alias("orphan_vendors"),
    )
    names = ("negative_gmv", "unknown_event_types", "orphan_vendors")
    return (
        of_orders.unionByName(of_events)
        .agg(*[F.sum(name).alias(name) for name in names])
        .withColumn("total_issues", sum((F.col(name) for name in names), F.lit(0)).cast("bigint"))
    )


def _total(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("bigint"))
