"""Raw events to clean events. The same steps serve batch frames and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderpulse import schemas
from orderpulse.functions.clock import parse_time

HEAD = ("event_id", "event_type", "order_id", "occurred_at", "customer_id", "vendor_id", "driver_id")

# Clean column -> field of the payload.
PAYLOAD_FIELDS = {
    "gmv": "gmv",
    "food_cost": "food_cost",
    "delivery_fee": "delivery_fee",
    "service_fee": "service_fee",
    "discount": "discount",
    "delivery_address": "delivery_address",
    "estimated_prep_minutes": "estimated_prep_minutes",
    "cancelled_by": "cancelled_by",
    "cancel_reason": "reason",
    "vehicle_type": "vehicle_type",
    "items": "items",
}


def read_payload(events: DataFrame) -> DataFrame:
    """Payload as JSON text to the union struct."""
    return events.withColumn("payload", F.from_json("payload", schemas.PAYLOAD))


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("occurred_at", parse_time("occurred_at"))


def flatten(events: DataFrame) -> DataFrame:
    """Event head plus the payload fields as top-level columns."""
    payload = F.col("payload")
    return events.select(
        *HEAD, *[payload[field].alias(name) for name, field in PAYLOAD_FIELDS.items()]
    )


def unreadable_times(events: DataFrame) -> DataFrame:
    """Raw events whose time text is present but cannot be read."""
    return events.filter(F.col("occurred_at").isNotNull() & parse_time("occurred_at").isNull())


def dedup(events: DataFrame, key: str = "event_id", first_by: list[str] | None = None) -> DataFrame:
    """One row per key: the earliest, ties broken by every other column.

    Keeping row_number() = 1 lets Spark drop copies before the shuffle as well, so a key
    that holds a large part of all rows costs one row per input task.
    """
    first_by = first_by or ["occurred_at"]
    rest = [name for name in events.columns if name not in (key, *first_by)]
    ranked = Window.partitionBy(key).orderBy(*first_by, *rest)
    return events.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def clean_events(events: DataFrame) -> DataFrame:
    """Batch form of the silver layer."""
    return dedup(flatten(with_event_time(events)))
