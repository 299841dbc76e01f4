"""The star schema: order, order-item and event facts, and Type-1 dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse import vocabulary as v
from orderpulse.functions.lifecycle import final_status

EVENT_LOG = (
    "event_id",
    "event_type",
    "order_id",
    "occurred_at",
    "customer_id",
    "vendor_id",
    "driver_id",
    "cancelled_by",
    "cancel_reason",
)

ITEM_COLUMNS = {
    "menu_item_id": "menu_item_id",
    "item_name": "name",
    "quantity": "quantity",
    "unit_price": "unit_price",
    "line_total": "line_total",
}


def _largest_on(event_type: str, column: str, alias: str) -> Column:
    return F.max(F.when(F.col("event_type") == event_type, F.col(column))).alias(alias)


def _earliest_known(column: str) -> Column:
    """First non-null value by event time, then event id: the same on every run.

    Time, id and value travel in one struct; its minimum carries the value along.
    """
    untimed = F.col("occurred_at").isNull().alias("untimed")
    first = F.min(
        F.when(F.col(column).isNotNull(), F.struct(untimed, "occurred_at", "event_id", column))
    )
    return first[column].alias(column)


def order_lifecycle(events: DataFrame) -> DataFrame:
    """One row per order: keys, stage times, measures, cancel context and final status."""
    columns = [
        *[_earliest_known(key) for key in v.ORDER_KEYS],
        *[_largest_on(kind, "occurred_at", stage) for stage, kind in v.STAGE_EVENTS.items()],
        *[_largest_on("order_placed", name, name) for name in v.PLACED_MEASURES],
        *[_largest_on("order_cancelled", name, name) for name in v.CANCEL_CONTEXT],
    ]
    return events.groupBy("order_id").agg(*columns).withColumn("final_status", final_status())


def order_items(events: DataFrame) -> DataFrame:
    """One row per item of a placed order; no items, no rows."""
    placed = events.filter(F.col("event_type") == "order_placed")
    fields = [f"item.{field} AS {name}" for name, field in ITEM_COLUMNS.items()]
    head = ("order_id", "customer_id", "vendor_id", "occurred_at")
    return placed.select(*head, F.explode("items").alias("item")).selectExpr(*head, *fields)


def order_event_log(events: DataFrame) -> DataFrame:
    return events.select(*EVENT_LOG)


def dimension(rows: DataFrame) -> DataFrame:
    """Type-1 dimension: the landed rows as they are."""
    return rows


def line_blocks(lines: DataFrame, size: int, name: str = "part") -> DataFrame:
    """Add the block of at most `size` lines that a line was read in, whatever the lines hold.

    Use it right on a scan, where a task that runs again reads the same lines in the same order.
    """
    return lines.withColumn(name, F.floor(F.monotonically_increasing_id() / size))


def assemble_baskets(lines: DataFrame, key: str = "order_id", parts: int = 1, part: str | None = None) -> DataFrame:
    """Item rows to `items` arrays, one per order and part; exploding them gives the same item rows.

    `part` names a column, such as that of `line_blocks`, which bounds an array however many lines an order has
    and however equal they are. Without it, an order's items are dealt by their content to `parts` arrays.
    """
    item = F.struct(*[F.col(name).alias(field) for name, field in ITEM_COLUMNS.items()])
    dealt = F.col(part) if part else F.pmod(F.xxhash64(*ITEM_COLUMNS), F.lit(parts))
    return lines.groupBy(key, dealt.alias("part")).agg(F.sort_array(F.collect_list(item)).alias("items"))
