"""The given test tables, read as the layers of the order model.

The tables hold no deliveries, so columns are renamed or derived by the rules below; `k`
is the number in the events' JSON column `props`. `orderpulse/plans/duck.py` states the
same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse import schemas
from orderpulse.operators.cleaning import HEAD, PAYLOAD_FIELDS
from orderpulse.operators.facts import assemble_baskets, line_blocks
from orderpulse.session import use_utc

BASKET_LINES = 100_000  # the most lines of an order in one array
TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


# Column types of the tables, so that opening one reads no file footer.
COLUMNS = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


# ---- events as order events ----------------------------------------------------------

KIND = """
  CASE WHEN event_type = 'view' THEN 'order_placed'
       WHEN event_type = 'click' THEN 'order_confirmed'
       WHEN event_type = 'signup' AND k < 50 THEN 'order_prepared'
       WHEN event_type = 'signup' THEN 'order_picked_up'
       WHEN event_type = 'purchase' THEN 'order_delivered'
       WHEN k < 90 THEN 'order_cancelled'
       WHEN k < 95 THEN 'basket_reordered'
       ELSE 'tip_requested' END AS kind"""

EVENT_COLUMNS = {
    "event_id": "string(event_id)",
    "event_type": "kind",
    "order_id": "concat_ws('-', string(user_id), string(to_date(ts)))",
    "occurred_at": "timestamp(ts)",
    "customer_id": "if(k = 13 AND kind = 'order_confirmed', NULL, string(user_id))",
    "vendor_id": """CASE WHEN k = 77 THEN 'vendor-unlisted'
                         WHEN NOT (k = 14 AND kind = 'order_confirmed') THEN string(user_id % 10) END""",
    "driver_id": "if(kind IN ('order_picked_up', 'order_delivered') AND k % 10 <> 0, string(k % 10), NULL)",
    "gmv": "if(kind = 'order_placed', cents + service - cut + if(k < 97, 200, 0), NULL)",
    "food_cost": "if(kind = 'order_placed', cents, NULL)",
    "delivery_fee": "if(kind = 'order_placed', 200L, NULL)",
    "service_fee": "if(kind = 'order_placed', service, NULL)",
    "discount": "if(kind = 'order_placed', cut, NULL)",
    "delivery_address": "if(kind = 'order_placed', concat('street ', k), NULL)",
    "estimated_prep_minutes": "if(kind = 'order_confirmed', bigint(k), NULL)",
    "cancelled_by": """if(kind = 'order_cancelled', element_at(
        array('customer', 'vendor', 'driver', 'system', 'courier'), k % 5 + 1), NULL)""",
    "cancel_reason": """if(kind = 'order_cancelled', element_at(
        array('changed_mind', 'too_busy', 'payment_failed'), k % 3 + 1), NULL)""",
    "vehicle_type": """if(kind = 'order_picked_up', element_at(
        array('cargo bike', 'scooter', 'van'), k % 3 + 1), NULL)""",
    "items": f"""CAST(if(kind = 'order_placed', transform(sequence(1, k % 3 + 1), i -> named_struct(
        'menu_item_id', concat('m', k + i), 'name', concat('dish ', i), 'quantity', i, 'unit_price', cents,
        'line_total', cents * i)), NULL) AS array<{schemas.ITEM}>)""",
}


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the clean layer."""
    return (
        table(spark, sf_dir, "events")
        .selectExpr("*", "from_json(props, 'k int').k AS k", "bigint(round(value * 100)) AS cents")
        .selectExpr("*", KIND, "floor(cents / 20) AS service", "if(k < 20, 500L, 0L) AS cut")
        .selectExpr(*[f"{rule} AS {name}" for name, rule in EVENT_COLUMNS.items()])
    )


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as delivered: time as ISO text, details nested in the payload."""
    fields = {field: F.col(name) for name, field in PAYLOAD_FIELDS.items()}
    fields["driver_id"] = F.when(F.col("event_type") == "order_picked_up", F.col("driver_id"))
    payload = F.struct(*[column.alias(field) for field, column in fields.items()])
    return (
        silver_events(spark, sf_dir)
        .withColumn("payload", payload)
        .withColumn("occurred_at", F.date_format("occurred_at", TIME_TEXT))
        .select(*HEAD, "payload")
    )


LINE = """concat(
  '{"event_id":"', event_id, '","event_type":"', kind, '"', if(k % 10 = 3, concat(',"app_version":', k), ''),
  ',"payload":{"estimated_prep_minutes":', k,
  CASE k % 10 WHEN 4 THEN concat(',"gmv":"', cents, ' EUR"') WHEN 5 THEN concat(',"gmv":', cents, '.5')
              ELSE concat(',"gmv":', cents) END,
  if(k % 10 = 6, ',"channel":{"name":"web"}', ''),
  CASE k % 10 WHEN 7 THEN concat(',"items":[{"menu_item_id":"m', k, '","quantity":1,"spice":2}]')
              WHEN 8 THEN concat(',"items":[{"menu_item_id":"m', k, '","quantity":1}]') ELSE '' END,
  '}}')"""


def delivered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lines of event files, of which some have drifted and some are torn."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "*", "from_json(props, 'k int').k AS k", "bigint(round(value * 100)) AS cents"
    )
    lines = rows.selectExpr("event_id", "k", KIND, "cents").selectExpr("event_id", "k", f"{LINE} AS line")
    return lines.selectExpr(
        "CASE k WHEN 41 THEN left(line, length(line) - 3) WHEN 42 THEN concat('[', event_id, ']') ELSE line END AS value"
    )


# ---- orders and lines as order facts -------------------------------------------------


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as basket rows."""
    quantity = F.col("l_quantity").cast("bigint")
    total = _cents("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        _text("l_partkey").alias("menu_item_id"),
        F.concat(F.lit("part "), _text("l_partkey")).alias("item_name"),
        quantity.alias("quantity"),
        F.floor(total / quantity).alias("unit_price"),
        total.alias("line_total"),
    )


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as placed events with nested items; an order without lines has NULL items.

    An order has a row for each block of lines that it is found in, so no array grows with the order.
    """
    baskets = assemble_baskets(line_blocks(order_lines(spark, sf_dir), BASKET_LINES), part="part")
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.lit("order_placed").alias("event_type"),
            _text("o_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("occurred_at"),
            _text("o_custkey").alias("customer_id"),
            _text(F.col("o_custkey") % 10).alias("vendor_id"),
        )
        .join(baskets, "order_id", "left")
    )


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the order fact; the vendor is the smallest supplier among its lines.

    Lines are reduced to one row per order before the join.
    """
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("l_suppkey"), F.max("l_shipdate").alias("l_shipdate"))
    )
    status = F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            _text("o_orderkey").alias("order_id"),
            _text("o_custkey").alias("customer_id"),
            _text("l_suppkey").alias("vendor_id"),
            F.col("o_orderdate").alias("placed_at"),
            F.when(status == "F", F.col("l_shipdate")).alias("delivered_at"),
            _cents("o_totalprice").alias("gmv"),
            _cents("o_totalprice").alias("food_cost"),
            F.when(status == "F", "delivered")
            .when(status == "P", "cancelled")
            .otherwise("placed")
            .alias("final_status"),
        )
    )


# ---- lines as an event log with repeated ids -----------------------------------------


def line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as events keyed by order and line number, which repeat."""
    kind = (
        F.when(F.col("l_returnflag") == "R", "order_cancelled")
        .when(F.col("l_returnflag") == "A", "order_delivered")
        .otherwise("order_placed")
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("event_id"),
        kind.alias("event_type"),
        _text("l_orderkey").alias("order_id"),
        F.col("l_shipdate").alias("occurred_at"),
        _text("l_partkey").alias("customer_id"),
        _text("l_suppkey").alias("vendor_id"),
        F.lit(None).cast("string").alias("driver_id"),
        _cents("l_extendedprice").alias("gmv"),
        F.lit(None).cast("string").alias("cancelled_by"),
        F.lit(None).cast("string").alias("cancel_reason"),
    )


# ---- dimensions ----------------------------------------------------------------------


def _with_nation(rows: DataFrame, key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(key), "n_name")
    return rows.join(nations, key, "left")


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_nation(table(spark, sf_dir, "supplier"), "s_nationkey", spark, sf_dir)
    return rows.select(
        _text("s_suppkey").alias("vendor_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("cuisine_type"),
        F.col("n_name").alias("city"),
        (F.col("s_nationkey") + 10).alias("avg_prep_minutes"),
        F.col("s_acctbal").alias("rating"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_nation(table(spark, sf_dir, "customer"), "c_nationkey", spark, sf_dir)
    return rows.select(
        _text("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("city"),
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_nation(table(spark, sf_dir, "supplier"), "s_nationkey", spark, sf_dir)
    return rows.select(
        _text("s_suppkey").alias("driver_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("city"),
        F.col("s_acctbal").alias("rating"),
    )


def menu_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("menu_item_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.round("p_retailprice").cast("int").alias("price"),
        (F.col("p_size") > 0).alias("is_available"),
    )
