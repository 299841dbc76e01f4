"""Queries over the clean layer, the star schema and the daily mart."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.operators import cleaning, distinct, facts, mart, serving
from orderpulse.plans import duck
from orderpulse.session import work_folder
from orderpulse.sources import events as event_files
from orderpulse.sources import testdata

START, END = date(2024, 1, 8), date(2024, 1, 21)
TODAY = date(2024, 1, 30)
HISTORY_CUSTOMER = "7"


def orders(spark, sf_dir) -> DataFrame:
    return facts.order_lifecycle(testdata.silver_events(spark, sf_dir))


def daily(spark, sf_dir) -> DataFrame:
    return mart.daily_metrics(orders(spark, sf_dir))


def payload_flatten(spark, sf_dir) -> DataFrame:
    raw = testdata.bronze_events(spark, sf_dir)
    text = raw.withColumn("payload", F.to_json("payload"))
    return cleaning.flatten(cleaning.with_event_time(cleaning.read_payload(text))).drop("items")


def order_items(spark, sf_dir) -> DataFrame:
    return facts.order_items(testdata.placed_orders(spark, sf_dir))


def partitioned_event_counts(spark, sf_dir) -> DataFrame:
    path = work_folder(spark, "events")
    event_files.write_events(testdata.bronze_events(spark, sf_dir), path)
    return event_files.files_per_hour(spark, path)


def dim_passthrough(spark, sf_dir) -> DataFrame:
    dims = {
        "vendor": testdata.vendors(spark, sf_dir),
        "customer": testdata.customers(spark, sf_dir),
        "driver": testdata.drivers(spark, sf_dir),
        "menu_item": testdata.menu_items(spark, sf_dir),
    }
    return reduce(
        DataFrame.unionByName,
        [
            facts.dimension(rows).select(
                F.lit(name).alias("dim"), F.col(f"{name}_id").alias("dim_id"), "name"
            )
            for name, rows in dims.items()
        ],
    )


def _bitmaps(spark, sf_dir, column: str) -> DataFrame:
    """Stored bitmaps of the orders' days; the values are numbered in two steps, as a table that grows by days is."""
    rows = orders(spark, sf_dir).filter("placed_at IS NOT NULL").select("placed_at", column)
    early = distinct.numbered(rows.filter(F.col("placed_at") < F.to_timestamp(F.lit(str(START)))), column)
    base = work_folder(spark, f"distinct-{column}")
    early.write.parquet(f"{base}/early")
    distinct.numbered(rows, column, spark.read.parquet(f"{base}/early")).write.parquet(f"{base}/numbers")
    numbers = spark.read.parquet(f"{base}/numbers")
    distinct.daily_bitmaps(rows, F.to_date("placed_at"), column, numbers).write.parquet(f"{base}/days")
    return spark.read.parquet(f"{base}/days")


def distinct_per_week(spark, sf_dir) -> DataFrame:
    """Weekly distinct customers and vendors, from stored days only."""
    week = F.to_date(F.date_trunc("WEEK", "day")).alias("week")
    found = [
        distinct.distinct_over(_bitmaps(spark, sf_dir, key), week).withColumn("key", F.lit(key)) for key in ("customer_id", "vendor_id")
    ]
    return found[0].union(found[1])


def distinct_in_range(spark, sf_dir) -> DataFrame:
    """Distinct customers of a range of days, and of each day in it."""
    days = _bitmaps(spark, sf_dir, "customer_id").filter(F.col("day").between(START, END))
    whole = distinct.distinct_over(days).select(F.lit(None).cast("date").alias("day"), "values")
    return distinct.distinct_over(days, F.col("day")).union(whole)


QUERIES = {
    "distinct_per_week": distinct_per_week,
    "distinct_in_range": distinct_in_range,
    "order_lifecycle": orders,
    "daily_metrics": daily,
    "order_event_log": lambda s, d: facts.order_event_log(testdata.silver_events(s, d)),
    "payload_flatten": payload_flatten,
    "order_items": order_items,
    "dedup_events": lambda s, d: cleaning.dedup(testdata.line_events(s, d)),
    "partitioned_event_counts": partitioned_event_counts,
    "dim_passthrough": dim_passthrough,
    "dim_customer": lambda s, d: facts.dimension(testdata.customers(s, d)),
    "dim_vendor": lambda s, d: facts.dimension(testdata.vendors(s, d)),
    "dim_driver": lambda s, d: facts.dimension(testdata.drivers(s, d)),
    "dim_menu_item": lambda s, d: facts.dimension(testdata.menu_items(s, d)),
    "customer_history": lambda s, d: facts.order_event_log(
        serving.customer_history(testdata.silver_events(s, d), HISTORY_CUSTOMER)
    ),
    "date_range": lambda s, d: mart.date_range(daily(s, d)),
    "metrics_in_range": lambda s, d: mart.metrics_between(daily(s, d), START, END),
    "preset_range": lambda s, d: mart.preset_range(daily(s, d), "30d", TODAY),
    "metrics_in_preset": lambda s, d: mart.metrics_in_preset(daily(s, d), "7d", TODAY),
    "kpi_header": lambda s, d: mart.kpi_header(mart.metrics_between(daily(s, d), START, END)),
    "metric_trend": lambda s, d: mart.metric_trend(mart.metrics_between(daily(s, d), START, END)),
}


_LOG = (
    "event_id, event_type, order_id, occurred_at, customer_id, vendor_id, driver_id, "
    "cancelled_by, cancel_reason"
)
_RANGE = f"order_date BETWEEN DATE '{START}' AND DATE '{END}'"
_ENDS = f"""SELECT min(order_date) AS lo,
    CASE WHEN max(order_date) = DATE '{TODAY}' THEN max(order_date) - 1 ELSE max(order_date) END AS hi
  FROM mart"""

ORACLES = {
    "distinct_per_week": duck.with_tables(duck.ORDERS)
    + """SELECT CAST(date_trunc('week', placed_at) AS DATE) AS week, key, count(DISTINCT value) AS values
         FROM (SELECT placed_at, unnest(['customer_id', 'vendor_id']) AS key, unnest([customer_id, vendor_id]) AS value
               FROM fct_orders WHERE placed_at IS NOT NULL) WHERE value IS NOT NULL GROUP BY ALL""",
    "distinct_in_range": duck.with_tables(duck.ORDERS)
    + """SELECT CAST(placed_at AS DATE) AS day, count(DISTINCT customer_id) AS values FROM fct_orders
         WHERE CAST(placed_at AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'
         GROUP BY GROUPING SETS ((CAST(placed_at AS DATE)), ())""",
    "order_lifecycle": duck.with_tables(duck.ORDERS) + "SELECT * FROM fct_orders",
    "daily_metrics": duck.with_tables(duck.MART) + "SELECT * FROM mart",
    "order_event_log": duck.with_tables(duck.EVENTS) + f"SELECT {_LOG} FROM silver",
    "payload_flatten": duck.with_tables(duck.EVENTS) + "SELECT * FROM silver",
    "order_items": duck.with_tables(duck.LINES)
    + """SELECT l.order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           CAST(o_custkey % 10 AS VARCHAR) AS vendor_id, o_orderdate AS occurred_at,
           menu_item_id, item_name, quantity, unit_price, line_total
         FROM lines l JOIN orders ON l.order_id = CAST(o_orderkey AS VARCHAR)""",
    "dedup_events": duck.with_tables(duck.LINE_EVENTS) + "SELECT * FROM deduped",
    "partitioned_event_counts": """SELECT CAST(ts AS DATE) AS event_date,
           strftime(ts, '%H') AS event_hour, count(*) AS events
         FROM events GROUP BY 1, 2""",
    "dim_passthrough": duck.with_tables(duck.DIMENSIONS)
    + """SELECT 'vendor' AS dim, vendor_id AS dim_id, name FROM dim_vendor
         UNION ALL SELECT 'customer', customer_id, name FROM dim_customer
         UNION ALL SELECT 'driver', driver_id, name FROM dim_driver
         UNION ALL SELECT 'menu_item', menu_item_id, name FROM dim_menu_item""",
    "dim_customer": duck.with_tables(duck.DIMENSIONS) + "SELECT * FROM dim_customer",
    "dim_vendor": duck.with_tables(duck.DIMENSIONS) + "SELECT * FROM dim_vendor",
    "dim_driver": duck.with_tables(duck.DIMENSIONS) + "SELECT * FROM dim_driver",
    "dim_menu_item": duck.with_tables(duck.DIMENSIONS) + "SELECT * FROM dim_menu_item",
    "customer_history": duck.with_tables(duck.EVENTS)
    + f"""SELECT {_LOG} FROM silver WHERE customer_id = '{HISTORY_CUSTOMER}'
          ORDER BY occurred_at, event_id LIMIT 50""",
    "date_range": duck.with_tables(duck.MART)
    + """SELECT min(order_date) AS min_date, max(order_date) AS max_date
         FROM mart WHERE order_date IS NOT NULL""",
    "metrics_in_range": duck.with_tables(duck.MART) + f"SELECT * FROM mart WHERE {_RANGE}",
    "preset_range": duck.with_tables(duck.MART)
    + f"SELECT greatest(lo, hi - 29) AS start_date, hi AS end_date FROM ({_ENDS})",
    "metrics_in_preset": duck.with_tables(duck.MART)
    + f"""SELECT mart.* FROM mart, ({_ENDS})
          WHERE order_date BETWEEN greatest(lo, hi - 6) AND hi""",
    "kpi_header": duck.with_tables(duck.MART)
    + f"""SELECT orders, gmv, delivered, cancelled,
            gmv / greatest(delivered, 1) AS average_order,
            cancelled / greatest(orders, 1) AS cancellation_rate
          FROM (SELECT CAST(coalesce(sum(total_orders), 0) AS BIGINT) AS orders,
                  CAST(coalesce(sum(total_gmv), 0) AS BIGINT) AS gmv,
                  CAST(coalesce(sum(delivered_orders), 0) AS BIGINT) AS delivered,
                  CAST(coalesce(sum(cancelled_orders), 0) AS BIGINT) AS cancelled
                FROM mart WHERE {_RANGE})""",
    "metric_trend": duck.with_tables(duck.MART)
    + " UNION ALL ".join(
        f"SELECT order_date, '{name}' AS metric, CAST({name} AS DOUBLE) AS value FROM mart WHERE {_RANGE}"
        for name in mart.TREND_METRICS
    ),
}
