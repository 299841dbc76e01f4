"""Queries that answer operational questions over the order fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from orderpulse.operators import facts, rollup, serving
from orderpulse.plans import duck
from orderpulse.plans.facts import orders
from orderpulse.session import work_folder
from orderpulse.sources import testdata

TODAY = date(2024, 1, 31)
VENDOR_START, VENDOR_END = date(1997, 1, 1), date(1999, 12, 31)
EVENT_START, EVENT_END = date(2024, 1, 10), date(2024, 1, 19)  # a part of the days that the events cover


def in_range(spark, sf_dir):
    return serving.placed_between(orders(spark, sf_dir), EVENT_START, EVENT_END)


def top_vendors(spark, sf_dir):
    placed = serving.placed_between(testdata.order_facts(spark, sf_dir), VENDOR_START, VENDOR_END)
    return serving.top_vendors(placed, testdata.vendors(spark, sf_dir))


def hourly_rollup(spark, sf_dir):
    """Stored hourly figures, built over the first half of the events and refreshed for the dates that the second changed."""
    base, events = work_folder(spark, "rollup"), testdata.silver_events(spark, sf_dir)
    fact, rolled = f"{base}/orders", f"{base}/hours"
    rollup.store_orders(facts.order_lifecycle(events.filter("occurred_at < '2024-01-15 12:00:00'")), fact)
    rollup.refresh(spark, fact, rolled)
    every = facts.order_lifecycle(events)
    dates = rollup.changed_dates(every, events.filter("occurred_at >= '2024-01-15 12:00:00'"))
    rollup.store_orders(every.filter(F.to_date("placed_at").isin(dates)), fact)
    rollup.refresh(spark, fact, rolled, dates)
    return spark.read.parquet(rolled)


QUERIES = {
    "hourly_rollup": hourly_rollup,
    "hourly_volume": lambda s, d: serving.hourly_volume(orders(s, d)),
    "volume_vs_baseline": lambda s, d: serving.volume_vs_baseline(orders(s, d)),
    "volume_vs_baseline_14d": lambda s, d: serving.volume_vs_baseline(orders(s, d), "14d"),
    "hour_heatmap": lambda s, d: serving.hour_heatmap(orders(s, d)),
    "hour_heatmap_range": lambda s, d: serving.hour_heatmap(in_range(s, d)),
    "cancellation_reasons_range": lambda s, d: serving.cancellation_reasons(in_range(s, d)),
    "hour_heatmap_wide": lambda s, d: serving.hour_heatmap_wide(orders(s, d), TODAY),
    "top_vendors": top_vendors,
    "cancellation_reasons": lambda s, d: serving.cancellation_reasons(orders(s, d)),
}


def _volume(hours: int) -> str:
    return (
        duck.with_tables(duck.ORDERS)
        + f""", placed AS (
          SELECT placed_at AS t, max(placed_at) OVER () - placed_at AS age FROM fct_orders WHERE placed_at IS NOT NULL
        ),
        per_hour AS (
          SELECT date_trunc('hour', t) AS hr, count(*) FILTER (WHERE age <= INTERVAL {hours} HOUR) AS orders,
            count(*) FILTER (WHERE age <= INTERVAL 168 HOUR) AS week
          FROM placed GROUP BY ALL
        ),
        leveled AS (SELECT hr, orders, avg(nullif(week, 0)) OVER (PARTITION BY hour(hr)) AS level FROM per_hour)
        SELECT hr, orders, round(level, 0) AS expected FROM leveled WHERE orders > 0 AND level IS NOT NULL"""
    )


_RANGE = f"placed_at >= TIMESTAMP '{VENDOR_START}' AND placed_at < TIMESTAMP '{VENDOR_END}' + INTERVAL 1 DAY"
_EVENT_RANGE = "CAST(placed_at AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'"
_HEATMAP = """SELECT CAST(dayofweek(placed_at) + 1 AS INTEGER) AS dow,
    CAST(hour(placed_at) AS INTEGER) AS hour_of_day, count(*) AS orders
  FROM fct_orders WHERE placed_at IS NOT NULL GROUP BY 1, 2"""

_CELLS = ", ".join(
    f"CAST(coalesce(sum(orders) FILTER (WHERE hour_of_day = {h}), 0) AS BIGINT) AS h{h:02d}"
    for h in serving.HOURS
)
_TODAY_CODE = TODAY.isoweekday() % 7 + 1

_REASONS = """SELECT cancelled_by, cancel_reason, count(*) AS cnt, any_value(who) AS actor,
    CAST(any_value(CASE who WHEN 'customer' THEN 1 WHEN 'vendor' THEN 2 WHEN 'driver' THEN 3 WHEN 'system' THEN 4
      ELSE 5 END) AS INTEGER) AS actor_rank,
    any_value(replace(cancel_reason, '_', ' ')) AS reason_label
  FROM (SELECT *, if(coalesce(cancelled_by, '') IN ('customer', 'vendor', 'driver', 'system'), cancelled_by, 'other') AS who
        FROM fct_orders WHERE final_status = 'cancelled' AND {})
  GROUP BY cancelled_by, cancel_reason"""

ORACLES = {
    "hourly_rollup": duck.with_tables(duck.ORDERS)
    + """SELECT CAST(placed_at AS DATE) AS order_date, date_trunc('hour', placed_at) AS hr, count(*) AS orders,
           count(*) FILTER (WHERE delivered_at IS NOT NULL) AS delivered,
           count(*) FILTER (WHERE delivered_at IS NULL AND cancelled_at IS NOT NULL) AS cancelled,
           CAST(coalesce(sum(gmv) FILTER (WHERE delivered_at IS NOT NULL), 0) AS BIGINT) AS gmv
         FROM fct_orders WHERE placed_at IS NOT NULL GROUP BY ALL""",
    "hourly_volume": duck.with_tables(duck.ORDERS)
    + """SELECT date_trunc('hour', placed_at) AS hr, count(*) AS orders
         FROM fct_orders WHERE placed_at IS NOT NULL GROUP BY 1""",
    "volume_vs_baseline": _volume(72),
    "volume_vs_baseline_14d": _volume(336),
    "hour_heatmap": duck.with_tables(duck.ORDERS) + _HEATMAP,
    "hour_heatmap_wide": duck.with_tables(duck.ORDERS)
    + f"""SELECT ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][dow] AS day,
            CAST((dow - {_TODAY_CODE} - 1 + 14) % 7 AS INTEGER) AS day_rank, {_CELLS}
          FROM ({_HEATMAP}) GROUP BY dow""",
    "top_vendors": duck.with_tables(duck.ORDER_FACTS, duck.DIMENSIONS)
    + f""", sales AS (
            SELECT vendor_id, count(*) AS orders, sum(gmv) FILTER (WHERE final_status = 'delivered') AS gmv,
              avg(CASE final_status WHEN 'cancelled' THEN 1.0 ELSE 0.0 END) AS share
            FROM order_facts WHERE {_RANGE} GROUP BY vendor_id)
          SELECT name AS vendor_name, cuisine_type, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(gmv) AS BIGINT) AS gmv,
            round(sum(share * orders) / sum(orders), 3) AS cancellation_rate
          FROM dim_vendor JOIN sales USING (vendor_id) GROUP BY ALL
          ORDER BY gmv DESC NULLS LAST, vendor_name, cuisine_type LIMIT 10""",
    "cancellation_reasons": duck.with_tables(duck.ORDERS) + _REASONS.format("placed_at IS NOT NULL"),
    "cancellation_reasons_range": duck.with_tables(duck.ORDERS) + _REASONS.format(_EVENT_RANGE),
    "hour_heatmap_range": duck.with_tables(duck.ORDERS) + _HEATMAP.replace("placed_at IS NOT NULL", _EVENT_RANGE),
}
