"""Layer monitoring as queries."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse import vocabulary as v
from orderpulse.operators import cleaning, facts, mart, monitoring
from orderpulse.operators.publish import publish
from orderpulse.plans import duck
from orderpulse.plans.facts import orders
from orderpulse.session import work_folder
from orderpulse.sources import testdata
from orderpulse.sources.tables import Layers, table_count

NOW = datetime(2001, 11, 8, 5, 7, 30)


def stats(spark, sf_dir) -> DataFrame:
    lines = testdata.line_events(spark, sf_dir)
    bronze = lines.withColumn("occurred_at", F.date_format("occurred_at", testdata.TIME_TEXT))
    silver = cleaning.dedup(lines)
    return monitoring.layer_stats(bronze, silver, facts.order_event_log(silver), len(v.GOLD_TABLES))


def without_silver(spark, sf_dir) -> DataFrame:
    return stats(spark, sf_dir).filter("layer <> 'silver'")


def gold_catalog(spark, sf_dir) -> DataFrame:
    """Every gold table published into a schema of its own, with its rows and the number of tables that the catalog holds."""
    layers = Layers(gold=f"gold_{uuid.uuid4().hex}")
    spark.sql(f"CREATE DATABASE {layers.gold} LOCATION '{work_folder(spark, 'gold')}'")
    silver, fact = testdata.silver_events(spark, sf_dir), orders(spark, sf_dir)
    tables = {
        "dim_vendor": testdata.vendors(spark, sf_dir), "dim_customer": testdata.customers(spark, sf_dir),
        "dim_driver": testdata.drivers(spark, sf_dir), "dim_menu_item": testdata.menu_items(spark, sf_dir),
        "fct_order_events": facts.order_event_log(silver), "fct_orders": fact, "fct_order_items": facts.order_items(silver),
    }
    for name, rows in tables.items():
        publish(spark, rows, layers.name("gold", name), folder=work_folder(spark, "published"))
    daily = mart.daily_metrics(layers.read(spark, "gold", "fct_orders"))
    publish(spark, daily, layers.name("gold", "fct_daily_metrics"), folder=work_folder(spark, "published"))
    found = [t.name for t in spark.catalog.listTables(layers.gold) if not t.isTemporary]
    counts = [layers.read(spark, "gold", name).agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name in found]
    return reduce(DataFrame.union, counts).withColumn("tables", F.lit(table_count(spark, layers.gold)).cast("long"))


def missing_hours(cap: int | None):
    def run(spark, sf_dir) -> DataFrame:
        return monitoring.missing_hours(orders(spark, sf_dir), "placed_at", cap_hours=cap)

    return run


def last_write_per_layer(spark, sf_dir) -> DataFrame:
    return monitoring.last_write(spark, {"bronze": sf_dir, "gold": sf_dir})


QUERIES = {
    "gold_catalog": gold_catalog,
    "layer_stats": stats,
    "layer_reconciliation": lambda s, d: monitoring.layer_reconciliation(stats(s, d)),
    "freshness": lambda s, d: monitoring.freshness(stats(s, d), NOW),
    "layer_reconciliation_missing": lambda s, d: monitoring.layer_reconciliation(without_silver(s, d)),
    "freshness_missing": lambda s, d: monitoring.freshness(without_silver(s, d), NOW),
    "missing_hours": missing_hours(v.BACKFILL_HOURS),
    "missing_hours_all": missing_hours(None),
    "last_write_per_layer": last_write_per_layer,
}

_STATS = (
    duck.with_tables(duck.LINE_EVENTS)
    + """, stats AS (
  SELECT unnest(['bronze', 'silver', 'gold', 'models']) AS layer, unnest([r.n, s.n, s.n, 8]) AS row_count,
    unnest([r.t, s.t, s.t, NULL]) AS last_event_at
  FROM (SELECT count(*) AS n, max(occurred_at) AS t FROM line_events) r,
    (SELECT count(*) AS n, max(occurred_at) AS t FROM deduped) s
)
"""
)
_NOTES = """MAP {'bronze': 'every row as delivered',
  'silver': 'repeated event ids and rows behind the watermark are removed',
  'gold': 'modelled from silver, expected to match it'}"""


def _gaps(first: str) -> str:
    return (
        duck.with_tables(duck.ORDERS)
        + f""", seen AS (
          SELECT DISTINCT date_trunc('hour', placed_at) AS hr FROM fct_orders WHERE placed_at IS NOT NULL
        )
        SELECT hr FROM (SELECT unnest(range({first}, max(hr), INTERVAL 1 HOUR)) AS hr FROM seen)
        WHERE hr NOT IN (SELECT hr FROM seen)"""
    )


_NO_SILVER = _STATS.replace(
    "unnest([r.n, s.n, s.n, 8]) AS row_count,\n    unnest([r.t, s.t, s.t, NULL])",
    "unnest([r.n, NULL, s.n, 8]) AS row_count,\n    unnest([r.t, NULL, s.t, NULL])",
)
assert _NO_SILVER != _STATS
_RECONCILE = f"""SELECT layer_rank, upper(layer[1]) || layer[2:] AS layer, row_count,
            before - row_count AS dropped, (before - row_count) / before * 100 AS dropped_pct,
            {_NOTES}[layer] AS why
          FROM (SELECT *, lag(row_count) OVER (ORDER BY layer_rank) AS before
                FROM (SELECT *, CAST(list_position(['bronze', 'silver', 'gold'], layer) AS INTEGER)
                        AS layer_rank FROM stats WHERE layer <> 'models'))"""
_FRESHNESS = f"""SELECT layer, last_event_at, m AS age_minutes,
            CASE WHEN m IS NULL THEN 'unknown' WHEN m < 10080 THEN 'live' ELSE 'delayed' END AS state,
            t AS age_text,
            CASE WHEN m IS NULL THEN 'no data yet' WHEN m < 1 THEN t ELSE t || ' ago' END AS ago_text,
            coalesce(m > 180, FALSE) AS stale_alert,
            CASE WHEN m IS NULL THEN 'data-missing' WHEN m >= 5760 THEN 'data-stale' ELSE 'ok' END AS outage
          FROM (SELECT *, CASE WHEN m IS NULL THEN '—' WHEN m < 1 THEN 'just now'
                  WHEN w >= 1440 THEN (w // 1440) || ' d' ||
                    CASE WHEN w % 1440 // 60 > 0 THEN ' ' || (w % 1440 // 60) || ' h' ELSE '' END
                  WHEN w >= 60 THEN (w // 60) || ' h' ||
                    CASE WHEN w % 60 > 0 THEN ' ' || (w % 60) || ' min' ELSE '' END
                  ELSE w || ' min' END AS t
                FROM (SELECT *, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(last_event_at)) / 60000000.0 AS m,
                        CAST(floor(m) AS BIGINT) AS w FROM stats WHERE layer <> 'models'))"""

ORACLES = {
    "gold_catalog": duck.with_tables(duck.MART, duck.DIMENSIONS)
    + """SELECT table_name, rows, 8::BIGINT AS tables FROM (
      SELECT 'dim_vendor' AS table_name, count(*) AS rows FROM dim_vendor
      UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
      UNION ALL SELECT 'dim_driver', count(*) FROM dim_driver
      UNION ALL SELECT 'dim_menu_item', count(*) FROM dim_menu_item
      UNION ALL SELECT 'fct_orders', count(*) FROM fct_orders
      UNION ALL SELECT 'fct_order_events', count(*) FROM silver
      UNION ALL SELECT 'fct_order_items', CAST(sum(k % 3 + 1) AS BIGINT) FROM kinds WHERE kind = 'order_placed'
      UNION ALL SELECT 'fct_daily_metrics', count(*) FROM mart)""",
    "layer_stats": _STATS + "SELECT * FROM stats",
    "layer_reconciliation": _STATS + _RECONCILE,
    "freshness": _STATS + _FRESHNESS,
    "layer_reconciliation_missing": _NO_SILVER + _RECONCILE,
    "freshness_missing": _NO_SILVER + _FRESHNESS,
    "missing_hours": _gaps("greatest(min(hr), max(hr) - INTERVAL 167 HOUR)"),
    "missing_hours_all": _gaps("min(hr)"),
}
