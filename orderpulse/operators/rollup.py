"""Hourly figures kept as partial aggregates per order date, refreshed for the dates that changed only.

The order fact and the rollup lie in folders by order date. A refresh reads the changed dates' folders, which Spark prunes
to, and replaces exactly their folders of the rollup by dynamic partition overwrite. Everything in a row can be summed, so
days, weekdays and baselines come from the rollup without the orders.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "order_date"


def _replace_dates(rows: DataFrame, path: str) -> None:
    writer = rows.write.mode("overwrite").partitionBy(DATE).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def store_orders(orders: DataFrame, path: str) -> None:
    """Replace the dates that `orders` holds, whole dates each; orders never placed have no date and no hour."""
    dated = orders.filter(F.col("placed_at").isNotNull()).withColumn(DATE, F.to_date("placed_at"))
    _replace_dates(dated.hint("rebalance", F.col(DATE)), path)


def changed_dates(orders: DataFrame, events: DataFrame) -> list[date]:
    """Order dates of the orders that have one of `events`: as many as calendar days at most."""
    touched = orders.join(events.select("order_id").distinct(), "order_id", "left_semi")
    return [r[0] for r in touched.select(F.to_date("placed_at")).filter("placed_at IS NOT NULL").distinct().collect()]


def orders_of(spark: SparkSession, path: str, dates: list[date] | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows if dates is None else rows.filter(F.col(DATE).isin(dates))


def hourly_parts(orders: DataFrame) -> DataFrame:
    """Summable figures per order date and hour."""
    done = F.col("final_status") == "delivered"
    return orders.groupBy(DATE, F.date_trunc("HOUR", "placed_at").alias("hr")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(done).alias("delivered"),
        F.count_if(F.col("final_status") == "cancelled").alias("cancelled"),
        F.coalesce(F.sum(F.when(done, F.col("gmv"))), F.lit(0)).alias("gmv"),
    )


def refresh(spark: SparkSession, orders_path: str, rollup_path: str, dates: list[date] | None = None) -> None:
    """Rebuild the rollup of `dates`, by default of all."""
    if dates is None or dates:
        _replace_dates(hourly_parts(orders_of(spark, orders_path, dates)), rollup_path)


def heatmap(rollup: DataFrame) -> DataFrame:
    """Orders per weekday (1 is Sunday) and hour of day."""
    return rollup.groupBy(F.dayofweek("hr").alias("dow"), F.hour("hr").alias("hour_of_day")).agg(F.sum("orders").alias("orders"))
