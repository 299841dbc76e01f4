"""From landed files to published tables, one function per layer.

A scheduled job calls them in order; each takes what is new or rebuilds its tables, and a
failed contract of severity error raises, so later layers are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession

from orderpulse.operators import contracts, facts, mart
from orderpulse.operators.publish import publish
from orderpulse.schemas import DIMENSIONS
from orderpulse.sources.dimensions import read_dimension
from orderpulse.sources.landing import FILES_PER_BATCH, stream_landing
from orderpulse.sources.tables import Layers, clustered, over_folder, refresh, table_folder
from orderpulse.streaming.flows import append, run_available
from orderpulse.streaming.merge import merge_stream, read_ledger

# Landed dimension -> gold table.
GOLD_DIMENSIONS = {
    "customers": "dim_customer",
    "vendors": "dim_vendor",
    "drivers": "dim_driver",
    "menu_items": "dim_menu_item",
}


def land_events(
    spark: SparkSession, layers: Layers, raw: str, checkpoint: str, files_per_batch: int | None = FILES_PER_BATCH
) -> list:
    """Append new event files to the bronze event table, whole: see sources/landing.py."""
    flow = append(stream_landing(spark, raw, files_per_batch), checkpoint)
    return run_available(flow, layers.name("bronze", "order_events"))


def land_dimensions(spark: SparkSession, layers: Layers, folder: str) -> None:
    """Replace the bronze dimension tables by `<folder>/<name>.csv`."""
    for name in DIMENSIONS:
        rows = read_dimension(spark, name, f"{folder}/{name}.csv")
        refresh(rows, layers.name("bronze", f"dim_{name}"))


def clean_events(
    spark: SparkSession, layers: Layers, checkpoint: str, files_per_batch: int | None = FILES_PER_BATCH
) -> list:
    """Insert what is new in bronze, cleaned, into the silver event table, which lies in folders by event date.

    The table is there as soon as a row was written."""
    name = layers.name("silver", "order_events")
    folder = table_folder(spark, name)
    bronze = layers.stream(spark, "bronze", "order_events", files_per_batch)
    progress = run_available(merge_stream(bronze, folder, checkpoint))
    if not read_ledger(spark, folder).filter("written > 0").isEmpty():
        over_folder(spark, name, folder)
    return progress


def build_gold(spark: SparkSession, layers: Layers, events: DataFrame | None = None) -> list[Row]:
    """Rebuild all gold tables from silver, auditing each before it is published."""
    severity = contracts.severity_for(layers.target)
    silver = layers.read(spark, "silver", "order_events") if events is None else events

    def gold(table: str) -> DataFrame:
        return layers.read(spark, "gold", table)

    def put(table: str, rows: DataFrame) -> list[Row]:
        rules = contracts.contracts_of(table)

        def audit(written: DataFrame) -> DataFrame:
            parents = {rule.parent for rule in rules if isinstance(rule, contracts.Relationship)}
            tables = {table: written, **{name: gold(name) for name in parents}}
            return contracts.dq_report(tables, rules, severity)

        return publish(spark, rows, layers.name("gold", table), audit if rules else None)

    report = contracts.enforce(
        contracts.dq_report({"silver": silver}, contracts.contracts_of("silver"), severity)
    )
    for landed, table in GOLD_DIMENSIONS.items():
        report += put(table, facts.dimension(layers.read(spark, "bronze", f"dim_{landed}")))
    report += put("fct_order_events", facts.order_event_log(silver))
    report += put("fct_order_items", facts.order_items(silver))
    # Readers ask for date ranges, and the aggregate leaves every date in every file.
    orders = clustered(facts.order_lifecycle(silver), "placed_at", "order_id")
    report += put("fct_orders", orders)
    report += put("fct_daily_metrics", mart.daily_metrics(gold("fct_orders")))
    return report
