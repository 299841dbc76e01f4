"""From files to published tables, and the CI gate over seed rows."""

import json
import os

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from orderpulse import vocabulary as v
from orderpulse.operators import checks, contracts, monitoring, serving
from orderpulse.plans import build
from orderpulse.schemas import ITEM
from orderpulse.sources.tables import Layers, table_count

DIMS = {
    "customers": ("customer_id,name,email,phone,city,lat,lon,registration_date", [
        f"eater-{x},{x.title()},{x}@post.test,,Ghent,51.0,3.7,2022-0{i}-17" for i, x in enumerate(("li", "mo", "unused"), 1)
    ]),
    "vendors": ("vendor_id,name,cuisine_type,city,lat,lon,avg_prep_minutes,rating", [
        "stall-soup,Soup Corner,Soups,Ghent,51.1,3.6,18,4.4", "stall-tea,Tea Room,Cakes,Ghent,51.1,3.8,6,4.9",
        "stall-new,Not Open Yet,Tapas,Ghent,51.2,3.9,30,",
    ]),
    "drivers": ("driver_id,name,vehicle_type,city,rating", ["bike-7,Sam,bike,Ghent,4.6", "bike-8,Alex,bike,Ghent,"]),
    "menu_items": ("menu_item_id,vendor_id,name,category,price,is_available", [
        "s1,stall-soup,Leek Soup,Soup,475,true", "s2,stall-soup,Bread,Side,150,false", "t1,stall-tea,Scone,Cake,320,true",
    ]),
}
MONEY = ("gmv", "food_cost", "delivery_fee", "service_fee", "discount")


def raw_lines(rows):
    """Seed rows as raw events; placed events carry two items."""
    for row in rows:
        seed = dict(zip(fx._FIELDS, row))
        names = {"order_placed": MONEY, "order_cancelled": ("cancelled_by",)}.get(seed["event_type"], ())
        payload = {name: seed[name] for name in names}
        if seed["event_type"] == "order_placed":
            payload["items"] = [{"menu_item_id": x, "name": x, "quantity": 2, "unit_price": 75, "line_total": 150} for x in ("s2", "t1")]
        if seed["event_type"] == "order_cancelled":
            payload["reason"] = seed["cancel_reason"]
        head = {k: seed[k] for k in ("event_id", "event_type", "order_id", "customer_id", "vendor_id", "driver_id")}
        yield head | {"occurred_at": seed["occurred_at"].isoformat() + "Z", "payload": payload}


def deliver(folder, name, rows, torn=()):
    os.makedirs(f"{folder}/some/where", exist_ok=True)
    with open(f"{folder}/some/where/{name}.jsonl", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in raw_lines(rows))
        f.writelines(line + "\n" for line in torn)


def write_dims(folder):
    os.makedirs(folder, exist_ok=True)
    for name, (head, lines) in DIMS.items():
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write("\n".join([head, *lines]) + "\n")


def with_items(seed):
    """Seed rows have no baskets; the silver table always has the column."""
    return seed.withColumn("items", F.lit(None).cast(f"array<{ITEM}>"))


def test_files_to_gold(spark, tmp_path):
    layers = Layers("e2e_bronze", "e2e_silver", "e2e_gold")
    layers.create_schemas(spark)
    raw = str(tmp_path / "raw")
    write_dims(str(tmp_path / "dims"))

    def run():
        build.land_events(spark, layers, raw, str(tmp_path / "c1"))
        build.land_dimensions(spark, layers, str(tmp_path / "dims"))
        build.clean_events(spark, layers, str(tmp_path / "c2"))
        return build.build_gold(spark, layers)

    deliver(raw, "first", fx.CLEAN, torn=['{"event_id": "half'])
    assert {line.status for line in run()} == {"pass"}
    deliver(raw, "replayed", fx.CLEAN)
    assert {line.status for line in run()} == {"pass"}

    def gold(name):
        return layers.read(spark, "gold", name)

    assert table_count(spark, "e2e_gold") == len(v.GOLD_TABLES) == 8
    assert {t.name for t in spark.catalog.listTables("e2e_gold") if not t.isTemporary} == set(v.GOLD_TABLES)
    bronze, silver = (layers.read(spark, layer, "order_events") for layer in ("bronze", "silver"))
    stats = monitoring.layer_stats(bronze, silver, gold("fct_order_events"), table_count(spark, "e2e_gold"))
    assert fx.rows(stats, "layer", "row_count") == [("bronze", 21), ("gold", 10), ("models", 8), ("silver", 10)]
    assert fx.rows(bronze.filter("corrupt_record IS NOT NULL"), "corrupt_record", "event_id") == [('{"event_id": "half', None)]
    plan = silver.filter("event_date = DATE'2025-03-10'")
    assert plan.count() == 3 and {f.split("/")[-3] for f in plan.inputFiles()} >= {"event_date=2025-03-10"}
    assert fx.rows(gold("fct_orders"), "order_id", "final_status", "driver_id") == [
        ("north-1", "delivered", "bike-7"), ("north-2", "confirmed", None), ("west-1", "cancelled", None)
    ]
    assert gold("fct_order_items").count() == 6
    assert [r.cancellation_rate for r in gold("fct_daily_metrics").orderBy("order_date").collect()] == [0.0, 1.0]
    top = serving.top_vendors(gold("fct_orders"), gold("dim_vendor")).collect()
    assert [(r.vendor_name, r.orders, r.gmv) for r in top] == [("Soup Corner", 2, 2450), ("Tea Room", 1, None)]
    issues = checks.known_issues(gold("fct_orders"), gold("fct_order_events"), gold("dim_vendor"))
    assert issues.first().total_issues == 0


def test_ci_gate_on_seed_rows(spark, tmp_path):
    write_dims(str(tmp_path / "dims"))
    ci = Layers(target="ci", ci_schema="e2e_ci")
    ci.create_schemas(spark)
    build.land_dimensions(spark, ci, str(tmp_path / "dims"))
    report = build.build_gold(spark, ci, with_items(fx.events(spark, fx.CLEAN)))
    assert len(report) == 8 and {(r.severity, r.status) for r in report} == {("error", "pass")}
    with pytest.raises(contracts.ContractViolation, match="unique"):
        build.build_gold(spark, ci, with_items(fx.events(spark, fx.BAD)))
    assert ci.read(spark, "gold", "fct_orders").count() == 3

    prod = Layers("e2e_ci", "e2e_ci", "e2e_ci")
    warned = build.build_gold(spark, prod, with_items(fx.events(spark, fx.BAD)))
    assert {r.status for r in warned} == {"pass", "warn"}
    assert prod.read(spark, "gold", "fct_orders").count() == 9


def test_failed_fact_stops_the_mart(spark, tmp_path):
    write_dims(str(tmp_path / "dims"))
    ci = Layers(target="ci", ci_schema="e2e_stop")
    ci.create_schemas(spark)
    build.land_dimensions(spark, ci, str(tmp_path / "dims"))
    with pytest.raises(contracts.ContractViolation, match="accepted_range"):
        build.build_gold(spark, ci, with_items(fx.events(spark, fx.with_defect("negative amount"))))
    assert spark.catalog.tableExists("e2e_stop.fct_order_events")
    assert not spark.catalog.tableExists("e2e_stop.fct_orders")
    assert not spark.catalog.tableExists("e2e_stop.fct_daily_metrics")
