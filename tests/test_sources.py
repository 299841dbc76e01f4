import glob
import json
import os
from datetime import date

from datetime import datetime

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from orderpulse import schemas, session
from orderpulse.operators import cleaning, facts, serving
from orderpulse.sources import dimensions, events, tables


def write_lines(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(json.dumps(r, ensure_ascii=False) + "\n" for r in records)


RAW = [
    {"event_id": "1", "event_type": "order_placed", "order_id": "o", "occurred_at": "2024-01-15T12:00:00.000Z",
     "customer_id": "c", "vendor_id": "v", "driver_id": None,
     "payload": {"gmv": 1000, "delivery_address": "Évora", "items": [
         {"menu_item_id": "m", "name": "Pão", "quantity": 1, "unit_price": 900, "line_total": 900}]}},
    {"event_id": "2", "event_type": "order_cancelled", "order_id": "o", "occurred_at": "2024-01-15T13:00:00.000Z",
     "customer_id": "c", "vendor_id": "v", "driver_id": None,
     "payload": {"cancelled_by": "system", "reason": "timeout"}},
]


@pytest.fixture
def raw_folder(tmp_path):
    for event in RAW:
        hour = event["occurred_at"][11:13]
        write_lines(str(tmp_path / f"raw/2024-01-15/{hour}/events_{hour}.jsonl"), [event])
    return str(tmp_path / "raw")


def test_read_date_hour_folders(spark, raw_folder):
    fixed, inferred = events.read_events(spark, raw_folder), events.read_events(spark, raw_folder, None)
    for df in (fixed, inferred):
        got = fx.rows(df, "event_id", "payload.gmv", "payload.reason", F.col("payload.items")[0]["name"])
        assert got == [("1", 1000, None, "Pão"), ("2", None, "timeout", None)]
    assert dict(inferred.select("payload.*").dtypes)["gmv"] == "bigint"
    assert events.preview(fixed, 1).count() == 1


def test_items_survive_from_file_to_fact(spark, raw_folder):
    items = facts.order_items(cleaning.clean_events(events.read_events(spark, raw_folder)))
    assert fx.rows(items, "item_name", "line_total") == [("Pão", 900)]


def test_sink_layout_and_counts(spark, raw_folder, tmp_path):
    out = str(tmp_path / "out")
    source = events.read_events(spark, raw_folder)
    events.write_events(source, out)
    names = {os.path.relpath(os.path.dirname(p), out) for p in glob.glob(f"{out}/*/*/*.json")}
    assert names == {"event_date=2024-01-15/event_hour=12", "event_date=2024-01-15/event_hour=13"}
    text = "".join(open(p, encoding="utf-8").read() for p in glob.glob(f"{out}/*/*/*.json"))
    assert "Évora" in text
    assert fx.rows(events.read_events(spark, out), "*") == fx.rows(source, "*")
    want = fx.rows(events.events_per_hour(source), "event_date", "event_hour", "events")
    assert fx.rows(events.files_per_hour(spark, out), "event_date", "event_hour", "events") == want
    assert [r[1:] for r in want] == [("12", 1), ("13", 1)]


DIMS = {
    "customers": "customer_id,name,email,phone,city,lat,lon,registration_date\nc1,花子,a@b.c,080,Kyoto,34.9,135.7,2025-03-11\n",
    "vendors": "vendor_id,name,cuisine_type,city,lat,lon,avg_prep_minutes,rating\nv1,青空食堂,Pizza,Kyoto,34.9,135.7,22,4.4\n",
    "drivers": "driver_id,name,vehicle_type,city,rating\nd1,次郎,car,Nagoya,4.5\n",
    "menu_items": "menu_item_id,vendor_id,name,category,price,is_available\nm1,v1,Skewers,Main,1240,true\nm2,v1,Corn,Side,400,True\n",
}


@pytest.mark.parametrize("name", DIMS)
def test_dimensions_round_trip(spark, tmp_path, name):
    path = str(tmp_path / f"{name}.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(DIMS[name])
    fixed = dimensions.read_dimension(spark, name, path)
    inferred = dimensions.read_dimension(spark, name, path, infer=True)
    assert fixed.dtypes == inferred.dtypes or name == "customers"  # phone infers as a number
    dimensions.write_dimension(fixed, str(tmp_path / "copy"))
    again = dimensions.read_dimension(spark, name, str(tmp_path / "copy"))
    assert fx.rows(again, "*") == fx.rows(fixed, "*") == fx.rows(facts.dimension(fixed), "*")
    if name == "menu_items":
        assert fx.rows(fixed, "is_available") == [(True,), (True,)]


def test_seed_events(spark, tmp_path):
    path = str(tmp_path / "seed.csv")
    with open(path, "w") as f:
        f.write(",".join(p.split()[0] for p in schemas.SEED_EVENT.split(", ")) + "\n")
        f.write("17,order_cancelled,w9,2025-03-02T23:59:30.250Z,li,tea,bike,,,,,,system,payment_failed\n")
        f.write("18,order_placed,w8,,li,tea,,77,60,9,8,0,,\n")
    seed = dimensions.read_seed_events(spark, path)
    assert fx.rows(seed, "event_id", "occurred_at", "gmv", "driver_id", "cancel_reason") == [
        ("17", datetime(2025, 3, 2, 23, 59, 30, 250_000), None, "bike", "payment_failed"), ("18", None, 77, None, None)
    ]


def test_layers_and_catalog(spark):
    prod, ci = tables.Layers("b_x", "s_x", "g_x"), tables.Layers(target="ci", ci_schema="ci_x")
    assert prod.name("gold", "fct_orders") == "g_x.fct_orders"
    assert {ci.schema(layer) for layer in ("bronze", "silver", "gold")} == {"ci_x"}
    prod.create_schemas(spark)
    orders = facts.order_lifecycle(fx.events(spark, fx.CLEAN))
    tables.refresh(orders, prod.name("gold", "fct_orders"))
    tables.refresh(orders.limit(1), prod.name("gold", "fct_orders"))
    assert prod.read(spark, "gold", "fct_orders").count() == 1
    tables.refresh(orders, prod.name("gold", "other"))
    orders.createOrReplaceTempView("a_view")
    assert tables.table_count(spark, "g_x") == 2
    assert prod.stream(spark, "gold", "other").isStreaming


def test_bucketed_events_need_no_shuffle(spark):
    tables.refresh_bucketed(fx.events(spark, fx.BAD), "bucketed_events", "order_id", 4)
    plan = facts.order_lifecycle(spark.table("bucketed_events"))._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()


def test_clustered_files_do_not_overlap(spark, tmp_path):
    rows = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("day"), "id")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        tables.clustered(rows.repartition(4), "day", "id").write.parquet(str(tmp_path / "t"))
    finally:
        spark.conf.set(key, "true")
    spans = (
        spark.read.parquet(str(tmp_path / "t"))
        .groupBy(F.input_file_name().alias("file"))
        .agg(F.min(F.struct("day", "id")).alias("low"), F.max(F.struct("day", "id")).alias("high"))
        .orderBy("low")
        .collect()
    )
    assert len(spans) == 8 and all(a.high < b.low for a, b in zip(spans, spans[1:]))


def test_newest_run(spark):
    log = spark.createDataFrame([(1, fx.at(1, "10:00")), (2, fx.at(2, "10:00")), (3, None)], "id int, committed_at timestamp")
    newest = tables.newest_run(log)
    assert newest.first().id == 2
    assert "TakeOrderedAndProject" in newest._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.work_folder(spark, "x").startswith(named)


def test_a_hot_hour_is_written_by_several_tasks(spark, tmp_path):
    """AQE splits the one oversized hour of the rebalanced write."""
    hour = F.lit("2024-01-15T12:00:00.000Z")
    hot = spark.range(40_000).select(
        F.sha2(F.col("id").cast("string"), 512).alias("event_id"), hour.alias("occurred_at")
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        events.write_events(hot.repartition(8), str(tmp_path / "hot"))
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(f"{tmp_path}/hot/*/event_hour=12/*.json")) > 1


def test_time_ranges_skip_files(spark):
    """A stored, clustered fact has time statistics, so a range and the baseline's bound read a part of its rows."""
    orders = spark.range(100_000).selectExpr(
        "id AS order_id", "timestamp'2026-01-01' + make_interval(0, 0, 0, 0, cast(id / 50 AS int)) AS placed_at"
    )

    def rows_read(result):
        result.collect()
        leaves = result._jdf.queryExecution().executedPlan().collectLeaves()
        return [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())]

    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as many files as ranges, and a plan that tells its scans
    try:
        tables.refresh(tables.clustered(orders, "placed_at", "order_id"), "ranged_orders")
        stored = spark.table("ranged_orders")
        ranged = serving.placed_between(stored, date(2026, 1, 10), date(2026, 1, 11))
        assert ranged.count() == 2400 and max(rows_read(ranged)) < 30_000
        assert max(rows_read(serving.volume_vs_baseline(stored))) < 30_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.sql("DROP TABLE IF EXISTS ranged_orders")
