"""The hourly rollup against the full query, and what a refresh reads."""

import json
import os
import threading

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from orderpulse.operators import contracts, rollup, serving
from orderpulse.operators.publish import publish, version_folders

FACT = "order_id string, placed_at timestamp, final_status string, gmv bigint"


def orders(spark, days, hour=0):
    return spark.range(days * 50).selectExpr(
        "concat('o', id) AS order_id",
        f"timestamp'2025-02-01 00:00:00' + make_dt_interval(CAST(id % {days} AS INT), CAST((id * 7 + {hour}) % 24 AS INT), 5) AS placed_at",
        "element_at(array('delivered', 'cancelled', 'placed'), CAST(id % 3 AS INT) + 1) AS final_status", "id AS gmv",
    )


def test_a_new_hour_reads_its_date_only(spark, tmp_path):
    fact, rolled = f"{tmp_path}/fact", f"{tmp_path}/rollup"
    rollup.store_orders(orders(spark, 20), fact)
    rollup.refresh(spark, fact, rolled)
    new = spark.createDataFrame([("late", fx.at(1, "10:00").replace(month=2, day=7), "delivered", 5)], FACT)
    day = rollup.orders_of(spark, fact).filter("order_date = DATE'2025-02-07'").select("order_id", "placed_at", "final_status", "gmv")
    whole = spark.createDataFrame(day.union(new).collect(), FACT)
    rollup.store_orders(whole, fact)
    dates = rollup.changed_dates(whole, new)
    assert [str(d) for d in dates] == ["2025-02-07"]
    read = rollup.orders_of(spark, fact, dates)
    plan = read._jdf.queryExecution().executedPlan()
    read.collect()
    metrics = {m: plan.collectLeaves().apply(0).metrics().apply(m).value() for m in ("numFiles", "numPartitions")}
    assert metrics["numPartitions"] == 1 and sum(d.startswith("order_date=") for d in os.listdir(fact)) == 20
    rollup.refresh(spark, fact, rolled, dates)
    full = rollup.hourly_parts(rollup.orders_of(spark, fact))
    got = spark.read.parquet(rolled)
    columns = ("order_date", "hr", "orders", "delivered", "cancelled", "gmv")
    assert fx.rows(got, *columns) == fx.rows(full, *columns)
    assert fx.rows(rollup.heatmap(got), "*") == fx.rows(serving.hour_heatmap(rollup.orders_of(spark, fact)), "dow", "hour_of_day", "orders")
    rollup.refresh(spark, fact, rolled, [])
    assert spark.read.parquet(rolled).count() == got.count()


def test_readers_never_miss_a_table_while_its_schema_changes(spark, tmp_path):
    name, failures, seen, stop = "swapped_rows", [], set(), threading.Event()
    publish(spark, spark.range(5), name, folder=str(tmp_path))

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(name).count())
            except Exception as error:  # noqa: BLE001
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(20):
        publish(spark, spark.range(5 + i).withColumn(f"c{i}", F.lit(i)), name, folder=str(tmp_path), kept=4)
    stop.set()
    reader.join()
    assert not failures and seen <= set(range(5, 25)) and spark.table(name).columns == ["id", "c19"]
    assert len(version_folders(spark, f"{tmp_path}/versions/{name}")) == 4


def test_a_failed_version_is_removed(spark, tmp_path):
    name = "guarded_rows"
    rows = spark.range(3).selectExpr("id AS gmv")
    audit = lambda staged: contracts.dq_report({"t": staged}, [contracts.accepted_range("t", "gmv", low=1)], "error")
    publish(spark, rows, name, folder=str(tmp_path))
    with pytest.raises(contracts.ContractViolation):
        publish(spark, rows, name, audit, folder=str(tmp_path))
    assert len(version_folders(spark, f"{tmp_path}/versions/{name}")) == 1 and spark.table(name).count() == 3
    assert json.dumps(sorted(r.gmv for r in spark.table(name).collect())) == "[0, 1, 2]"
