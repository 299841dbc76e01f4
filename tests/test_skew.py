from random import Random
from statistics import median

import fixtures as fx
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderpulse.operators import checks, skew

SCHEMA = "order_id string, event_id string, occurred_at timestamp, event_type string"


@pytest.fixture(scope="module")
def log(spark):
    rnd = Random(11)
    kinds = ["order_placed", "order_confirmed", "order_prepared", "order_cancelled", None]
    rows = []
    for i in range(1500):
        key = "hot" if i % 3 == 0 else None if i % 7 == 0 else f"o{rnd.randrange(200)}"
        time = fx.at(1 + rnd.randrange(3), f"{rnd.randrange(8, 20):02d}:00") if i % 11 else None
        rows.append((key, f"e{i:05d}", time, rnd.choice(kinds)))
    return spark.createDataFrame(rows, SCHEMA).repartition(7).cache()


def with_plain_window(log):
    plain = Window.partitionBy("order_id").orderBy("occurred_at", "event_id")
    return log.withColumn("before", F.lag("event_type").over(plain))


def with_ranges(log):
    return skew.with_previous(log, "order_id", "occurred_at", "event_id", "event_type", "before")


@pytest.mark.parametrize("partitions", [1, 5, 64])
def test_previous_row_is_that_of_a_plain_window(spark, log, partitions):
    key, coalesce = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, partitions)
    spark.conf.set(coalesce, False)
    try:
        want, got = with_plain_window(log), with_ranges(log)
        assert got.columns == want.columns
        assert fx.rows(got, *want.columns) == fx.rows(want, *want.columns)
        assert with_ranges(log.limit(0)).count() == 0
    finally:
        spark.conf.set(key, before)
        spark.conf.unset(coalesce)


@pytest.mark.parametrize("hour", ["'2023-05-06 10:00:00'", None])
def test_an_order_with_a_third_of_all_rows_is_spread(spark, hour):
    """All of them in one hour, or all without a time."""
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, False)
    try:
        time = f"timestamp{hour}" if hour else "CAST(NULL AS TIMESTAMP)"
        rows = spark.range(60_000).selectExpr(
            "IF(id % 3 = 0, 'hot', concat('o', id % 4000)) AS order_id", "concat('e', id) AS event_id",
            f"IF(id % 3 = 0, {time}, timestamp'2023-05-01 00:00:00' + make_dt_interval(0, id % 300)) AS occurred_at",
            "'order_placed' AS event_type",
        )
        sizes = [r["count"] for r in skew.ranged(rows, "order_id", "occurred_at", "event_id").groupBy("_part").count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 3 * median(sizes)
        found = with_ranges(rows).filter("order_id = 'hot'").agg(F.count("*"), F.count("before")).first()
        assert tuple(found) == (20_000, 19_999)
    finally:
        spark.conf.unset(coalesce)


def test_building_starts_no_job(spark, log):
    group = "previous-row"
    spark.sparkContext.setJobGroup(group, group)
    checks.illegal_transitions(log)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
