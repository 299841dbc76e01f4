import time
from datetime import datetime, timedelta

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from orderpulse.functions.clock import ago_text, duration_text, minutes_since
from orderpulse.operators import monitoring

STATS = "layer string, row_count bigint, last_event_at timestamp"


def reconcile(spark, *counts):
    rows = list(zip(("bronze", "silver", "gold"), counts, [None] * 3)) + [("models", 8, None)]
    got = monitoring.layer_reconciliation(spark.createDataFrame(rows, STATS)).collect()
    assert [r.layer for r in got] == ["Bronze", "Silver", "Gold"] and all(r.why for r in got)
    return [(r.row_count, r.dropped, None if r.dropped_pct is None else round(r.dropped_pct, 1)) for r in got]


def test_reconciliation(spark):
    assert reconcile(spark, 640000, 608000, 608000) == [
        (640000, None, None), (608000, 32000, 5.0), (608000, 0, 0.0)
    ]
    assert reconcile(spark, None, 5, 5) == [(None, None, None), (5, None, None), (5, 0, 0.0)]
    assert reconcile(spark, 0, 0, None) == [(0, None, None), (0, 0, 0.0), (None, None, None)]


def test_absent_layers_have_rows(spark):
    stats = spark.createDataFrame([("bronze", 100, None), ("gold", 90, None)], STATS)
    got = [(r.layer, r.row_count, r.dropped) for r in monitoring.layer_reconciliation(stats).collect()]
    assert got == [("Bronze", 100, None), ("Silver", None, None), ("Gold", 90, None)]
    states = {r.layer: r.state for r in monitoring.freshness(stats, datetime(2026, 6, 1)).collect()}
    assert states == dict.fromkeys(("bronze", "silver", "gold"), "unknown")


def minutes(spark, values, *columns):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, m double")
    return [tuple(r) for r in df.orderBy("i").select(*columns).collect()]


def test_states_and_verdicts(spark):
    m = F.col("m")
    got = minutes(spark, [0.0, 4320.0, 5760.0, 10079.0, 10080.0, 43200.0, None],
                  monitoring.freshness_state(m), monitoring.outage_verdict(m))
    assert got == [
        ("live", "ok"), ("live", "ok"), ("live", "data-stale"), ("live", "data-stale"),
        ("delayed", "data-stale"), ("delayed", "data-stale"), ("unknown", "data-missing"),
    ]


def test_duration_texts(spark):
    m = F.col("m")
    got = minutes(spark, [None, 0.5, 12.0, 60.0, 185.0, 1440.0, 3120.0, 1500.9, -5.0], duration_text(m), ago_text(m))
    assert got == [
        ("—", "no data yet"), ("just now", "just now"), ("12 min", "12 min ago"), ("1 h", "1 h ago"),
        ("3 h 5 min", "3 h 5 min ago"), ("1 d", "1 d ago"), ("2 d 4 h", "2 d 4 h ago"),
        ("1 d 1 h", "1 d 1 h ago"), ("just now", "just now"),
    ]


def test_times_without_zone_are_utc(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2026-10-22 11:00:00' a, timestamp'2026-10-22T20:00:00+09:00' b, "
        "CAST(NULL AS timestamp) c"
    )
    now = datetime(2026, 10, 22, 12)
    assert tuple(df.select(*[minutes_since(F.col(c), now) for c in "abc"]).first()) == (60, 60, None)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_the_machine_zone_does_not_matter(spark, monkeypatch, zone):
    df = spark.sql("SELECT timestamp_ntz'2026-10-22 11:00:00' a")
    noon = (datetime(2026, 10, 22, 12), datetime.fromisoformat("2026-10-22T21:00:00+09:00"))
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        ages = df.select(*[minutes_since(F.col("a"), now) for now in noon])
    finally:
        monkeypatch.undo()
        time.tzset()
    assert tuple(ages.first()) == (60, 60)


def test_freshness_over_layers(spark):
    now = datetime(2026, 6, 5)
    stats = spark.createDataFrame(
        [("bronze", 1, now - timedelta(hours=3)), ("silver", 1, now - timedelta(hours=3, minutes=1)),
         ("gold", 0, None), ("models", 8, None)],
        STATS,
    )
    got = fx.rows(monitoring.freshness(stats, now), "layer", "age_minutes", "state", "stale_alert", "outage")
    assert got == [
        ("bronze", 180.0, "live", False, "ok"), ("gold", None, "unknown", False, "data-missing"),
        ("silver", 181.0, "live", True, "ok"),
    ]


def test_layer_stats(spark):
    silver = fx.events(spark, fx.CLEAN)
    bronze = silver.union(silver).withColumn("occurred_at", F.lit("not a time"))
    got = fx.rows(monitoring.layer_stats(bronze, silver, silver.limit(0), 8), "*")
    assert got == [
        ("bronze", 20, None), ("gold", 0, None), ("models", 8, None), ("silver", 10, fx.at(10, "08:28"))
    ]


@pytest.mark.parametrize("now", [None, datetime(2026, 6, 2, 0, 30), datetime(2026, 6, 3, 9)])
@pytest.mark.parametrize("cap", [None, 6, 30])
def test_missing_hours(spark, now, cap):
    seen = [datetime(2026, 6, 1, h, 59) for h in (1, 2, 5, 6, 11)] + [datetime(2026, 6, 1, 20), None]
    df = spark.createDataFrame([(t,) for t in seen], "t timestamp")
    hours = {t.replace(minute=0) for t in seen if t}
    last = max(hours) if now is None else now.replace(minute=0) - timedelta(hours=1)
    first = min(hours) if cap is None else max(min(hours), last - timedelta(hours=cap - 1))
    want, hour = [], first
    while hour <= last:
        want += [(hour,)] * (hour not in hours)
        hour += timedelta(hours=1)
    assert fx.rows(monitoring.missing_hours(df, "t", now, cap), "hr") == sorted(want, key=repr)


def test_last_write_reads_file_times_only(spark, tmp_path):
    df = spark.range(10)
    df.write.parquet(str(tmp_path / "a"))
    df.write.parquet(str(tmp_path / "b"))
    got = monitoring.last_write(spark, {"bronze": str(tmp_path / "a"), "silver": str(tmp_path / "b")})
    times = dict(fx.rows(got, "layer", "last_write_at"))
    assert times["bronze"] <= times["silver"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<modificationTime:timestamp>") == 2
