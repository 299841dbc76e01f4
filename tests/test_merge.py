"""The insert-only merge: exact, idempotent, without state that grows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from orderpulse.sources import landing
from orderpulse.streaming import flows, merge


def deliver(folder, number, rows):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{number:04d}.jsonl"
    with open(path, "w") as f:
        for event_id, time in rows:
            f.write(json.dumps({"event_id": event_id, "occurred_at": time, "payload": {"gmv": number}}) + "\n")
    os.utime(path, (1_700_000_000 + number * 60,) * 2)


def run(spark, base, files_per_batch=1):
    raw = landing.stream_landing(spark, f"{base}/raw", files_per_batch)
    return flows.run_available(merge.merge_stream(raw, f"{base}/silver", f"{base}/checkpoint"))


def ids(spark, base):
    return sorted((str(r.event_id), str(r.occurred_at)[11:16]) for r in merge.read_table(spark, f"{base}/silver").collect())


def ledger(spark, base):
    rows = merge.read_ledger(spark, f"{base}/silver").orderBy("batch_id").collect()
    return [(r.input, r.late, r.repeated, r.written) for r in rows]


def test_batches_with_repeats_and_late_rows(spark, tmp_path):
    day = "2023-04-05T"
    batches = [
        [("p", f"{day}06:00:00Z"), ("q", f"{day}06:10:00Z"), ("p", f"{day}06:00:00Z")],
        [("r", f"{day}07:30:00Z"), ("q", f"{day}06:10:00Z")],
        [("s", f"{day}06:29:59Z"), ("t", f"{day}06:30:00Z"), (None, None), (None, None)],
        [("u", None), (None, None), ("p", f"{day}06:00:00Z"), ("r", f"{day}07:30:00Z")],
    ]
    for number, rows in enumerate(batches):
        deliver(f"{tmp_path}/raw", number, rows)
    progress = run(spark, tmp_path)
    assert ids(spark, tmp_path) == [("None", ""), ("p", "06:00"), ("q", "06:10"), ("r", "07:30"), ("t", "06:30"), ("u", "")]
    assert ledger(spark, tmp_path) == [(3, 0, 1, 2), (2, 0, 1, 1), (4, 1, 1, 2), (4, 1, 2, 1)]
    assert not any(report.stateOperators for report in progress)


def test_replay_adds_nothing_over_fifty_batches(spark, tmp_path):
    """Half of the batches repeat earlier ones; reports of one batch only are kept, the ledger has all."""
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        for number in range(50):
            hour = number // 2
            time = f"2023-04-{1 + hour // 24:02d}T{hour % 24:02d}:00:00Z"
            deliver(f"{tmp_path}/raw", number, [(f"{hour}-{i}", time) for i in range(4)])
        raw = landing.stream_landing(spark, f"{tmp_path}/raw", 1)
        merge.merge_stream(raw, f"{tmp_path}/silver", f"{tmp_path}/checkpoint").start().awaitTermination()
    finally:
        spark.conf.set(key, before)
    assert ledger(spark, tmp_path) == [(4, 0, 0, 4), (4, 0, 4, 0)] * 25
    totals = merge.ledger_totals(merge.read_ledger(spark, f"{tmp_path}/silver")).first().asDict()
    assert totals == {"input": 200, "late": 0, "repeated": 100, "written": 100}
    assert not os.path.exists(f"{tmp_path}/checkpoint/state")


def test_a_batch_run_again_counts_the_same(spark, tmp_path):
    schema = "event_id string, occurred_at timestamp, n int"
    one = spark.createDataFrame([("a", None, 1), ("b", None, 1), ("b", None, 2)], schema)
    one = one.withColumn("occurred_at", F.to_timestamp(F.lit("2023-04-05 10:00:00")))
    two = one.withColumn("event_id", F.concat("event_id", F.lit("2")))
    path = f"{tmp_path}/t"
    for batch_id, rows in enumerate([one, two, two]):
        merge.insert_new(rows, min(batch_id, 1), path)
    assert merge.read_table(spark, path).count() == 4
    assert [tuple(r)[1:5] for r in merge.read_ledger(spark, path).select("batch_id", "input", "late", "repeated", "written").orderBy("batch_id").collect()] == [
        (3, 0, 1, 2), (3, 0, 1, 2)
    ]


@pytest.mark.parametrize("days", [3, 30])
def test_only_near_dates_are_read(spark, tmp_path, days):
    """What the anti-join reads does not grow with the age of the table."""
    schema = "event_id string, occurred_at timestamp"
    path = f"{tmp_path}/t"
    for day in range(days):
        rows = spark.range(20).selectExpr(f"concat('{day}-', id) AS event_id", f"timestamp'2023-01-01 12:00:00' + INTERVAL {day} DAYS AS occurred_at")
        assert rows.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
        merge.insert_new(rows, day, path)
    held = merge._held(spark, path, "event_id string, event_date date, batch_id bigint")
    newest = merge.read_ledger(spark, path).agg(F.max("newest")).first()[0]
    near = held.filter(F.col("event_date") >= F.date_sub(F.to_date(F.lit(newest) - F.expr("INTERVAL 1 hour")), 1))
    files = near._jdf.queryExecution().executedPlan().toString()
    assert near.count() == 40 and "PartitionFilters: [isnotnull(event_date" in files
