import json
import os

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from orderpulse import schemas
from orderpulse.operators import cleaning, monitoring
from orderpulse.plans import streams
from orderpulse.sources import events, tables
from orderpulse.streaming import flows

DAY = "2026-01-01T"
BATCHES = [
    [("a", "10:00"), ("b", "05:00")],
    [("c", "08:30"), ("e", "15:00")],
    [("f", "13:00"), ("h", "15:05")],
    [("g", "13:30"), ("i", "14:30"), ("c", "15:20")],
    [("a", "15:30"), ("k", "18:00")],
]


def deliver(folder, number, rows):
    """One file per batch, with file times a minute apart."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{number:03d}.jsonl"
    with open(path, "w") as f:
        for event_id, clock in rows:
            time = clock and f"{DAY}{clock}:00.000Z"
            f.write(json.dumps({"event_id": event_id, "occurred_at": time, "payload": {"gmv": number}}) + "\n")
    os.utime(path, (1_760_000_000 + number * 60,) * 2)


class Run:
    def __init__(self, spark, tmp_path, **options):
        self.spark, self.base, self.options = spark, str(tmp_path), options

    def go(self, files_per_batch=1):
        raw = events.stream_events(self.spark, f"{self.base}/raw", files_per_batch=files_per_batch)
        flow = flows.append(
            flows.silver_stream(raw, **self.options), f"{self.base}/checkpoint", f"{self.base}/out"
        )
        self.progress = flows.run_available(flow)
        return self

    def rows(self):
        clock = F.date_format("occurred_at", "HH:mm")
        return fx.rows(self.spark.read.parquet(f"{self.base}/out"), "event_id", clock)


@pytest.mark.parametrize("lanes", [1, flows.LANES])
def test_micro_batches(spark, tmp_path, lanes):
    run = Run(spark, tmp_path, lanes=lanes)
    for number, rows in enumerate(BATCHES):
        deliver(f"{tmp_path}/raw", number, rows)
    run.go()
    assert run.rows() == [
        ("a", "10:00"), ("b", "05:00"), ("c", "08:30"), ("e", "15:00"), ("f", "13:00"),
        ("h", "15:05"), ("i", "14:30"), ("k", "18:00"),
    ]
    # g is behind the watermark; c and a are known ids, so they are repeats.
    assert flows.drop_counts(run.progress) == {"input": 11, "late": 1, "repeated": 2}
    data = [p for p in run.progress if p.numInputRows]
    assert [p.stateOperators[0].numRowsTotal for p in data] == [2, 4, 6, 7, 8]


def test_bounded_variant_forgets(spark, tmp_path):
    run = Run(spark, tmp_path, bounded=True)
    for number, rows in enumerate(BATCHES):
        deliver(f"{tmp_path}/raw", number, rows)
    run.go()
    assert {("c", "15:20"), ("a", "15:30"), ("a", "10:00"), ("c", "08:30")} < set(run.rows())
    assert run.progress[-1].stateOperators[0].numRowsTotal == 1


def test_one_batch_has_nothing_late(spark, tmp_path):
    for number, rows in enumerate(BATCHES):
        deliver(f"{tmp_path}/raw", number, rows)
    run = Run(spark, tmp_path).go(files_per_batch=None)
    assert len(run.rows()) == 9
    assert flows.drop_counts(run.progress) == {"input": 11, "late": 0, "repeated": 2}


def test_missing_ids_and_times(spark, tmp_path):
    deliver(f"{tmp_path}/raw", 0, [(None, "10:00"), (None, "10:01"), ("x", None), ("y", None), ("x", None)])
    deliver(f"{tmp_path}/raw", 1, [("z", "12:00"), (None, "12:01"), ("w", None)])
    ids = [r[0] for r in Run(spark, tmp_path).go().rows()]
    assert sorted(map(str, ids)) == ["None", "w", "x", "y", "z"]


def test_scheduled_runs_take_only_new_files_and_replay_adds_nothing(spark, tmp_path):
    run = Run(spark, tmp_path)
    seen = []
    for number, rows in enumerate([BATCHES[0], BATCHES[1], BATCHES[1], BATCHES[0]]):
        deliver(f"{tmp_path}/raw", number, rows)
        run.go()
        seen.append((flows.drop_counts(run.progress)["input"], len(run.rows())))
    # c (08:30) is late here: the first run already moved the watermark to 09:00.
    assert seen == [(2, 2), (2, 3), (2, 3), (2, 3)]
    assert run.go().progress == [] or flows.drop_counts(run.progress)["input"] == 0


def test_hot_id_reaches_the_exact_step_thinned_out(spark, tmp_path):
    for number in range(6):
        deliver(f"{tmp_path}/raw", number, [("hot", "10:00")] * 500 + [(f"{number}", "10:00")])
    run = Run(spark, tmp_path).go(files_per_batch=None)
    assert [r[0] for r in run.rows()] == ["0", "1", "2", "3", "4", "5", "hot"]
    exact, lanes = run.progress[0].stateOperators[:2]
    dropped = [int(dict(op.customMetrics)["numDroppedDuplicateRows"]) for op in (exact, lanes)]
    assert sum(dropped) == 2999 and dropped[0] < 8


def test_disk_state_gives_the_same_result(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for number, rows in enumerate(BATCHES):
            deliver(f"{tmp_path}/raw", number, rows)
        assert len(Run(spark, tmp_path).go().rows()) == 8
    finally:
        spark.conf.set(key, before)


def test_table_to_table(spark, tmp_path):
    """Bronze and silver as catalog tables, silver partitioned by day, then reconciled."""
    layers = tables.Layers("bronze_t", "silver_t", "gold_t")
    layers.create_schemas(spark)
    for number, rows in enumerate(BATCHES):
        deliver(f"{tmp_path}/raw", number, rows)
    bronze, silver = layers.name("bronze", "order_events"), layers.name("silver", "order_events")
    raw = events.stream_events(spark, f"{tmp_path}/raw")
    flows.run_available(flows.append(raw, f"{tmp_path}/c1"), bronze)
    clean = flows.silver_stream(layers.stream(spark, "bronze", "order_events"))
    dated = clean.withColumn("event_date", F.to_date("occurred_at"))
    flows.run_available(flows.append(dated, f"{tmp_path}/c2", partition_by=("event_date",)), silver)
    stats = monitoring.layer_stats(
        spark.table(bronze), spark.table(silver), spark.table(silver), tables.table_count(spark, "gold_t")
    )
    got = fx.rows(monitoring.layer_reconciliation(stats), "layer_rank", "row_count", "dropped")
    assert got == [(1, 11, None), (2, 9, 2), (3, 9, 0)]


def test_inferred_stream_schema(spark, tmp_path):
    deliver(f"{tmp_path}/raw", 0, BATCHES[0])
    stream = events.stream_events(spark, f"{tmp_path}/raw", schema=None)
    assert dict(stream.select("payload.gmv").dtypes) == {"gmv": "bigint"}


def test_stream_and_batch_share_the_columns(spark, tmp_path):
    deliver(f"{tmp_path}/raw", 0, BATCHES[0])
    batch = cleaning.clean_events(events.read_events(spark, f"{tmp_path}/raw", schemas.RAW_EVENT))
    stream = flows.silver_stream(events.stream_events(spark, f"{tmp_path}/raw"))
    assert stream.dtypes == batch.dtypes


def test_halves_are_derived_once(spark):
    """Deliveries read the stored events; the tables are read when these are written only."""
    early, late = streams._halves(spark, "/root/testdata/sf0.001")
    assert not any("events.parquet" in name for name in early.inputFiles() + late.inputFiles())
    assert early.count() + late.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
