"""Whatever a line holds can be read from its landed row."""

import json

from pyspark.sql import functions as F

from orderpulse.sources import landing
from orderpulse.streaming import flows

LINES = [
    '{"event_id": "w1", "event_type": "order_placed", "payload": {"gmv": 70, "items": [{"menu_item_id": "a", "quantity": 1}]}}',
    '{"event_id": 2, "app": {"v": [1, 2]}, "payload": {"gmv": "70 EUR", "channel": "web", "items": [{"menu_item_id": "a", "x": 0}]}}',
    '{"event_id": "w3", "payload": {"gmv": 1.5, "discount": null, "items": 5, "reason": {"code": 9}}}',
    '{"event_id": "w4", "payload": [1]}',
    '{"event_id": "w5", "payload": null}',
    '{"event_id": "torn", "payload": {"gm',
    '["no", "record"]',
    "not json at all",
    "   ",
    "",
    '{"event_id": "w6", "occurred_at": "2025-01-01T00:00:00Z", "payload": {"items": [{"quantity": "two"}], "delivery_fee": true}}',
]


def landed(spark):
    return landing.parse_lines(spark.createDataFrame([(line,) for line in LINES], "value string"))


def test_nothing_is_lost(spark):
    """Each line is whole in the typed columns, in `rescued`, or in `corrupt_record`."""
    rows = landed(spark).withColumn("rescued", F.to_json("rescued")).collect()
    got = {r.event_id: (r.payload and r.payload.gmv, json.loads(r.rescued) if r.rescued else None) for r in rows if r.event_id}
    assert got == {
        "w1": (70, None),
        "2": (None, {
            "app": {"v": [1, 2]}, "payload.gmv": "70 EUR", "payload.channel": "web",
            "payload.items": [{"menu_item_id": "a", "x": 0}],
        }),
        "w3": (None, {"payload.gmv": 1.5, "payload.items": 5, "payload.reason": {"code": 9}}),
        "w4": (None, {"payload": [1]}),
        "w5": (None, None),
        "w6": (None, {"payload.items": [{"quantity": "two"}], "payload.delivery_fee": True}),
    }
    torn = [r for r in rows if r.corrupt_record is not None]
    assert sorted(r.corrupt_record for r in torn) == sorted(LINES[5:8])
    assert all(v is None for r in torn for k, v in r.asDict().items() if k != "corrupt_record")


def test_a_line_is_parsed_once_a_step(spark, capsys):
    """The filter and the typed event parse each line once more than the typed reader does, not two and four times."""
    landing.whole_records(landed(spark)).select("event_id").explain()
    steps = [line for line in capsys.readouterr().out.splitlines() if "parseJson" in line]
    assert steps and all(line.count("parseJson") == 1 for line in steps)


def test_what_is_a_record(spark):
    """As the parsed value's own type has it."""
    lines = [
        '{"a":1,"a":2}', '\ufeff{"a":1}', ' \t{"a":1}  ', '\x0b{"a":1}', '{"a":1} tail', '[{"a":1}]', '"{"', "{", "{}", "null",
        '{"a":NaN}', "{'a':1}", '\u00a0{"a":1}', '/* c */{"a":1}', None,
    ]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    by_type = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    got = landing.with_body(frame)
    expected = {r.value: r.is_record for r in frame.select("value", by_type.alias("is_record")).collect()}
    assert {r.value: r.found for r in got.select("value", F.col("body").isNotNull().alias("found")).collect()} == expected
    assert sum(expected.values()) == 3


def test_the_payload_can_be_asked_later(spark):
    rows = landed(spark).filter("event_id = '2'")
    got = rows.selectExpr("try_variant_get(payload_raw, '$.channel', 'string')", "try_variant_get(payload_raw, '$.items[0].x', 'int')").first()
    assert tuple(got) == ("web", 0)


def test_drift_profile(spark):
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    got = {(r.path, r.type, r.fits): r.rows for r in landing.drift_profile(lines).collect()}
    assert got["$", "CORRUPT", False] == 3
    assert got["payload.gmv", "BIGINT", True] == got["payload.gmv", "DECIMAL", False] == got["payload.gmv", "STRING", False] == 1
    assert got["event_id", "STRING", True] == 5 and got["event_id", "BIGINT", True] == 1
    assert got["payload", "OBJECT", True] == 4 and got["payload", "ARRAY", False] == 1 and got["payload", "VOID", True] == 1
    assert got["app", "OBJECT", False] == 1 and got["payload.discount", "VOID", True] == 1


def test_stream_in_bounded_batches(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"raw{i % 2}").mkdir(exist_ok=True)
        (tmp_path / f"raw{i % 2}" / f"{i}.jsonl").write_text("\n".join(LINES) + "\n")
    rows = landing.stream_landing(spark, f"{tmp_path}/raw*", files_per_batch=2)
    progress = flows.run_available(flows.append(rows, f"{tmp_path}/checkpoint", f"{tmp_path}/bronze"))
    assert len([p for p in progress if p.numInputRows]) == 3
    back = spark.read.parquet(f"{tmp_path}/bronze")
    assert back.count() == 6 * 9 and landing.rescued_rows(back).count() == 6 * 7
    assert landing.whole_records(back).count() == 6 * 6


def test_no_lines(spark):
    none = spark.createDataFrame([], "value string")
    assert landing.parse_lines(none).count() == landing.drift_profile(none).count() == 0
