import json

import fixtures as fx
from pyspark.sql import functions as F

from orderpulse import schemas
from orderpulse.operators import cleaning


def raw(spark, *records):
    base = dict.fromkeys(["event_id", "event_type", "order_id", "occurred_at", "customer_id", "vendor_id", "driver_id"])
    rows = [tuple((base | r).values()) + (json.dumps(p),) for r, p in records]
    return cleaning.read_payload(spark.createDataFrame(rows, schemas.RAW_EVENT_TEXT))


def test_payload_shapes_become_flat_columns(spark):
    item = {"menu_item_id": "m1", "name": "Skewers", "quantity": 2, "unit_price": 900, "line_total": 1800}
    events = raw(
        spark,
        ({"event_id": "1", "occurred_at": "2024-01-15T12:00:00.250Z"},
         {"items": [item], "gmv": 2000, "food_cost": 1800, "discount": 0, "delivery_address": "Porto"}),
        ({"event_id": "2", "occurred_at": "2024-01-15T12:01:00.000Z"}, {"estimated_prep_minutes": 18}),
        ({"event_id": "3", "occurred_at": "soon"}, {"cancelled_by": "driver", "reason": "vehicle_breakdown"}),
        ({"event_id": "4"}, {"driver_id": "d", "vehicle_type": "car", "platform": "x"}),
    )
    flat = cleaning.flatten(cleaning.with_event_time(events))
    assert flat.columns == [*cleaning.HEAD, *cleaning.PAYLOAD_FIELDS] and len(flat.columns) == 18
    assert fx.rows(flat, "event_id", F.col("occurred_at").cast("string"), "gmv", "estimated_prep_minutes",
                   "cancelled_by", "cancel_reason", "vehicle_type") == [
        ("1", "2024-01-15 12:00:00.25", 2000, None, None, None, None),
        ("2", "2024-01-15 12:01:00", None, 18, None, None, None),
        ("3", None, None, None, "driver", "vehicle_breakdown", None),
        ("4", None, None, None, None, None, "car"),
    ]
    assert [tuple(i) for i in flat.filter("event_id = '1'").first()["items"]] == [tuple(item.values())]
    assert fx.rows(cleaning.unreadable_times(events), "event_id") == [("3",)]


def test_dedup_keeps_the_earliest_row_whatever_the_order(spark):
    rows = [(i % 7 if i % 5 else None, fx.at(1 + i % 9, "10:00"), i % 3) for i in range(200)]
    schema = "event_id bigint, occurred_at timestamp, n int"
    one = cleaning.dedup(spark.createDataFrame(rows, schema).repartition(5))
    two = cleaning.dedup(spark.createDataFrame(rows[::-1], schema).repartition(3))
    want = sorted(min((r for r in rows if r[0] == k), key=lambda r: r[1:]) for k in range(7))
    missing = min((r for r in rows if r[0] is None), key=lambda r: r[1:])
    assert fx.rows(one, "*") == fx.rows(two, "*") == sorted([*want, missing], key=repr)


def test_dedup_drops_copies_before_the_shuffle(spark):
    plan = cleaning.dedup(fx.events(spark, fx.BAD))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_clean_events_replay_adds_nothing(spark):
    events = raw(spark, *[({"event_id": str(i), "occurred_at": "2024-01-15T12:00:00.000Z"}, {"gmv": i}) for i in range(9)])
    once, twice = cleaning.clean_events(events), cleaning.clean_events(events.unionByName(events))
    assert fx.rows(once, "event_id", "gmv") == fx.rows(twice, "event_id", "gmv")
