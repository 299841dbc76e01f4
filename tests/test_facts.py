from datetime import date, datetime
from random import Random

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from orderpulse import schemas
from orderpulse import vocabulary as v
from orderpulse.operators import facts, mart
from orderpulse.sources import testdata


def orders(spark, rows):
    return facts.order_lifecycle(fx.events(spark, rows))


def test_clean_orders(spark):
    got = fx.rows(
        orders(spark, fx.CLEAN), "order_id", "customer_id", "vendor_id", "driver_id", "gmv",
        "discount", "final_status", "cancelled_by", "cancel_reason",
    )
    assert got == [
        ("north-1", "eater-li", "stall-soup", "bike-7", 2450, 50, "delivered", None, None),
        ("north-2", "eater-mo", "stall-soup", None, 900, 0, "confirmed", None, None),
        ("west-1", "eater-mo", "stall-tea", None, 640, 0, "cancelled", "vendor", "too_busy"),
    ]


@pytest.mark.parametrize(
    "defect, order",
    [
        ("negative amount", ("east-1", "placed", -120, None)),
        ("vendor without a row", ("east-2", "confirmed", 830, None)),
        ("type outside the contract", ("east-3", "unknown", None, None)),
        ("delivered before it was placed", ("south-1", "delivered", 1500, "bike-7")),
        ("id of another event", ("south-2", "placed", 410, None)),
        ("missing id", ("south-3", "confirmed", 333, None)),
    ],
)
def test_bad_orders(spark, defect, order):
    assert fx.rows(orders(spark, fx.DEFECTS[defect]), "order_id", "final_status", "gmv", "driver_id") == [order]


def test_row_order_does_not_matter(spark):
    forward = orders(spark, fx.BAD)
    backward = orders(spark, fx.BAD[::-1])
    assert forward.exceptAll(backward).count() == backward.exceptAll(forward).count() == 0


def test_keys_take_the_earliest_known_value(spark):
    who = ("c", "v")
    got = orders(
        spark,
        [
            fx.event("b", "delivered", "o", fx.at(1, "12:00"), *who, "late"),
            fx.event("c", "picked_up", "o", fx.at(1, "11:00"), *who, "tie-second"),
            fx.event("a", "picked_up", "o", fx.at(1, "11:00"), *who, "tie-first"),
            fx.event("d", "placed", "o", fx.at(1, "10:00"), None, "v"),
            fx.event("e", "cancelled", "o", None, "untimed", "v", "untimed"),
        ],
    )
    assert fx.rows(got, "customer_id", "driver_id") == [("c", "tie-first")]


@pytest.mark.parametrize(
    ("seen", "status"),
    [
        (["placed"], "placed"),
        (["placed", "confirmed"], "confirmed"),
        (["placed", "prepared", "confirmed"], "prepared"),
        (["prepared", "picked_up"], "in_transit"),
        (["picked_up", "cancelled"], "cancelled"),
        (["cancelled", "delivered"], "delivered"),
        (["coupon_viewed"], "unknown"),
    ],
)
def test_status_precedence(spark, seen, status):
    rows = [fx.event(str(i), s, "o", fx.at(1, "10:00"), "c", "v") for i, s in enumerate(seen)]
    assert fx.rows(orders(spark, rows), "final_status") == [(status,)]


def test_orders_against_brute_force(spark):
    rnd, log = Random(5), []
    stages = [*(kind.removeprefix("order_") for kind in v.EVENT_TYPES), "coupon_viewed"]
    for i in range(3000):
        log.append(
            fx.event(
                f"e{i:05d}", rnd.choice(stages), rnd.choice([None, *map(str, range(300))]),
                rnd.choice([None, fx.at(1 + rnd.randrange(28), f"{rnd.randrange(10, 24)}:30")]),
                rnd.choice([None, "c1", "c2", "c3"]), rnd.choice([None, "v1", "v2"]),
                rnd.choice([None, None, "d1", "d2"]), [rnd.randrange(-9, 99) for _ in range(5)],
                (rnd.choice([None, "customer", "system"]), rnd.choice([None, "timeout", "too_busy"])),
            )
        )
    named = [dict(zip(fx._FIELDS, row)) for row in log]

    def largest(values):
        return max((x for x in values if x is not None), default=None)

    def fold(key):
        mine = sorted(
            (e for e in named if e["order_id"] == key),
            key=lambda e: (e["occurred_at"] is None, e["occurred_at"] or fx.at(1, "00:00"), e["event_id"]),
        )
        of = {kind: [e for e in mine if e["event_type"] == kind] for kind in v.EVENT_TYPES}
        row = [key] + [next((e[k] for e in mine if e[k] is not None), None) for k in v.ORDER_KEYS]
        stamps = {s: largest(e["occurred_at"] for e in of[kind]) for s, kind in v.STAGE_EVENTS.items()}
        row += stamps.values()
        row += [largest(e[m] for e in of["order_placed"]) for m in v.PLACED_MEASURES]
        row += [largest(e[c] for e in of["order_cancelled"]) for c in v.CANCEL_CONTEXT]
        return (*row, next((status for s, status in v.STATUS_BY_STAGE.items() if stamps[s]), "unknown"))

    want = sorted((fold(key) for key in {e["order_id"] for e in named}), key=repr)
    got = facts.order_lifecycle(fx.events(spark, log).repartition(5))
    assert fx.rows(got, "*") == want


def test_daily_mart_clean(spark):
    first, second = mart.daily_metrics(orders(spark, fx.CLEAN)).orderBy("order_date").collect()
    assert first.asDict() == {
        "order_date": date(2025, 3, 9), "total_orders": 2, "delivered_orders": 1,
        "cancelled_orders": 0, "in_progress_orders": 1, "total_gmv": 2450,
        "avg_order_value": 2450.0, "total_discount_given": 50, "avg_delivery_time_minutes": 61.0,
        "avg_prep_time_minutes": 22.0, "unique_customers": 2, "unique_vendors_active": 1,
        "unique_drivers_active": 1, "cancellation_rate": 0.0, "completion_rate": 0.5,
    }
    assert (second.order_date, second.cancelled_orders, second.total_gmv, second.cancellation_rate) == (date(2025, 3, 10), 1, None, 1.0)


def test_daily_mart_of_defects(spark):
    some = ("type outside the contract", "delivered before it was placed", "vendor without a row", "negative amount")
    got = mart.daily_metrics(orders(spark, [row for name in some for row in fx.DEFECTS[name]])).select(
        "order_date", "total_orders", "delivered_orders", "cancelled_orders", "in_progress_orders",
        "total_gmv", "avg_delivery_time_minutes", "avg_prep_time_minutes", "unique_customers",
        "unique_vendors_active", "unique_drivers_active", "cancellation_rate", "completion_rate",
    )
    assert [tuple(r) for r in got.orderBy("order_date").collect()] == [
        (None, 1, 0, 0, 0, None, None, None, 1, 1, 0, 0.0, 0.0),
        (date(2025, 3, 12), 1, 0, 0, 1, None, None, None, 1, 1, 0, 0.0, 0.0),
        (date(2025, 3, 13), 2, 1, 0, 1, 1500, -15.0, 4.0, 2, 2, 1, 0.0, 0.5),
    ]


def test_status_counts_never_exceed_the_total(spark):
    m = mart.daily_metrics(orders(spark, fx.BAD))
    parts = F.col("delivered_orders") + F.col("cancelled_orders") + F.col("in_progress_orders")
    assert m.filter(parts > F.col("total_orders")).isEmpty()


def test_items_explode_only_placed_baskets(spark):
    skewers, corn = ("m1", "Skewers", 2, 900, 1800), ("m2", "Corn", 1, 400, 400)
    moment = datetime(2026, 6, 1, 10)
    placed = spark.createDataFrame(
        [
            ("o1", "order_placed", "c", "v", moment, [skewers, corn]),
            ("o2", "order_placed", "c", "v", moment, []),
            ("o3", "order_placed", "c", "v", moment, None),
            ("o4", "order_confirmed", "c", "v", moment, [("m1", "Skewers", 1, 900, 900)]),
        ],
        "order_id string, event_type string, customer_id string, vendor_id string, "
        f"occurred_at timestamp, items array<{schemas.ITEM}>",
    )
    got = facts.order_items(placed)
    assert got.columns == [
        "order_id", "customer_id", "vendor_id", "occurred_at", "menu_item_id", "item_name",
        "quantity", "unit_price", "line_total",
    ]
    assert fx.rows(got, "order_id", "menu_item_id", "item_name", "quantity", "unit_price", "line_total") == [
        ("o1", *skewers), ("o1", *corn),
    ]


def test_event_log_columns(spark):
    assert facts.order_event_log(fx.events(spark, fx.CLEAN)).columns == list(facts.EVENT_LOG)


@pytest.mark.parametrize("parts", [1, 8])
def test_baskets_round_trip_and_keep_their_grain(spark, parts):
    lines = spark.createDataFrame(
        [("hot" if i % 3 else f"o{i}", f"m{i}", "x", 1, i, i) for i in range(18_000)],
        "order_id string, menu_item_id string, item_name string, quantity bigint, "
        "unit_price bigint, line_total bigint",
    ).repartition(3)
    baskets = facts.assemble_baskets(lines, parts=parts)
    items = baskets.select("order_id", F.explode("items").alias("i")).select("order_id", "i.menu_item_id")
    assert fx.rows(items, "order_id", "menu_item_id") == fx.rows(lines, "order_id", "menu_item_id")
    assert baskets.filter("order_id = 'hot'").count() == parts
    assert baskets.groupBy("order_id").count().agg(F.max("count")).first()[0] == parts


def test_equal_lines_of_one_order_fill_bounded_arrays(spark):
    lines = spark.range(0, 30_000, numPartitions=4).selectExpr(
        "if(id % 3 = 0, string(id), 'hot') AS order_id", "'m' AS menu_item_id", "'x' AS item_name",
        "1L AS quantity", "5L AS unit_price", "5L AS line_total",
    )
    baskets = facts.assemble_baskets(facts.line_blocks(lines, 1000), part="part")
    assert baskets.agg(F.max(F.size("items"))).first()[0] <= 1000
    items = baskets.select("order_id", F.explode("items").alias("i")).groupBy("order_id").count()
    assert items.exceptAll(lines.groupBy("order_id").count()).count() == 0 and items.count() == 10_001


def test_placed_orders_hold_bounded_arrays(spark, monkeypatch):
    whole = facts.order_items(testdata.placed_orders(spark, "/root/testdata/sf0.001"))
    monkeypatch.setattr(testdata, "BASKET_LINES", 2)
    placed = testdata.placed_orders(spark, "/root/testdata/sf0.001")
    assert placed.agg(F.max(F.size("items"))).first()[0] <= 2
    items = facts.order_items(placed)
    assert items.exceptAll(whole).count() == whole.exceptAll(items).count() == 0 < items.count()
