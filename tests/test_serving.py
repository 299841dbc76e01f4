from collections import Counter
from datetime import date, datetime, timedelta
from random import Random

import fixtures as fx
import pytest

from orderpulse import vocabulary as v
from orderpulse.operators import mart, serving

ORDERS = (
    "order_id string, vendor_id string, placed_at timestamp, final_status string, gmv bigint, "
    "cancelled_by string, cancel_reason string"
)


def make_orders(n=400, seed=3):
    rnd, start = Random(seed), datetime(2026, 6, 1, 0, 17)
    out = []
    for i in range(n):
        placed = start + timedelta(minutes=rnd.randrange(20 * 24 * 60)) if i % 40 else None
        status = rnd.choice(["delivered", "cancelled", "placed"])
        actor = rnd.choice(["customer", "system", "courier", None]) if status == "cancelled" else None
        reason = rnd.choice(["too_busy", "changed_mind"]) if status == "cancelled" else None
        out.append((f"o{i}", rnd.choice(["v1", "v2", "v3", "v9", None]), placed, status, rnd.randrange(-50, 900), actor, reason))
    return out


@pytest.fixture(scope="module")
def placed(spark):
    rows = make_orders()
    return rows, spark.createDataFrame(rows, ORDERS).cache()


def floor_hour(t):
    return t.replace(minute=0, second=0)


@pytest.mark.parametrize("window", v.WINDOW_HOURS.values())
@pytest.mark.parametrize("exclude", [False, True])
def test_volume_against_brute_force(placed, window, exclude):
    rows, df = placed
    times = [r[2] for r in rows if r[2]]
    shown_from = max(times) - timedelta(hours=window)
    past_from = max(times) - timedelta(days=7)
    shown = Counter(floor_hour(t) for t in times if t >= shown_from)
    past = Counter(floor_hour(t) for t in times if t >= past_from and not (exclude and t >= shown_from))
    want = []
    for hr, n in sorted(shown.items()):
        same = [c for h, c in past.items() if h.hour == hr.hour]
        if same:
            want.append((hr, n, float(int(sum(same) / len(same) + 0.5))))
    got = serving.volume_vs_baseline(df, window, exclude)
    assert [tuple(r) for r in got.collect()] == want


def test_window_is_a_preset_or_a_number(placed):
    by_name, by_hours = (serving.volume_vs_baseline(placed[1], w).collect() for w in ("24h", 24))
    assert by_name == by_hours
    with pytest.raises(ValueError):
        serving.volume_vs_baseline(placed[1], "72; DROP TABLE x")


def test_hourly_volume_and_heatmaps(placed):
    rows, df = placed
    times = [r[2] for r in rows if r[2]]
    assert dict(fx.rows(serving.hourly_volume(df), "hr", "orders")) == Counter(map(floor_hour, times))
    cells = Counter((t.isoweekday() % 7 + 1, t.hour) for t in times)
    heat = fx.rows(serving.hour_heatmap(df), "dow", "hour_of_day", "orders")
    assert {r[:2]: r[2] for r in heat} == cells
    today = date(2026, 6, 17)  # a Wednesday
    wide = serving.hour_heatmap_wide(df, today).collect()
    assert [r.day for r in wide] == ["Thu", "Fri", "Sat", "Sun", "Mon", "Tue", "Wed"]
    for r in wide:
        code = v.WEEKDAYS.index(r.day) + 1
        assert [r[f"h{h:02d}"] for h in range(24)] == [cells.get((code, h), 0) for h in range(24)]


def test_range_includes_both_days(placed):
    rows, df = placed
    start, end = date(2026, 6, 3), date(2026, 6, 5)
    want = sorted(r[0] for r in rows if r[2] and start <= r[2].date() <= end)
    assert [r[0] for r in fx.rows(serving.placed_between(df, start, end), "order_id")] == want


def test_top_vendors(spark, placed):
    rows, df = placed
    vendors = spark.createDataFrame(
        [("v1", "A", "Thai"), ("v2", "A", "Thai"), ("v3", "B", "Cafe"), ("v4", "C", "Cafe")],
        "vendor_id string, name string, cuisine_type string",
    )
    board = {}
    for _, vendor, _, status, gmv, *_ in rows:
        name = {"v1": "A", "v2": "A", "v3": "B"}.get(vendor)
        if name:
            t = board.setdefault(name, [0, 0, 0])
            t[0] += 1
            t[1] += gmv if status == "delivered" else 0
            t[2] += status == "cancelled"
    got = [tuple(r) for r in serving.top_vendors(df, vendors).collect()]
    want = sorted(((n, t[0], t[1], round(t[2] / t[0], 3)) for n, t in board.items()), key=lambda r: -r[2])
    assert [(r[0], *r[2:]) for r in got] == want
    assert serving.top_vendors(df, vendors, 1).count() == 1


def test_vendor_without_deliveries_sorts_last(spark):
    orders = spark.createDataFrame(
        [("1", "v1", datetime(2026, 6, 1), "placed", 9, None, None), ("2", "v2", datetime(2026, 6, 1), "delivered", -5, None, None)],
        ORDERS,
    )
    vendors = spark.createDataFrame([("v1", "A", "x"), ("v2", "B", "x")], "vendor_id string, name string, cuisine_type string")
    assert [(r.vendor_name, r.gmv) for r in serving.top_vendors(orders, vendors).collect()] == [("B", -5), ("A", None)]


def test_cancellation_reasons(placed):
    rows, df = placed
    counts = Counter((r[5], r[6]) for r in rows if r[3] == "cancelled" and r[2])
    got = serving.cancellation_reasons(df).collect()
    assert {(r.cancelled_by, r.cancel_reason): r.cnt for r in got} == counts
    assert [(r.actor_rank, -r.cnt) for r in got] == sorted((r.actor_rank, -r.cnt) for r in got)
    assert {(r.cancelled_by, r.actor, r.actor_rank) for r in got} == {
        ("customer", "customer", 1), ("system", "system", 4), ("courier", "other", 5), (None, "other", 5)
    }
    assert {r.reason_label for r in got} == {"too busy", "changed mind"}


def test_customer_history(spark):
    events = fx.events(spark, fx.BAD[::-1])
    got = [r.event_id for r in serving.customer_history(events, "eater-li", 3).collect()]
    assert got == ["north-1/placed", "north-1/confirmed", "north-1/prepared"]


MART = (
    "order_date date, total_orders bigint, delivered_orders bigint, cancelled_orders bigint, "
    "total_gmv bigint, cancellation_rate double, avg_delivery_time_minutes double"
)


@pytest.fixture(scope="module")
def days(spark):
    rows = [(date(2026, 6, d), 10, 8, 2, 100 * d, 0.2, 30.5) for d in range(1, 21)]
    return spark.createDataFrame([*rows, (None, 3, 0, 0, None, 0.0, None)], MART)


@pytest.mark.parametrize(
    ("preset", "today", "first", "last"),
    [
        ("7d", date(2026, 6, 20), 13, 19),
        ("7d", date(2026, 7, 1), 14, 20),
        ("30d", date(2026, 6, 20), 1, 19),
        ("90d", date(2026, 7, 1), 1, 20),
        ("All", date(2026, 6, 20), 1, 19),
    ],
)
def test_presets(days, preset, today, first, last):
    got = [r.order_date.day for r in mart.metrics_in_preset(days, preset, today).collect()]
    assert got == list(range(first, last + 1))
    start, end = mart.preset_range(days, preset, today).first()
    assert (start.day, end.day) == (first, last)


def test_range_bounds_and_trend(days):
    assert tuple(mart.date_range(days).first()) == (date(2026, 6, 1), date(2026, 6, 20))
    some = mart.metrics_between(days, date(2026, 6, 2), date(2026, 6, 3))
    assert [r.order_date.day for r in some.collect()] == [2, 3]
    trend = fx.rows(mart.metric_trend(some), "order_date", "metric", "value")
    assert len(trend) == 10 and (date(2026, 6, 2), "total_gmv", 200.0) in trend


def test_kpi_header(days):
    assert mart.kpi_header(days).first().asDict() == {
        "orders": 203, "gmv": 21000, "delivered": 160, "cancelled": 40,
        "average_order": 131.25, "cancellation_rate": 40 / 203,
    }
    assert tuple(mart.kpi_header(days.limit(0)).first()) == (0, 0, 0, 0, 0.0, 0.0)
