"""Orders built stage by stage, and one small case for each defect."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from orderpulse import schemas

_FIELDS = [part.split()[0] for part in schemas.SEED_EVENT.split(", ")]
_MONEY = ("gmv", "food_cost", "delivery_fee", "service_fee", "discount")


def at(day: int, clock: str) -> datetime:
    return datetime.fromisoformat(f"2025-03-{day:02d}T{clock}:00")


def event(event_id, stage, order, time, customer, vendor, driver=None, money=(), cancel=(None, None)):
    known = {
        "event_id": event_id, "event_type": f"order_{stage}", "order_id": order, "occurred_at": time,
        "customer_id": customer, "vendor_id": vendor, "driver_id": driver,
        "cancelled_by": cancel[0], "cancel_reason": cancel[1], **dict(zip(_MONEY, money)),
    }
    return tuple(known.get(name) for name in _FIELDS)


def journey(order, start, steps, customer, vendor, driver=None, money=(), cancel=(None, None)):
    """One event for each stage, so many minutes after `start`; its id is made of order and stage."""
    return [
        event(
            f"{order}/{stage}", stage, order, start + timedelta(minutes=minutes), customer, vendor,
            driver if stage in ("picked_up", "delivered") else None,
            money if stage == "placed" else (), cancel if stage == "cancelled" else (None, None),
        )
        for stage, minutes in steps.items()
    ]


WHOLE = {"placed": 0, "confirmed": 7, "prepared": 29, "picked_up": 38, "delivered": 61}

CLEAN = [
    *journey("north-1", at(9, "18:20"), WHOLE, "eater-li", "stall-soup", "bike-7", (2450, 1900, 390, 210, 50)),
    *journey("north-2", at(9, "19:05"), {"placed": 0, "confirmed": 3}, "eater-mo", "stall-soup", money=(900, 700, 150, 50, 0)),
    *journey(
        "west-1", at(10, "08:15"), {"placed": 0, "confirmed": 12, "cancelled": 13}, "eater-mo", "stall-tea",
        money=(640, 500, 100, 45, 0), cancel=("vendor", "too_busy"),
    ),
]

# What a defect is -> rows that have it and no other.
DEFECTS = {
    "missing id": [
        *journey("south-3", at(14, "21:10"), {"placed": 0}, "eater-li", "stall-tea", money=(333, 300, 33, 0, 0)),
        event(None, "confirmed", "south-3", at(14, "21:19"), "eater-li", "stall-tea"),
    ],
    "delivered before it was placed": journey(
        "south-1", at(13, "20:00"), {"delivered": -15, "placed": 0, "confirmed": 2, "prepared": 6, "picked_up": 11},
        "eater-li", "stall-soup", "bike-7", (1500, 1200, 200, 100, 0),
    ),
    "type outside the contract": [event("survey-8", "rated", "east-3", at(12, "09:30"), "eater-mo", "stall-tea")],
    "id of another event": [
        event("north-2/confirmed", "placed", "south-2", at(14, "06:45"), "eater-mo", "stall-tea", money=(410, 300, 80, 30, 0))
    ],
    "vendor without a row": journey(
        "east-2", at(13, "11:11"), {"placed": 0, "confirmed": 5}, "eater-mo", "stall-gone", money=(830, 600, 180, 50, 0)
    ),
    "negative amount": journey("east-1", at(12, "07:00"), {"placed": 0}, "eater-li", "stall-tea", money=(-120, 80, 100, 0, 300)),
}


def with_defect(name: str) -> list[tuple]:
    return [*CLEAN, *DEFECTS[name]]


BAD = [*CLEAN, *(row for rows in DEFECTS.values() for row in rows)]


def events(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, schemas.SEED_EVENT)


def parents(spark: SparkSession) -> dict[str, DataFrame]:
    known = {"vendor": ("stall-soup", "stall-tea"), "customer": ("eater-li", "eater-mo"), "driver": ("bike-7", "bike-8")}
    return {
        f"dim_{name}": spark.createDataFrame([(key,) for key in keys], f"{name}_id string") for name, keys in known.items()
    }


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
