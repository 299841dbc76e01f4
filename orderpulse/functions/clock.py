"""Column expressions over time: ages, duration text, weekday labels, date ranges."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderpulse import vocabulary as v

DAY_MINUTES = 24 * 60


def parse_time(text: Column | str) -> Column:
    """ISO text to TIMESTAMP; unreadable text gives NULL."""
    return F.try_to_timestamp(text)


def as_time(moment: Column | datetime | str) -> Column:
    """A point in time as TIMESTAMP; a datetime without a zone means UTC."""
    if isinstance(moment, datetime) and moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment if isinstance(moment, Column) else F.lit(moment).cast("timestamp")


def minutes_since(moment: Column, now: Column | datetime | str) -> Column:
    """Age in minutes, NULL for a NULL time. Values without a zone are read as UTC."""
    micros = F.unix_micros(as_time(now)) - F.unix_micros(moment.cast("timestamp"))
    return micros / F.lit(60_000_000.0)


def stage_seconds(start: str, end: str) -> Column:
    """Whole seconds between two stages; NULL if either is missing."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def duration_text(minutes: Column) -> Column:
    """'just now', '12 min', '3 h 5 min', '2 d 4 h', or a dash when there is no age."""
    whole = F.floor(minutes).cast("bigint")
    days = F.floor(whole / DAY_MINUTES)
    hours = F.floor(F.pmod(whole, F.lit(DAY_MINUTES)) / 60)
    mins = F.pmod(whole, F.lit(60))

    def part(amount: Column, unit: str) -> Column:
        return F.when(amount > 0, F.concat_ws(" ", amount.cast("string"), F.lit(unit)))

    return (
        F.when(minutes.isNull(), F.lit("—"))
        .when(minutes < 1, F.lit("just now"))
        .when(days > 0, F.concat_ws(" ", part(days, "d"), part(hours, "h")))
        .otherwise(F.concat_ws(" ", part(hours, "h"), part(mins, "min")))
    )


def ago_text(minutes: Column) -> Column:
    text = duration_text(minutes)
    return (
        F.when(minutes.isNull(), F.lit("no data yet"))
        .when(minutes < 1, text)
        .otherwise(F.concat(text, F.lit(" ago")))
    )


def weekday_label(code: Column) -> Column:
    """Label of a dayofweek() code."""
    return F.element_at(F.array(*[F.lit(day) for day in v.WEEKDAYS]), code)


def days_until_today(code: Column, today: date) -> Column:
    """Sort key that puts today's weekday last."""
    today_code = today.isoweekday() % 7 + 1
    return F.pmod(code - F.lit(today_code + 1), F.lit(7))


def within_days(moment: Column, start: date, end: date) -> Column:
    """Inclusive date range on a time column, as half-open bounds the scan can use."""
    return (moment >= F.lit(start)) & (moment < F.lit(end + timedelta(days=1)))
