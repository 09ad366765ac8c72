"""Epoch milliseconds to wall-clock values without depending on the session time zone.

Everything goes through TIMESTAMP_NTZ, so a plan gives the same hour or date
whatever ``spark.sql.session.timeZone`` a cluster runs with; the zone of the
data is an argument.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First hour after the slot, and the slot's name.
PAY_TIME_SLOTS = (
    (6, "凌晨"),
    (9, "早晨"),
    (12, "上午"),
    (14, "中午"),
    (18, "下午"),
    (22, "晚上"),
    (24, "夜间"),
)


def _epoch() -> Column:
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))


def wall_clock(ms: Column, zone: str = "UTC") -> Column:
    """Local date and time (TIMESTAMP_NTZ) of an epoch-millisecond instant in ``zone``."""
    utc = F.timestamp_add("MILLISECOND", ms, _epoch())
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def epoch_ms(ntz: Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ column read as UTC."""
    return F.timestamp_diff("MILLISECOND", _epoch(), ntz)


def pay_time_slot(ms: Column, zone: str = "UTC") -> Column:
    """Name of the part of day an instant falls into; NULL for a NULL instant."""
    by_hour = [next(name for until, name in PAY_TIME_SLOTS if hour < until) for hour in range(24)]
    return F.get(F.expr(f"array({', '.join(repr(name) for name in by_hour)})"), F.hour(wall_clock(ms, zone)))


def birth_date(raw: Column, unit: str = "days", zone: str = "UTC") -> Column:
    """Captured birthday to DATE. Capture tools send epoch days; older feeds send epoch milliseconds."""
    if unit == "days":
        return F.date_from_unix_date(raw.cast("int"))
    if unit == "ms":
        return F.to_date(wall_clock(raw, zone))
    raise ValueError(f"birthday unit must be 'days' or 'ms', not {unit!r}")


def slot_of(ms: Column, width_ms: int) -> Column:
    """Index of the epoch-aligned tumbling interval of ``width_ms`` an instant falls into."""
    return F.floor(ms / F.lit(width_ms)).cast("long")
