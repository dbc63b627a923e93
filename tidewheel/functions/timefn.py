"""Instants, local time and calendar parts; counts and parts are long."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def instant(ms: Column) -> Column:
    """Epoch milliseconds (long or double) to a timestamp; calendar parts then follow the session zone."""
    return F.timestamp_millis(ms.cast("long"))


def utc_naive(ms: Column) -> Column:
    """Epoch milliseconds to a zone-less UTC timestamp, whatever the session zone."""
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=ms.cast("long").cast("decimal(18,0)") / 1000)


def local(ts: Column, zone: str | None = None, offset_hours: int = -4) -> Column:
    """A fixed offset (default, as the reference rule has it), or a named zone with its daylight-saving changes."""
    return F.from_utc_timestamp(ts, zone) if zone else ts + F.expr(f"INTERVAL {offset_hours} HOUR")


def hour(ts: Column) -> Column:
    return F.hour(ts).cast("long")


def dow_sunday0(ts: Column) -> Column:
    return (F.dayofweek(ts) - 1).cast("long")


def dow_monday0(ts: Column) -> Column:
    return F.weekday(ts).cast("long")


def year(ts: Column) -> Column:
    return F.year(ts).cast("long")


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def day_name(dow: Column) -> Column:
    names = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    return F.element_at(F.array(*map(F.lit, names)), (dow + 1).cast("int"))
