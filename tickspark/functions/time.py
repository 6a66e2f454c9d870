"""Time expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def width_us(width: str) -> int:
    """Length of a width such as ``"100 milliseconds"`` or ``"1 hour"`` in microseconds."""
    amount, unit = width.split()
    return int(amount) * _UNIT_US[unit.rstrip("s")]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def time_bucket(ts: Column | str, width: str) -> Column:
    """Start of the epoch-aligned bucket of the given width that holds ``ts``."""
    us = F.unix_micros(_col(ts))
    return F.timestamp_micros(us - F.pmod(us, F.lit(width_us(width))))


def elapsed_us(start: Column | str, end: Column | str) -> Column:
    return F.unix_micros(_col(end)) - F.unix_micros(_col(start))


def elapsed_ms(start: Column | str, end: Column | str) -> Column:
    return elapsed_us(start, end) / F.lit(1000.0)


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    return elapsed_us(start, end) / F.lit(1e6)


def epoch_seconds(ts: Column | str) -> Column:
    return F.unix_micros(_col(ts)) / F.lit(1e6)


def day_of_week(ts: Column | str) -> Column:
    """Day of week counted from Sunday = 0."""
    return F.dayofweek(_col(ts)) - 1


def from_epoch_ms(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def instant(value: str) -> Column:
    """A timestamp literal, read in the session zone (UTC)."""
    return F.lit(value).cast("timestamp")


def before(asof: str, interval: str) -> Column:
    return instant(asof) - F.expr(f"INTERVAL {interval}")


def order_in_bucket(ts: Column | str, event_id: Column | str, width: str) -> Column:
    """One number that orders the rows of a bucket by (time, id), for any 64-bit id.

    The offset in the bucket takes the digits above the twentieth, the id, shifted to be positive, those
    below; a NULL id comes before all others. A decimal is a fixed-width key, which lets min_by and max_by
    run in a hash aggregate, where a struct key would sort the ticks first.
    """
    offset = F.pmod(F.unix_micros(_col(ts)), F.lit(width_us(width))).cast("decimal(12,0)")
    place = F.coalesce(_col(event_id).cast("decimal(20,0)") + F.expr("9223372036854775809BD"), F.lit(0).cast("decimal(21,0)"))
    return (offset * F.expr("100000000000000000000BD") + place).cast("decimal(35,0)")


def order_of_rows(ts: Column | str, event_id: Column | str | None = None) -> Column:
    """One number that orders rows by (time, id), for any time up to the year 9999 and any 64-bit id; NULLs come first."""
    us = F.coalesce(F.unix_micros(_col(ts)), F.lit(-(10**17)))
    if event_id is None:
        return us
    place = F.coalesce(_col(event_id).cast("decimal(20,0)") + F.expr("9223372036854775809BD"), F.lit(0).cast("decimal(21,0)"))
    return (us.cast("decimal(18,0)") * F.expr("100000000000000000000BD") + place).cast("decimal(38,0)")


def utc_instant(value: str) -> datetime:
    """The instant a text names, as a UTC time; a text without a zone is in UTC."""
    at = datetime.fromisoformat(value.strip())
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)
