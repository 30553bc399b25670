"""Timetable time, service dates and wall-clock helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_TZ = "Europe/Warsaw"
HALF_HOUR_US = 1_800_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gtfs_hour(t: Column | str) -> Column:
    """Hour part of an ``H:MM:SS`` text; may be 24 or more. NULL for unreadable text."""
    return F.split_part(_col(t), F.lit(":"), F.lit(1)).try_cast("int")


def gtfs_seconds(t: Column | str) -> Column:
    """Seconds since the start of the service day of an ``H:MM:SS`` text."""
    part = lambda i: F.split_part(_col(t), F.lit(":"), F.lit(i)).try_cast("int")
    return part(1) * 3600 + part(2) * 60 + part(3)


def is_night(t: Column | str) -> Column:
    """True when a timetable time belongs to the next calendar day."""
    return F.coalesce(gtfs_hour(t) > 23, F.lit(False))


def normalize_time(t: Column | str, pad: bool = False) -> Column:
    """Bring hours of 24 and more into 0-23; ``pad`` keeps two hour digits."""
    hour = (gtfs_hour(t) - 24).cast("string")
    if pad:
        hour = F.when(F.length(hour) < 2, F.lpad(hour, 2, "0")).otherwise(hour)
    return F.when(is_night(t), F.concat(hour, F.right(_col(t), F.lit(6)))).otherwise(_col(t))


def shift_date(d: Column | str, t: Column | str) -> Column:
    """Service date moved to the calendar date on which the timetable time happens."""
    return F.when(is_night(t), F.date_add(_col(d), 1)).otherwise(_col(d))


def date_text(d: Column | str) -> Column:
    """``yyyyMMdd`` text; casts are much cheaper than a pattern formatter."""
    return F.replace(_col(d).cast("string"), F.lit("-"), F.lit(""))


def parse_date(text: Column | str) -> Column:
    """Date of a ``yyyyMMdd`` text, NULL for anything else."""
    part = lambda start, n: F.substring(_col(text), start, n)
    dashed = F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2)).try_cast("date")
    return F.when(F.length(_col(text)) == 8, dashed)


def planned_timestamp(d: Column | str, t: Column | str) -> Column:
    """Wall-clock moment of a timetable time on a date."""
    return F.timestamp_add("SECOND", gtfs_seconds(t), _col(d).cast("timestamp_ntz"))


def epoch_to_local(seconds: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Epoch seconds to local wall clock, whatever the session zone is."""
    utc = F.timestamp_add("SECOND", _col(seconds), F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def minutes_between(a: Column | str, b: Column | str) -> Column:
    """Number of minute boundaries crossed from ``a`` to ``b`` (signed)."""
    minute = lambda c: F.floor(F.unix_timestamp(_col(c)) / 60)
    return (minute(b) - minute(a)).cast("long")


def at_least_zero(x: Column) -> Column:
    """Negative values become 0, NULL stays NULL."""
    return F.when(x < 0, F.lit(0).cast("long")).otherwise(x)


def seconds_between(a: Column | str, b: Column | str) -> Column:
    return F.unix_timestamp(_col(b)) - F.unix_timestamp(_col(a))


def seconds_of_day(ts: Column | str) -> Column:
    c = _col(ts)
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def elapsed_wrap(start_seconds: Column, now_seconds: Column) -> Column:
    """Seconds from a start to a later time of day, across at most one midnight."""
    return F.pmod(now_seconds - start_seconds, F.lit(86400))


def day_cycle(ts: Column | str) -> dict[str, Column]:
    """Position in the day as an angle with its sine and cosine."""
    theta = F.lit(2 * math.pi) * seconds_of_day(ts) / F.lit(86400)
    return {
        "seconds_since_midnight": seconds_of_day(ts),
        "theta": theta,
        "time_sin": F.sin(theta),
        "time_cos": F.cos(theta),
    }


def weekday_name(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "EEEE")


def weekday_number(ts: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(_col(ts))


def round_half_hour(ts: Column | str) -> Column:
    """Nearest half hour as ``HH:MM``; exact ties go to the even half hour."""
    c = _col(ts)
    whole = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000
    micros = whole + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    slot, rest = F.floor(micros / HALF_HOUR_US), F.pmod(micros, F.lit(HALF_HOUR_US))
    up = F.when(rest > HALF_HOUR_US // 2, 1).when(rest == HALF_HOUR_US // 2, slot % 2).otherwise(0)
    minutes = F.pmod((slot + up) * 30, F.lit(1440))
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    return F.concat(two(F.floor(minutes / 60)), F.lit(":"), two(minutes % 60))
