"""Partition periods: hours, days, weeks (from Monday) and months in a time zone.

Times are instants (``timestamp``) or clock times in UTC (``timestamp_ntz``). The arithmetic
is done on ``timestamp_ntz`` with functions that know no zone, so results do not depend on
the session's. A key is written from the clock of the zone at the start of the period.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT = {"hourly": "hour", "daily": "day", "weekly": "week", "monthly": "month"}
_FORMAT = {"hour": "yyyy-MM-dd-HH:mm", "day": "yyyy-MM-dd",
           "week": "yyyy-MM-dd", "month": "yyyy-MM-dd"}
# Days that a calendar without a declared start goes back.
DEFAULT_DAYS = {"hour": 30, "day": 30, "week": 180, "month": 365}
# Parts of a key format, in letters and in percent signs, and where they
# stand in the text of a timestamp.
_PARTS = {"yyyy": ("%Y", 1, 4), "yy": ("%y", 3, 2), "MM": ("%m", 6, 2), "dd": ("%d", 9, 2),
          "HH": ("%H", 12, 2), "mm": ("%M", 15, 2), "ss": ("%S", 18, 2)}
_DAY_MICROS = 86_400_000_000
#: minutes that all offsets of zones from UTC are multiples of, at least since 1972
QUARTER = 15


def period_unit(cadence: str | None) -> str:
    """Unit of a cadence; none or an unknown one means daily."""
    return _UNIT.get((cadence or "daily").lower(), "day")


def key_format(cadence: str | None, fmt: str | None = None) -> str:
    return fmt or _FORMAT[period_unit(cadence)]


def _format_parts(fmt: str) -> list[tuple[str | None, str]]:
    """(part, text) of a format in letters (yyyyMMdd) or percent signs (%Y%m%d); other text has no part."""
    signs = {sign: part for part, (sign, _, _) in _PARTS.items()}
    pattern = r"%(?:.|$)|[^%]+" if "%" in fmt else r"'[^']*'|([A-Za-z])\1*|[^A-Za-z']+|'"
    found = []
    for text in (m.group(0) for m in re.finditer(pattern, fmt)):
        part = signs.get(text) if "%" in fmt else text if text in _PARTS else None
        if part is None and (text[0] == "%" or "%" not in fmt and text[0].isalpha()):
            raise ValueError(f"key format {fmt!r} has {text!r}; known are {', '.join([*_PARTS, *signs])}")
        if part is None and text[0] == "'" and "%" not in fmt:
            text = text[1:-1] or "'"
        found.append((part, text))
    return found


def step(cadence: str | None) -> Column:
    return F.expr(f"INTERVAL 1 {period_unit(cadence)}")


def minutes(n: int) -> Column:
    return F.expr(f"INTERVAL {n} MINUTE")


def utc_clock(ts: Column) -> Column:
    """The clock in UTC at an instant; a time without a zone is that clock already."""
    micros = F.unix_micros(ts.cast("timestamp"))
    days = F.floor(micros.cast("decimal(20,0)") / F.lit(_DAY_MICROS)).cast("int")
    seconds = (F.pmod(micros, F.lit(_DAY_MICROS)).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    clock = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)
    return F.when(F.typeof(ts) == "timestamp_ntz", ts.cast("timestamp_ntz")).otherwise(clock)


def instant(clock: Column) -> Column:
    """The instant at which the clock in UTC shows a time."""
    seconds = F.extract(F.lit("SECOND"), clock).cast("decimal(18,6)")
    return F.timestamp_micros(
        F.unix_date(clock.cast("date")).cast("bigint") * _DAY_MICROS
        + (F.hour(clock) * 60 + F.minute(clock)).cast("bigint") * 60_000_000
        + (seconds * 1_000_000).cast("bigint"))


def local_time(clock: Column, tz: str) -> Column:
    """The clock of a zone, from that in UTC."""
    return clock if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), clock)


def utc_time(local: Column, tz: str) -> Column:
    """The clock in UTC, from that of a zone; a time skipped there moves past the gap."""
    return local if tz == "UTC" else F.convert_timezone(F.lit(tz), F.lit("UTC"), local)


def floor_to(clock: Column, unit: str) -> Column:
    """Start of the hour, day, week or month a clock shows."""
    if unit == "hour":
        zero = F.lit(0)
        return F.make_timestamp_ntz(F.year(clock), F.month(clock), F.day(clock), F.hour(clock), zero, zero)
    day = clock.cast("date")
    return (day if unit == "day" else F.trunc(day, unit)).cast("timestamp_ntz")


def key_of(start: Column, cadence: str | None, fmt: str | None = None) -> Column:
    """Key of a period from the clock at its start."""
    text = start.cast("string")
    return F.concat(*[F.lit(own) if part is None else F.substring(text, *_PARTS[part][1:])
                      for part, own in _format_parts(key_format(cadence, fmt))])


def partition_key(ts: Column, cadence: str | None, tz: str = "UTC",
                  fmt: str | None = None) -> Column:
    """Key of the period that a time falls in."""
    return key_of(floor_to(local_time(utc_clock(ts), tz), period_unit(cadence)), cadence, fmt)


def _written(local: datetime, cadence: str | None, fmt: str | None) -> str:
    return "".join(text if part is None else local.strftime(_PARTS[part][0])
                   for part, text in _format_parts(key_format(cadence, fmt)))


def last_finished_key(now: datetime, cadence: str | None, tz: str = "UTC", fmt: str | None = None) -> str:
    """Key of the last period that ended at or before ``now``.

    ``now`` without a zone is taken as UTC.
    """
    unit = period_unit(cadence)
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    if unit == "hour":
        # back to where the clock last showed a full hour, then into the hour before
        at = now.astimezone(timezone.utc).replace(second=0, microsecond=0)
        at -= timedelta(minutes=at.minute % QUARTER)
        hour = _hour(at, tz)
        while _hour(at - timedelta(minutes=QUARTER), tz) == hour:
            at -= timedelta(minutes=QUARTER)
            if at.astimezone(ZoneInfo(tz)).minute == 0:
                break
        return _written(_hour(at - timedelta(minutes=QUARTER), tz), cadence, fmt)
    day = now.astimezone(ZoneInfo(tz)).replace(tzinfo=None, hour=0, minute=0, second=0, microsecond=0)
    if unit == "day":
        start = day - timedelta(days=1)
    elif unit == "week":
        start = day - timedelta(days=day.weekday() + 7)
    else:
        start = (day.replace(day=1) - timedelta(days=1)).replace(day=1)
    return _written(start, cadence, fmt)


def _hour(at: datetime, tz: str) -> datetime:
    return at.astimezone(ZoneInfo(tz)).replace(tzinfo=None, minute=0)


def key_bounds(key: str, cadence: str | None, tz: str = "UTC", fmt: str | None = None) -> tuple[datetime, datetime]:
    """First moment of the period of a key and first moment after it, in UTC without zone.

    An hour that a clock change repeats covers both.
    """
    unit, pattern = period_unit(cadence), "".join(
        text.replace("%", "%%") if part is None else _PARTS[part][0] for part, text in _format_parts(key_format(cadence, fmt)))
    start = datetime.strptime(key, pattern)
    if unit == "month":
        start = start.replace(day=1)
        end = (start + timedelta(days=32)).replace(day=1)
    else:
        end = start + {"hour": timedelta(hours=1), "day": timedelta(days=1),
                       "week": timedelta(days=7)}[unit]

    def utc(local: datetime) -> datetime:
        return local.replace(tzinfo=ZoneInfo(tz)).astimezone(timezone.utc).replace(tzinfo=None)
    first, after = utc(start), utc(end)
    if unit == "hour" and after <= first:
        # the next full hour is skipped by the clock
        after = first + timedelta(hours=1)
    return first, after
