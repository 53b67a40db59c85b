"""Times (D1-D8): formats, intervals, rounding, expansion into days and years."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from taskspire.functions.names import as_column
from taskspire.schema import TIME_FORMAT

#: Days from 0001-01-01 to the epoch.
EPOCH_DAY = 719_162
DAY = 86_400


def parse_time(c: Column | str) -> Column:
    """D1."""
    return F.try_to_timestamp(as_column(c), F.lit(TIME_FORMAT))


def show_time(c: Column | str) -> Column:
    """D1."""
    return F.date_format(as_column(c), TIME_FORMAT)


def interval_seconds(text: str) -> int:
    """D2. '1d', '8h', '15m', '30s' or '30' in seconds."""
    m = re.fullmatch(r"\s*(-?\d+)\s*([dhms]?)\s*", text)
    if not m:
        raise ValueError(f"not an interval: {text!r}")
    return int(m[1]) * {"d": DAY, "h": 3600, "m": 60}.get(m[2], 1)


def round_time(ts: Column | str, granularity: timedelta) -> Column:
    """D3. The start of the period in which a time lies: of n days counted from 0001-01-01, or of a part of a day that divides it."""
    seconds = int(granularity.total_seconds())
    if seconds <= 0 or seconds != granularity.total_seconds() or (seconds % DAY and DAY % seconds):
        raise ValueError("the granularity must be whole days or divide a day")
    offset = EPOCH_DAY * DAY if seconds % DAY == 0 else 0
    return F.timestamp_seconds(F.floor((F.unix_seconds(as_column(ts).cast("timestamp")) + offset) / seconds) * seconds - offset)


def epoch_ms(ts: Column | str) -> Column:
    """D4."""
    return F.unix_millis(as_column(ts).cast("timestamp"))


def days_between(start: Column | str, end: Column | str) -> Column:
    """D5. Each day from start to end; none if end comes first; null if one is missing."""
    a, b = F.to_date(as_column(start)), F.to_date(as_column(end))
    return F.when(a <= b, F.sequence(a, b)).when(a.isNotNull() & b.isNotNull(), F.array().cast("array<date>"))


def api_time(text: str) -> datetime:
    """D6. A time or a day of a request."""
    for form in ("%Y-%m-%dT%H:%M:%S", "%Y-%m%dT%H:%M:%S", "%Y-%m-%d"):
        try:
            return datetime.strptime(text, form)
        except ValueError:
            continue
    raise ValueError(f"not a time: {text!r}")


def years(text: Column | str) -> Column:
    """D7. '2015' or '2015-2017' (also '+' and ' and ') as all the years."""
    c = as_column(text)
    first, last = F.substring(c, 1, 4).try_cast("int"), F.substring(c, -4, 4).try_cast("int")
    return F.when(first <= last, F.transform(F.sequence(first, last), lambda y: y.cast("string")))


def now_minus(delay: int, zone: str, clock: datetime) -> datetime:
    """S2. The source's local time of ``clock`` (aware), less ``delay`` seconds, whole seconds, without a zone."""
    return (clock.astimezone(ZoneInfo(zone)) - timedelta(seconds=delay)).replace(tzinfo=None, microsecond=0)


def months_or_days(start: datetime, end: datetime, prefix: str) -> list[str]:
    """D8, S21. Names of the partitions of an interval: each day's, or each month's with a wildcard if it is over 30 days."""
    days = (end.date() - start.date()).days
    each = [start.date() + timedelta(days=i) for i in range(days + 1)]
    return list(dict.fromkeys(f"{prefix}{d:%Y.%m}.*" for d in each)) if days > 30 else [f"{prefix}{d:%Y.%m.%d}" for d in each]
