"""Time expressions on TIMESTAMP_NTZ wall-clock columns, independent of the session time zone.

Expressions are given as SQL text: one short call builds a whole expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliospark.config import TIMEZONE

MICROS_PER_SECOND = 1_000_000
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_OFFSET = r"\s*([+-]\d{2}):?(\d{2})(\s*UTC)?$"


def utc_to_local(df: DataFrame, name: str, tz: str = TIMEZONE) -> Column:
    """Local wall-clock time of a UTC column; unreadable strings become NULL.

    Strings without an offset are taken as UTC, strings with one are honoured, and a trailing
    `` UTC`` is dropped. TIMESTAMP columns are instants, TIMESTAMP_NTZ columns are UTC wall clock.
    """
    kind = df.schema[name].dataType
    c = f"`{name}`"
    if isinstance(kind, T.TimestampNTZType):
        utc = c
    elif isinstance(kind, T.TimestampType):
        utc = _wall_clock(c)
    else:
        # Regular expressions only run on the rare spellings that carry a zone.
        clock = f"substr({c}, 11)"
        marked = " OR ".join(f"contains({clock}, '{mark}')" for mark in ("+", "-", "Z", "UTC"))
        zoned = _wall_clock(f"try_to_timestamp(regexp_replace({c}, r'{_OFFSET}', '$1:$2'))")
        named = rf"try_cast(regexp_replace({c}, r'\s*(UTC|Z)$', '') AS TIMESTAMP_NTZ)"
        utc = (f"CASE WHEN NOT ({marked}) THEN try_cast({c} AS TIMESTAMP_NTZ)"
               f" WHEN {c} RLIKE r'{_OFFSET}' THEN {zoned} ELSE {named} END")
    return F.expr(f"convert_timezone('UTC', '{tz}', {utc})")


def _wall_clock(instant: str) -> str:
    return f"{_EPOCH} + unix_micros({instant}) * INTERVAL '0.000001' SECOND"


def local_to_utc(name: str, tz: str = TIMEZONE) -> Column:
    return F.expr(f"convert_timezone('{tz}', 'UTC', `{name}`)")


def floor_bucket(name: str, minutes: int) -> Column:
    """Floor to a bucket that divides the day (5, 60, 180, 1440 minutes …)."""
    if 1440 % minutes:
        raise ValueError("bucket must divide a day")
    midnight = f"CAST(CAST(`{name}` AS DATE) AS TIMESTAMP_NTZ)"
    if minutes == 1440:
        return F.expr(midnight)
    if minutes == 60:
        return F.expr(f"{midnight} + make_dt_interval(0, hour(`{name}`))")
    minute = f"hour(`{name}`) * 60 + minute(`{name}`)"
    return F.expr(f"{midnight} + make_dt_interval(0, 0, ({minute}) - pmod({minute}, {minutes}))")


def _seconds(c: str) -> str:
    return f"unix_date(CAST({c} AS DATE)) * 86400L + hour({c}) * 3600 + minute({c}) * 60 + second({c})"


def epoch_seconds(name: str) -> Column:
    """Whole seconds since 1970 of a wall-clock column."""
    return F.expr(_seconds(f"`{name}`"))


def epoch_micros(name: str) -> Column:
    c = f"`{name}`"
    return F.expr(f"(unix_date(CAST({c} AS DATE)) * 86400L + hour({c}) * 3600 + minute({c}) * 60) * 1000000L"
                  f" + CAST(extract(SECOND FROM {c}) * 1000000 AS BIGINT)")


def whole_days(start: Column, end: Column) -> Column:
    """Complete days between two wall-clock values, rounded down."""
    return F.floor(_micros(end - start) / 8.64e10).cast("long")


def _micros(interval: Column) -> Column:
    days, hours = F.extract(F.lit("DAY"), interval), F.extract(F.lit("HOUR"), interval)
    minutes, seconds = F.extract(F.lit("MINUTE"), interval), F.extract(F.lit("SECOND"), interval)
    whole = (days.cast("long") * 86400 + hours.cast("long") * 3600 + minutes.cast("long") * 60) * MICROS_PER_SECOND
    return whole + (seconds * MICROS_PER_SECOND).cast("long")


def from_epoch_seconds(c: Column) -> Column:
    return F.expr(_EPOCH) + c * F.expr("INTERVAL '1' SECOND")


def hours(n: int) -> Column:
    return F.expr(f"INTERVAL {n} HOUR")


def days(n: int) -> Column:
    return F.expr(f"INTERVAL {n} DAY")


def minutes(n: int) -> Column:
    return F.expr(f"INTERVAL {n} MINUTE")


def month_start(name: str) -> Column:
    return F.expr(f"trunc(CAST(`{name}` AS DATE), 'month')")


def week_start(name: str) -> Column:
    """Monday of the week."""
    return F.expr(f"date_sub(CAST(`{name}` AS DATE), weekday(`{name}`))")


def calendar_parts(name: str) -> dict[str, Column]:
    return {"year": F.year(name), "month": F.month(name), "day": F.dayofmonth(name),
            "day_of_week": F.weekday(name), "week_start": week_start(name)}
