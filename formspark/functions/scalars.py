"""Small scalar column helpers (all JVM-side built-ins, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace stripped from both ends of answers and options, newlines included
# (plain ``trim`` only strips spaces).  Python escapes: SQL literals lack \v.
WHITESPACE = " \t\n\r\f\v"


def strip_all(c: Column) -> Column:
    """Trim every kind of whitespace from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def null_if_empty(c: Column) -> Column:
    """Unmatched regex groups come back as ''; turn them into null."""
    return F.nullif(c, F.lit(""))


def epoch_ms_to_timestamp(c: Column) -> Column:
    """Lenient epoch-milliseconds text/number to a UTC timestamp ('not scheduled' -> null).

    Text without a digit is not cast: a failed cast costs an exception for each row.
    """
    return F.timestamp_millis(F.when(c.cast("string").rlike("[0-9]"), c.try_cast("bigint")))


def minutes_to_interval(c: Column) -> Column:
    """Integer minutes (possibly text) to a day-time interval."""
    return F.make_dt_interval(F.lit(0), F.lit(0), c.try_cast("int"), F.lit(0))


def interval_ms(c: Column) -> Column:
    """Day-time interval to total milliseconds (BIGINT)."""
    return F.unix_millis(F.timestamp_millis(F.lit(0)) + c)


def iso_duration(c: Column) -> Column:
    """Day-time interval to ISO-8601 duration text, e.g. ``-PT4H``, ``PT5H30M``, ``PT0S``.

    Days are written as ``nD``; zero components are omitted; a zero duration is
    ``PT0S``; negative durations carry one leading ``-``.
    """
    return iso_of_ms(interval_ms(c))


def iso_of_ms(ms: Column) -> Column:
    """:func:`iso_duration` of milliseconds; two different numbers have different texts."""
    a = F.abs(ms)
    days = F.floor(a / F.lit(86_400_000)).cast("bigint")
    hours = F.floor((a % F.lit(86_400_000)) / F.lit(3_600_000)).cast("bigint")
    mins = F.floor((a % F.lit(3_600_000)) / F.lit(60_000)).cast("bigint")
    msec = (a % F.lit(60_000)).cast("bigint")
    secs_txt = F.when(
        msec % 1000 == 0, (msec / 1000).cast("bigint").cast("string")
    ).otherwise(F.regexp_replace(F.format_string("%.3f", msec / F.lit(1000.0)), "0+$", ""))
    time_part = F.concat(
        F.when(hours > 0, F.concat(hours.cast("string"), F.lit("H"))).otherwise(F.lit("")),
        F.when(mins > 0, F.concat(mins.cast("string"), F.lit("M"))).otherwise(F.lit("")),
        F.when(msec > 0, F.concat(secs_txt, F.lit("S"))).otherwise(F.lit("")),
    )
    body = F.concat(
        F.lit("P"),
        F.when(days > 0, F.concat(days.cast("string"), F.lit("D"))).otherwise(F.lit("")),
        F.when(time_part != "", F.concat(F.lit("T"), time_part)).otherwise(F.lit("")),
    )
    return (
        F.when(ms.isNull(), F.lit(None).cast("string"))
        .when(ms == 0, F.lit("PT0S"))
        .otherwise(F.concat(F.when(ms < 0, F.lit("-")).otherwise(F.lit("")), body))
    )


def to_utc_date(ts: Column) -> Column:
    """Timestamp to its calendar date in the session time zone (UTC by contract)."""
    return F.to_date(ts)


def concat_strict(*cols: Column, sep: str = "_") -> Column:
    """Concatenate with a separator; null if any part is null (unlike concat_ws)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(c.cast("string"))
    return F.concat(*parts)


def all_true(cols: list[Column]) -> Column:
    """Row-wise AND over boolean columns (true for an empty list)."""
    if not cols:
        return F.lit(True)
    return F.forall(F.array(*cols), lambda x: x)
