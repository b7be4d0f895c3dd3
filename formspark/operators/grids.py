"""Attendance and completion grids over a participant roster.

Activity facts come from the report: respondent ``target_user.secret_id``,
trimmed activity name, UTC date of the activity start, and whether any row
of that activity carries an item id (an activity counts as completed when
its submission has at least one item).

* **attendance**: activities whose name starts with ``daily_prefix``; one
  row per participant x distinct activity date (dates of daily activities),
  one BOOLEAN column per daily activity name;
* **completion**: all other activities; one row per participant, one BOOLEAN
  per activity name and ``complete`` = all of them.

Participants without activity are kept (false); activity of people not in
the roster is dropped.  Null activity names fall in neither grid.

Names: any activity name works. A name that equals an identifier column, ``activity_date``, ``complete`` or
another name but for case gets the suffix ``__2``, ``__3`` ...; the fixed columns keep theirs.

Plan: **one** scan of the report reduces its rows to flags, (secret_id, date, name, was any row with an
item id), with partial aggregation, so a respondent holding a third of all rows costs one row for each day and
name and task before the shuffle. The flags are written as a small table in the shared scratch folder. Names
(the columns, bounded by the questionnaire) and dates come from it, and so does the grid: the names done
by each person [and date] become one set of name codes, and every column is a look-up in that set, whatever
its name. Dates are a frame of their own, multiplied with the roster under a broadcast when
their measured number is at most ``BROADCAST_DATES``; they are never literals in a plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import all_true, strip_all, to_utc_date
from ..session import ensure_checkpoint_dir, scratch_path
from .structs import column, distinct_names

# Fixed value: name prefix of the daily check-in/check-out activities.
DAILY_PREFIX = "Student Check"
IDENTIFIERS = ("secret_id", "nickname", "first_name", "last_name", "site")
OPTIONAL_IDENTIFIERS = ("room",)

#: Dates that are broadcast to the roster (16 bytes each); more are joined by a cartesian product of partitions.
BROADCAST_DATES = 1 << 20


def activity_facts(report: DataFrame, tz: str | None = None) -> DataFrame:
    """(secret_id, trimmed activity name, activity date, item id) per report row.

    The date is the UTC calendar date of the activity start; with ``tz`` (an
    IANA zone such as ``America/New_York``) it is the local date there.
    """
    start = F.col("activity_time.start_time")
    day = to_utc_date(start) if tz is None else F.to_date(F.from_utc_timestamp(start, tz))
    return report.select(
        F.col("target_user.secret_id").alias("secret_id"),
        strip_all(F.col("activity.name")).alias("activity_name"),
        day.alias("activity_date"),
        F.col("item.id").alias("item_id"),
    )


def activity_flags(report: DataFrame, tz: str | None = None) -> DataFrame:
    """(secret_id, activity_date, activity_name, done): the report's facts reduced in one scan, as a written table."""
    flags = (activity_facts(report, tz).where(F.col("activity_name").isNotNull())
             .groupBy("secret_id", "activity_date", "activity_name").agg((F.count("item_id") > 0).alias("done")))
    ensure_checkpoint_dir(report.sparkSession)
    path = scratch_path(report.sparkSession, "flags")
    flags.write.parquet(path)
    return report.sparkSession.read.schema(flags.schema).parquet(path)


def _code(name: Column) -> Column:
    return F.xxhash64(name)


def _names(flags: DataFrame) -> list[tuple[str, int]]:
    """(activity name, its code) of every grid column: bounded by the questionnaire, not by rows."""
    names = sorted(tuple(r) for r in flags.select("activity_name", _code(F.col("activity_name"))).distinct().collect())
    if len({code for _, code in names}) < len(names):
        raise ValueError("two activity names have the same 64-bit hash")
    return names


def identifier_columns(participants: DataFrame) -> list[str]:
    return [c for c in IDENTIFIERS + OPTIONAL_IDENTIFIERS if c in participants.columns]


def _done(flags: DataFrame, *keys: str) -> DataFrame:
    """The codes of the names done, one set for each combination of ``keys`` (``_0``, ``_1``)."""
    done = flags.where("done").groupBy(*keys).agg(F.collect_set(_code(F.col("activity_name"))).alias("_done"))
    return done.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], "_done")


def _columns(names: list[tuple[str, int]], fixed: list[str], last: list[str]) -> list[tuple[str, Column]]:
    """(column name, flag) of every activity name, apart from the names of the fixed columns."""
    out = distinct_names([*fixed, *last, *[n for n, _ in names]])[len(fixed) + len(last):]
    flag = lambda code: F.coalesce(F.array_contains("_done", F.lit(code).cast("bigint")), F.lit(False))
    return [(n, flag(code)) for n, (_, code) in zip(out, names, strict=True)]


def attendance(report: DataFrame, participants: DataFrame, *, daily_prefix: str = DAILY_PREFIX,
               tz: str | None = None, flags: DataFrame | None = None) -> DataFrame | None:
    """Participant x date grid of daily activities (None when there are none).

    ``flags``: the report's :func:`activity_flags`, when they are at hand.
    """
    flags = (activity_flags(report, tz) if flags is None else flags).where(F.col("activity_name").startswith(daily_prefix))
    names = _names(flags)
    if not names:
        return None
    ids = identifier_columns(participants)
    dates = flags.select(F.col("activity_date").alias("_date")).where("_date is not null").distinct()
    if dates.count() <= BROADCAST_DATES:
        dates = F.broadcast(dates)
    grid = participants.select(*ids).crossJoin(dates)
    joined = grid.join(_done(flags, "secret_id", "activity_date"), (F.col("secret_id") == F.col("_0")) & (F.col("_date") == F.col("_1")), "left")
    cells = _columns(names, [*ids, "activity_date"], [])
    return joined.select(*ids, F.col("_date").alias("activity_date"), *[f.alias(n) for n, f in cells])


def completion(report: DataFrame, participants: DataFrame, *, daily_prefix: str = DAILY_PREFIX,
               tz: str | None = None, flags: DataFrame | None = None) -> DataFrame | None:
    """One row per participant: a flag per non-daily activity and ``complete``."""
    flags = (activity_flags(report, tz) if flags is None else flags).where(~F.col("activity_name").startswith(daily_prefix))
    names = _names(flags)
    if not names:
        return None
    ids = identifier_columns(participants)
    joined = participants.select(*ids).join(_done(flags, "secret_id"), F.col("secret_id") == F.col("_0"), "left")
    cells = _columns(names, ids, ["complete"])
    return joined.select(*ids, *[f.alias(n) for n, f in cells], all_true([f for _, f in cells]).alias("complete"))


def completion_summary(completion_grid: DataFrame) -> DataFrame:
    ids = [c for c in IDENTIFIERS + OPTIONAL_IDENTIFIERS if c in completion_grid.columns]
    return completion_grid.select(*ids, "complete")
