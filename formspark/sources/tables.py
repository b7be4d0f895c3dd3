"""Raw export frames derived, in Spark, from the TPC-H-like benchmark tables.

There is no questionnaire export among the benchmark tables, so these build
export-layout rows (all STRING, the same columns as a CSV export) from them.
The work grows with the tables: one submission per order / event, items
exploded per submission with ``posexplode`` (narrow, no shuffle).

``orders_export``: submission = order, respondent = customer, activity =
order priority, and a fixed questionnaire of twelve items whose answers are
computed from order columns, plus two subscale columns filled on the first
item row of each submission.

``events_export``: submission = event, respondent = user, activity = event
type; one numeric item per event, absent (null item id) for low values.

``participants``: the roster side input from the customer table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ROWS_A_TASK, configure, spread


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column | int | str) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("string")


def _cat(*parts) -> Column:
    return F.concat(*[_s(p) for p in parts])


# The synthetic questionnaire (item name, type, options text).
MOOD_OPTIONS = "Very bad: 0 (score: 1), Bad: 1 (score: 2), Okay: 2 (score: 3), Good: 3 (score: 4), Very good: 4 (score: 5)"
COLOR_OPTIONS = "red: 0, green: 1, blue: 2, yellow: 3"
ENERGY_OPTIONS = "Low: 0, Medium: 1, High: 2"
STEPS_OPTIONS = "Min: 0, Max: 10"


def order_answers(k: Column, c: Column, status: Column, priority: Column, odate: Column) -> list[tuple]:
    """(name, type, options, answer) per item; answers are expressions of the order row."""
    day, month, year = F.dayofmonth(odate), F.month(odate), F.year(odate)
    yy = F.lpad(_s(year % 100), 2, "0")
    return [
        ("mood", "singleSelect", MOOD_OPTIONS,
         F.when(k % 13 == 0, F.lit("value: null"))
         .when(k % 7 == 0, _cat("value: ", k % 5, " | text: ", status))
         .otherwise(_cat("value: ", k % 5))),
        ("colors", "multiSelect", COLOR_OPTIONS,
         F.when(k % 11 == 0, F.lit("value: null"))
         .when(k % 3 == 0, _cat("value: ", k % 4))
         .otherwise(_cat("value: ", k % 4, ", ", (k + 1) % 4))),
        ("status_note", "text", None, _cat("Status ", status, "\n", priority)),
        ("order_day", "date", None,
         F.when(k % 5 == 0, _cat("date: ", day, "/", month, "/", yy))
         .otherwise(_cat("date: ", day, "/", month, "/", year))),
        ("sleep", "timeRange", None,
         _cat("time_range: from hr ", k % 24, " min ", k % 60, " / to hr ", F.floor(k / 7) % 24,
              " min ", F.floor(k / 3) % 60)),
        ("place", "geolocation", None,
         _cat("geo: lat ", c % 90, ".", F.lpad(_s(k % 10000), 4, "0"),
              " long -", k % 180, ".", F.lpad(_s(c % 1000), 3, "0"))),
        ("grid", "singleSelectRows", None,
         _cat("morning: ", k % 3, "\nevening: ", (k + 1) % 3, ", ", k % 2 + 3)),
        ("steps", "slider", STEPS_OPTIONS, _cat("value: ", k % 11)),
        ("bedtime", "time", None, _cat("time: hr ", k % 24, " min ", k % 60)),
        ("photo", "photo", None, _cat("uploads/photo-", k, ".jpg")),
        ("energy", "singleSelect", ENERGY_OPTIONS, _cat("value: ", k % 3)),
        ("remark", "paragraphText", None, _cat("text: ", priority)),
    ]


def _epoch_ms_of_day(odate: Column) -> Column:
    return F.datediff(F.to_date(odate), F.lit("1970-01-01").cast("date")).cast("bigint") * F.lit(86_400_000)


def orders_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows (all STRING) for every order x questionnaire item.

    The questionnaire is a literal array exploded per order; columns of the order are
    computed once for each order, and each exploded row computes only its own answer (a CASE on the item position).
    """
    configure(spark)
    o = spread(_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"), ROWS_A_TASK)
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    status, prio, odate = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    spec = order_answers(k, c, status, prio, odate)
    items = F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name"), F.lit(t).alias("type"),
                 F.lit(opts).cast("string").alias("options"))
        for i, (n, t, opts, _) in enumerate(spec)
    ])
    pos = F.col("_item.pos")
    answer = None
    for i, (_, _, _, ans) in enumerate(spec):
        answer = F.when(pos == i, ans) if answer is None else answer.when(pos == i, ans)
    start = _epoch_ms_of_day(odate) + (k % 86_400) * 1000 + k % 1000
    end = start + (k % 3600 + 60) * 1000
    prio_code = F.substring(prio, 1, 1)
    offset = F.when(k % 4 == 0, -240).when(k % 4 == 1, 0).when(k % 4 == 2, 330).otherwise(-300)
    first = pos == 0
    # What is the same for all items of an order is computed before the order becomes rows.
    of_order = {
        "target_id": _cat("cust-", c),
        "target_secret_id": _cat("S", F.lpad(_s(c), 6, "0")),
        "target_nickname": _cat("Customer ", c),
        "source_id": _cat("src-", c % 50),
        "source_secret_id": _cat("R", c % 50),
        "source_nickname": _cat("Reporter ", c % 50),
        "source_relation": F.when(k % 4 == 0, F.lit("admin")),
        "input_id": _cat("in-", c % 7),
        "input_secret_id": _cat("I", c % 7),
        "input_nickname": _cat("Input ", c % 7),
        "userId": _cat("acct-", c % 11),
        "secret_user_id": _cat("A", c % 11),
        "applet_version": F.when(k % 3 == 0, F.lit("2.2.4")).otherwise(F.lit("2.3.0")),
        "activity_flow_id": F.when(status == "F", F.lit("flow-F")),
        "activity_flow_name": F.when(status == "F", F.lit("Finished flow")),
        "activity_flow_submission_id": F.when(status == "F", _cat("fs-", k)),
        "activity_id": _cat("act-", prio_code),
        "activity_name": prio,
        "activity_submission_id": _cat("sub-", k),
        "activity_start_time": _s(start),
        "activity_end_time": _s(end),
        "activity_schedule_id": _cat("sch-", prio_code),
        "activity_schedule_history_id": _cat("sch-", prio_code, "_", F.date_format(odate, "yyyyMMdd"), "-1"),
        "activity_schedule_start_time": F.when(k % 4 == 0, F.lit("not scheduled")).otherwise(_s(start - 600_000)),
        "utc_timezone_offset": _s(offset),
        "rawScore": _s(k % 40),
        "_total": _s(F.col("o_totalprice")),
        "_score": _s(k % 100),
    }
    of = lambda *names: [F.col(n) for n in names]
    null = F.lit(None).cast("string")
    return o.select("*", *[e.alias(n) for n, e in of_order.items()]).select("*", F.explode(items).alias("_item")).select(
        *of("target_id", "target_secret_id", "target_nickname"), F.lit("respondent").alias("target_tag"),
        *of("source_id", "source_secret_id", "source_nickname"), F.lit("reporter").alias("source_tag"),
        *of("source_relation", "input_id", "input_secret_id", "input_nickname", "userId", "secret_user_id"), null.alias("legacy_user_id"),
        *of("applet_version", "activity_flow_id", "activity_flow_name", "activity_flow_submission_id", "activity_id", "activity_name",
            "activity_submission_id", "activity_start_time", "activity_end_time", "activity_schedule_id", "activity_schedule_history_id",
            "activity_schedule_start_time", "utc_timezone_offset"),
        null.alias("activity_submission_review_id"),
        _cat("item-", F.col("_item.name")).alias("item_id"),
        F.col("_item.name").alias("item_name"),
        _cat("How about ", F.col("_item.name"), "?").alias("item_prompt"),
        F.col("_item.options").alias("item_response_options"),
        answer.alias("item_response"),
        F.lit("completed").alias("item_response_status"),
        F.col("_item.type").alias("item_type"),
        F.col("rawScore"),
        F.when(first, F.col("_total")).alias("subscale_name_total"),
        F.when(first, F.col("_score")).alias("activity_score"),
    )


# Activity names given to event types (the first two are the
# daily check-in/check-out activities of the attendance grid).
EVENT_ACTIVITIES = {
    "click": "Student Check-In",
    "view": "Student Check-Out",
    "purchase": "Purchase survey",
    "signup": "Signup survey",
    "error": "Error report",
}
DAILY_PREFIX = "Student Check"


def event_activity(event_type: Column) -> Column:
    expr = None
    for t, n in EVENT_ACTIVITIES.items():
        expr = (F.when(event_type == t, F.lit(n)) if expr is None else expr.when(event_type == t, F.lit(n)))
    return expr


def events_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows (all STRING), one per event."""
    configure(spark)
    e = spread(_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value"), ROWS_A_TASK)
    eid, uid = F.col("event_id"), F.col("user_id")
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    name = event_activity(F.col("event_type"))
    # Some names carry stray whitespace, trimmed by the grid.
    padded = F.when(eid % 10 == 0, F.concat(F.lit(" "), name, F.lit(" "))).otherwise(name)
    has_item = F.col("value") >= 5
    return e.select(
        _cat("user-", uid).alias("target_id"),
        _cat("U", uid).alias("target_secret_id"),
        _cat("User ", uid).alias("target_nickname"),
        F.lit(None).cast("string").alias("target_tag"),
        F.lit(None).cast("string").alias("source_id"),
        F.lit(None).cast("string").alias("source_secret_id"),
        F.lit(None).cast("string").alias("source_nickname"),
        F.lit(None).cast("string").alias("source_tag"),
        F.lit(None).cast("string").alias("source_relation"),
        F.lit(None).cast("string").alias("input_id"),
        F.lit(None).cast("string").alias("input_secret_id"),
        F.lit(None).cast("string").alias("input_nickname"),
        _cat("user-", uid).alias("userId"),
        _cat("U", uid).alias("secret_user_id"),
        F.lit("1.0.0").alias("applet_version"),
        F.lit(None).cast("string").alias("activity_flow_id"),
        F.lit(None).cast("string").alias("activity_flow_name"),
        F.lit(None).cast("string").alias("activity_flow_submission_id"),
        _cat("act-", F.col("event_type")).alias("activity_id"),
        padded.alias("activity_name"),
        _cat("ev-", eid).alias("activity_submission_id"),
        _s(start).alias("activity_start_time"),
        _s(start + 60_000).alias("activity_end_time"),
        F.lit(None).cast("string").alias("activity_schedule_id"),
        F.lit(None).cast("string").alias("activity_schedule_history_id"),
        F.lit("not scheduled").alias("activity_schedule_start_time"),
        F.lit("0").alias("utc_timezone_offset"),
        F.lit(None).cast("string").alias("activity_submission_review_id"),
        F.when(has_item, F.lit("item-amount")).alias("item_id"),
        F.lit("amount").alias("item_name"),
        F.lit("Amount?").alias("item_prompt"),
        F.lit(None).cast("string").alias("item_response_options"),
        _cat("value: ", F.floor(F.col("value"))).alias("item_response"),
        F.lit("completed").alias("item_response_status"),
        F.lit("numberSelect").alias("item_type"),
        F.lit(None).cast("string").alias("rawScore"),
    )


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster in the participants-file layout after selection (secret_id, nickname,
    first_name, last_name, site, room), one per customer."""
    configure(spark)
    cu = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return cu.select(
        _cat("U", F.col("c_custkey")).alias("secret_id"),
        F.col("c_name").alias("nickname"),
        _cat("First", F.col("c_custkey")).alias("first_name"),
        _cat("Last", F.col("c_nationkey")).alias("last_name"),
        F.col("c_mktsegment").alias("site"),
        _cat("R", F.col("c_nationkey")).alias("room"),
    )
