"""Spark schemas of the normalised report (the contract every output depends on)."""

from __future__ import annotations

from pyspark.sql import types as T

# Item-type labels of the questionnaire platform, in the
# platform's own order, plus the synthetic ``subscale`` label produced by the
# subscale unpivot.
ITEM_TYPES: tuple[str, ...] = (
    "ABTrails", "audio", "audioPlayer", "date", "drawing", "flanker",
    "geolocation", "message", "multiSelect", "multiSelectRows", "numberSelect",
    "paragraphText", "photo", "phrasalTemplate", "requestHealthRecordData",
    "singleSelect", "singleSelectRows", "slider", "sliderRows",
    "stabilityTracker", "text", "time", "timeRange", "touchPractice",
    "touchTest", "unity", "video", "subscale",
)

SINGLE_SELECT = "singleSelect"
MULTI_SELECT = "multiSelect"
TEXT = "text"
SUBSCALE = "subscale"
DATE = "date"
GEOLOCATION = "geolocation"

S = T.StringType()
L = T.LongType()
D = T.DoubleType()
B = T.BooleanType()

USER = T.StructType([T.StructField(n, S) for n in ("id", "secret_id", "nickname", "relation", "tag")])
USER_FIELDS = tuple(f.name for f in USER.fields)

OPTION = T.StructType([
    T.StructField("name", S), T.StructField("value", L), T.StructField("score", L),
])
OPTIONS = T.ArrayType(OPTION)

GEO = T.StructType([T.StructField("latitude", D), T.StructField("longitude", D)])
MATRIX_ROW = T.StructType([T.StructField("row", S), T.StructField("value", T.ArrayType(S))])

# ``time`` answers are kept as 'HH:mm:ss' text: Spark's TIME type is gated
# behind spark.sql.timeType.enabled.
RESPONSE_VALUE = T.StructType([
    T.StructField("type", S),
    T.StructField("raw_value", S),
    T.StructField("null_value", B),
    T.StructField("single_value", L),
    T.StructField("value", T.ArrayType(L)),
    T.StructField("text", S),
    T.StructField("file", S),
    T.StructField("date", T.DateType()),
    T.StructField("time", S),
    T.StructField("time_range", T.DayTimeIntervalType(0, 3)),
    T.StructField("geo", GEO),
    T.StructField("matrix", T.ArrayType(MATRIX_ROW)),
    T.StructField("optional_text", S),
    T.StructField("subscale", D),
])
RESPONSE_VALUE_FIELDS = tuple(f.name for f in RESPONSE_VALUE.fields)

RESPONSE = T.StructType([
    T.StructField("status", S),
    T.StructField("raw_score", L),
    T.StructField("raw_response", S),
    T.StructField("value", RESPONSE_VALUE),
])

ITEM = T.StructType([
    T.StructField("id", S), T.StructField("name", S), T.StructField("prompt", S),
    T.StructField("type", S), T.StructField("raw_options", S),
    T.StructField("response_options", OPTIONS),
])

ACTIVITY_FLOW = T.StructType([T.StructField(n, S) for n in ("id", "name", "submission_id")])
ACTIVITY = T.StructType([T.StructField(n, S) for n in ("id", "name")])
ACTIVITY_SUBMISSION = T.StructType([T.StructField(n, S) for n in ("id", "review_id")])
ACTIVITY_TIME = T.StructType([
    T.StructField("start_time", T.TimestampType()), T.StructField("end_time", T.TimestampType()),
])
ACTIVITY_SCHEDULE = T.StructType([
    T.StructField("id", S), T.StructField("history_id", S),
    T.StructField("start_time", T.TimestampType()),
])

USER_ROLES = ("target_user", "source_user", "input_user", "account_user")

# Struct columns that form the submission index of the wide table, in order.
INDEX_STRUCTS = (
    "target_user", "source_user", "input_user", "account_user",
    "activity_flow", "activity", "activity_submission", "activity_time",
    "activity_schedule",
)

# Item and response columns of the raw export consumed by normalisation.
ITEM_COLUMNS = ("item_id", "item_name", "item_prompt", "item_type", "item_response_options")
RESPONSE_COLUMNS = ("item_response_status", "rawScore", "item_response")
