"""Queries over the benchmark tables that exercise each operator end to end.

Each query takes ``(spark, sf_dir)`` and returns a flat DataFrame (no nested
columns; timestamps as TIMESTAMP_NTZ in UTC wall time; intervals as BIGINT
milliseconds), so an independent SQL engine can check it.  The matching SQL
lives in :mod:`formspark.plans.oracles`; it computes the expected values
directly from the source columns, never by parsing the generated text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions import answers, options as opt_parser
from ..functions.scalars import interval_ms, iso_duration, strip_all
from ..operators import grids, joins, reshape, wide as wide_op
from ..operators.normalize import nest_users, normalize, parse_times, unpivot_subscales
from ..operators.structs import column, unnest
from ..session import ROWS_A_TASK, configure, scratch_path, spread
from ..sinks.writers import NamedOutput, csv_encode, drop_null_columns, write_csv, write_parquet
from ..sources import tables
from ..sources.exports import list_export_files, merge_by_name, read_csv_strings, read_export, read_export_frame
from ..sources.participants import read_participants
from . import job, outputs

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flat(df: DataFrame) -> DataFrame:
    """Timestamps -> TIMESTAMP_NTZ (UTC wall clock), intervals -> ``*_ms`` BIGINT."""
    cols: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            cols.append(c.cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, T.DayTimeIntervalType):
            cols.append(interval_ms(c).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def orders_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(tables.orders_export(spark, sf_dir))


def events_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(tables.events_export(spark, sf_dir))


def _sub() -> Column:
    return F.col("activity_submission.id").alias("submission_id")


def _item(report: DataFrame, name: str) -> DataFrame:
    return report.where(F.col("item.name") == name)


# --- answer parsers ----------------------------------------------------------

def parse_single_select(spark, sf_dir):
    r = _item(orders_report(spark, sf_dir), "mood")
    v = "response.value"
    return r.select(_sub(), F.col(f"{v}.single_value").alias("single_value"),
                    F.col(f"{v}.null_value").alias("null_value"),
                    F.col(f"{v}.optional_text").alias("optional_text"),
                    F.col(f"{v}.type").alias("value_type"))


def parse_multi_select(spark, sf_dir):
    r = _item(orders_report(spark, sf_dir), "colors")
    return r.select(_sub(), F.col("response.value.type").alias("value_type"),
                    F.posexplode_outer("response.value.value").alias("value_index", "value"))


def parse_date(spark, sf_dir):
    r = _item(orders_report(spark, sf_dir), "order_day")
    return r.select(_sub(), F.col("response.value.type").alias("value_type"),
                    F.col("response.value.date").alias("answer_date"))


def parse_time_range_ms(spark, sf_dir):
    r = _item(orders_report(spark, sf_dir), "sleep")
    return r.select(_sub(), F.col("response.value.type").alias("value_type"),
                    interval_ms(F.col("response.value.time_range")).alias("duration_ms"))


def parse_geo(spark, sf_dir):
    r = _item(orders_report(spark, sf_dir), "place")
    return r.select(_sub(), F.col("response.value.type").alias("value_type"),
                    F.col("response.value.geo.latitude").alias("latitude"),
                    F.col("response.value.geo.longitude").alias("longitude"))


def parse_matrix_long(spark, sf_dir):
    long = reshape.expand_responses(_item(orders_report(spark, sf_dir), "grid"))
    return long.select(_sub(), "response_value_matrix_row", "response_value_matrix_value",
                       "response_value_matrix_value_index")


def form_answer(k: Column) -> Column:
    """One answer text per order, cycling through the eleven answer forms."""
    s = lambda x: x.cast("string")
    r = k % 11
    return (
        F.when(r == 0, F.lit("value: null"))
        .when(r == 1, F.concat(F.lit("text: note "), s(k)))
        .when(r == 2, F.concat(F.lit("value: "), s(k % 7), F.lit(", "), s(k % 5)))
        .when(r == 3, F.concat(F.lit("date: "), s(k % 28 + 1), F.lit("/"), s(k % 12 + 1), F.lit("/"), s(k % 30 + 1990)))
        .when(r == 4, F.concat(F.lit("time: hr "), s(k % 24), F.lit(" min "), s(k % 60)))
        .when(r == 5, F.concat(F.lit("time_range: from (hr "), s(k % 12), F.lit(", min "), s(k % 60),
                               F.lit(") / to (hr "), s(k % 12 + 6), F.lit(", min 0)")))
        .when(r == 6, F.concat(F.lit("geo: lat ("), s(k % 90), F.lit(".5) / long (-"), s(k % 180), F.lit(".25)")))
        .when(r == 7, F.concat(F.lit("r"), s(k % 3), F.lit(": "), s(k % 9), F.lit("\nq: "), s(k % 4)))
        .when(r == 8, F.concat(F.lit("docs/file-"), s(k), F.lit(".pdf")))
        .when(r == 9, F.concat(F.lit("free answer "), s(k)))
        .otherwise(F.concat(F.lit("value: "), s(k % 3), F.lit(" | text: why "), s(k)))
    )


def parse_form_types(spark, sf_dir):
    configure(spark)
    o = spread(_t(spark, sf_dir, "orders").select("o_orderkey"))
    staged = o.select("o_orderkey", form_answer(F.col("o_orderkey")).alias("_a")).withColumn(
        "_k", answers.classify_full(F.col("_a")))
    v = staged.select("o_orderkey", answers.build_value(F.col("_k"), F.col("_a")).alias("v"))
    arr = F.col("v.value")
    mat = F.col("v.matrix")
    return v.select(
        F.col("o_orderkey").alias("order_key"),
        F.col("v.type").alias("value_type"),
        F.col("v.raw_value").alias("raw_value"),
        F.col("v.null_value").alias("null_value"),
        F.get(arr, 0).alias("first_value"),
        F.when(arr.isNotNull(), F.size(arr)).alias("n_values"),
        F.col("v.text").alias("text"),
        F.col("v.file").alias("file"),
        F.col("v.date").alias("answer_date"),
        F.col("v.time").alias("answer_time"),
        interval_ms(F.col("v.time_range")).alias("time_range_ms"),
        F.col("v.geo.latitude").alias("latitude"),
        F.col("v.geo.longitude").alias("longitude"),
        F.when(mat.isNotNull(), F.size(mat)).alias("matrix_rows"),
        F.col("v.optional_text").alias("optional_text"),
    )


# --- answer options -------------------------------------------------------------

def _explode_options(df: DataFrame, key: str, text: Column) -> DataFrame:
    parsed = df.select(F.col(key), opt_parser.parse_options(strip_all(text)).alias("_opts"))
    return parsed.select(key, F.posexplode_outer("_opts").alias("option_index", "_o")).select(
        key, "option_index", F.col("_o.name").alias("option_name"),
        F.col("_o.value").alias("option_value"), F.col("_o.score").alias("option_score"))


def parse_options_scored(spark, sf_dir):
    cu = _t(spark, sf_dir, "customer")
    c, nk = F.col("c_custkey"), F.col("c_nationkey")
    text = F.concat(F.col("c_mktsegment"), F.lit(": "), nk.cast("string"), F.lit(" (score: "),
                    (c % 7 - 3).cast("string"), F.lit("), "), F.col("c_name"), F.lit(": "),
                    (nk + 30).cast("string"), F.lit(" (score: "), (c % 5).cast("string"), F.lit(")"))
    return _explode_options(cu, "c_custkey", text)


def parse_options_plain(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    text = F.concat(F.col("p_brand"), F.lit(": "), F.col("p_size").cast("string"), F.lit(", "),
                    F.col("p_type"), F.lit(": "), (F.col("p_size") + 100).cast("string"))
    return _explode_options(p, "p_partkey", text)


def parse_options_range(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    lo, hi = k % 5, k % 5 + F.col("s_nationkey") % 4
    text = F.when(k % 2 == 0, F.concat(F.lit("Min: "), lo.cast("string"), F.lit(", Max: "), hi.cast("string"))
                  ).otherwise(F.concat(F.lit("Max: "), hi.cast("string"), F.lit(", Min: "), lo.cast("string")))
    return _explode_options(s, "s_suppkey", text)


# --- normalisation steps ----------------------------------------------------------

def epoch_ms_times(spark, sf_dir):
    configure(spark)
    e = _t(spark, sf_dir, "events").select("event_id", "ts")
    eid = F.col("event_id")
    raw = e.select(
        "event_id",
        F.when(eid % 9 == 0, F.lit("not scheduled")).otherwise(
            F.unix_millis(F.col("ts").cast("timestamp")).cast("string")).alias("activity_start_time"),
        (-(eid % 13) * 30).cast("string").alias("utc_timezone_offset"),
    )
    p = parse_times(raw)
    return p.select("event_id", F.col("activity_start_time").cast("timestamp_ntz").alias("start_time"),
                    iso_duration(F.col("utc_timezone_offset")).alias("offset_iso"),
                    interval_ms(F.col("utc_timezone_offset")).alias("offset_ms"))


def nest_unnest_users(spark, sf_dir):
    cu = _t(spark, sf_dir, "customer")
    c = F.col("c_custkey").cast("string")
    raw = cu.select(
        c.alias("target_id"), F.col("c_name").alias("target_secret_id"),
        F.col("c_mktsegment").alias("target_nickname"), F.col("c_nationkey").cast("string").alias("target_tag"),
        F.concat(F.lit("in"), c).alias("input_id"), F.col("c_name").alias("input_secret_id"),
        F.concat(F.lit("acct"), c).alias("userId"), F.col("c_name").alias("secret_user_id"),
    )
    n = nest_users(raw)
    return n.select(*[col for role in ("target_user", "source_user", "input_user", "account_user")
                      for col in unnest(n, role)])


def users_distinct(spark, sf_dir):
    return outputs.users(orders_report(spark, sf_dir))


def csv_merge_by_name(spark, sf_dir):
    """Two CSV exports with different headers, read back and merged by column name."""
    configure(spark)
    base = scratch_path(spark, "merge")
    cu = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("target_id"), F.col("c_name").alias("target_nickname"),
        F.col("c_mktsegment").alias("activity_name"))
    su = _t(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("target_nickname"), F.col("s_suppkey").cast("string").alias("target_id"),
        F.col("s_nationkey").cast("string").alias("source_id"))
    cu.write.option("header", "true").option("escape", '"').csv(f"{base}/a")
    su.write.option("header", "true").option("escape", '"').csv(f"{base}/b")
    files = list_export_files(spark, f"{base}/a", "*.csv") + list_export_files(spark, f"{base}/b", "*.csv")
    return read_export_frame(spark, files)


def union_by_name(spark, sf_dir):
    cu = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("target_id"), F.col("c_name").alias("target_nickname"),
        F.col("c_mktsegment").alias("activity_name"))
    su = _t(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("target_nickname"), F.col("s_nationkey").cast("string").alias("source_id"),
        F.col("s_suppkey").cast("string").alias("target_id"))
    return merge_by_name([cu, su])


def subscale_unpivot(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    raw = li.select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        F.concat(F.lit("item-"), F.col("l_returnflag")).alias("item_id"),
        F.col("l_returnflag").alias("item_name"), F.lit("text").alias("item_type"),
        F.col("l_linestatus").alias("item_response"), F.lit("completed").alias("item_response_status"),
        F.lit(None).cast("string").alias("item_prompt"), F.lit(None).cast("string").alias("item_response_options"),
        F.lit(None).cast("string").alias("rawScore"),
        F.col("l_quantity").cast("string").alias("subscale_name_quantity"),
        F.col("l_discount").cast("string").alias("subscale_discount"),
        F.col("l_tax").cast("string").alias("activity_score"),
    )
    u = unpivot_subscales(raw)
    return u.select(F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
                    F.col("l_linenumber").cast("int").alias("l_linenumber"),
                    "item_id", "item_name", "item_type", "item_response_status",
                    F.when(F.col("item_type") == "subscale", F.col("item_response").cast("double")).alias("subscale_value"),
                    F.when(F.col("item_type") != "subscale", F.col("item_response")).alias("text_value"))


# --- long reshapes and distinct outputs -------------------------------------------------

def expand_options(spark, sf_dir):
    r = reshape.expand_options(orders_report(spark, sf_dir))
    return r.select(_sub(), F.col("item.name").alias("item_name"),
                    F.col("item_response_options.name").alias("option_name"),
                    F.col("item_response_options.value").alias("option_value"),
                    F.col("item_response_options.score").alias("option_score"))


LONG_COLUMNS = [
    "response_value_type", "response_value_null_value", "response_value_single_value", "response_value_value",
    "response_value_value_index", "response_value_text", "response_value_file", "response_value_date",
    "response_value_time", "response_value_time_range", "response_value_geo_latitude",
    "response_value_geo_longitude", "response_value_matrix_row", "response_value_matrix_value",
    "response_value_matrix_value_index", "response_value_optional_text", "response_value_subscale",
]


def _whole(report: DataFrame, *more: str) -> DataFrame:
    """Every column of a report-like frame: its structs unnested, the options as JSON, then ``more``."""
    item = [c for c in unnest(report, "item") if "response_options" not in str(c)]
    rest = [column(c) for c in report.columns if c not in (*schema.INDEX_STRUCTS, "item", "response", "response_value", *more)
            and not c.startswith("response_")]
    index = [c for s in schema.INDEX_STRUCTS for c in unnest(report, s)]
    return flat(report.select(*rest, *index, *item, F.to_json("item.response_options").alias("item_options_json"),
                              F.col("response.status").alias("response_status"), F.col("response.raw_score").alias("response_raw_score"),
                              F.col("response.raw_response").alias("response_raw_response"), *more))


def long_responses(spark, sf_dir):
    """The whole long table."""
    return _whole(outputs.long_data(orders_report(spark, sf_dir)), *LONG_COLUMNS)


def customers_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows from customer: submission = customer, three items with options and one without."""
    configure(spark)
    cu = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    k, s = F.col("c_custkey"), lambda c: c.cast("string")
    item = lambda name, typ, options, answer: F.struct(
        F.lit(name).alias("name"), F.lit(typ).alias("type"), F.lit(options).cast("string").alias("options"), answer.alias("answer"))
    items = F.array(
        item("service", "singleSelect", "poor: 0 (score: -1), fair: 1 (score: 0), good: 2 (score: 4)", F.concat(F.lit("value: "), s(k % 3))),
        item("channels", "multiSelect", "web: 0, shop: 1", F.when(k % 4 == 0, F.lit("value: null")).otherwise(F.lit("value: 0, 1"))),
        item("pain", "slider", "Min: 1, Max: 4", F.concat(F.lit("value: "), s(k % 4 + 1))),
        item("segment", "text", None, F.col("c_mktsegment")))
    return cu.select("*", F.explode(items).alias("_i")).select(
        F.concat(F.lit("cust-"), s(k)).alias("activity_submission_id"), s(F.col("c_nationkey")).alias("target_id"),
        F.col("_i.name").alias("item_name"), F.col("_i.type").alias("item_type"), F.col("_i.options").alias("item_response_options"),
        F.col("_i.answer").alias("item_response"), F.lit("completed").alias("item_response_status"), s(k % 40).alias("rawScore"))


def long_report(spark, sf_dir):
    """Answer values times the options of their items."""
    full = reshape.long_report(normalize(customers_export(spark, sf_dir)))
    option = [F.col(f"item_response_options.{f}").alias(f"item_option_{f}") for f in ("name", "value", "score")]
    return flat(full.select(_sub(), F.col("target_user.id").alias("target_user_id"), F.col("item.name").alias("item_name"),
                            F.col("item.type").alias("item_type"), F.col("item.raw_options").alias("item_raw_options"),
                            F.to_json("item.response_options").alias("item_options_json"), "response_status", "response_raw_score",
                            "response_raw_response", *LONG_COLUMNS, *option))


def data_dictionary(spark, sf_dir):
    d = outputs.data_dictionary(orders_report(spark, sf_dir))
    return d.withColumn("item_options_json", F.to_json("item_response_options")).drop("item_response_options")


def data_dictionary_full(spark, sf_dir):
    d = outputs.data_dictionary_full(orders_report(spark, sf_dir))
    return d.select(*[c for c in d.columns if c != "item_response_options"],
                    F.to_json(F.col("item_response_options")).alias("item_options_json"))


def options(spark, sf_dir):
    return outputs.options(orders_report(spark, sf_dir))


def item_response_options(spark, sf_dir):
    t = reshape.item_response_options(orders_report(spark, sf_dir))
    item = [c for c in unnest(t, "item") if "response_options" not in str(c)]
    return t.select("applet_version", *unnest(t, "activity_flow"), *unnest(t, "activity"), *item,
                    F.to_json("item.response_options").alias("item_options_json"),
                    "item_option_name", "item_option_value", "item_option_score")


def scored_responses(spark, sf_dir):
    s = outputs.scored_responses(orders_report(spark, sf_dir))
    return s.select(_sub(), F.col("item.name").alias("item_name"),
                    F.coalesce("response_value_single_value", "response_value_value").alias("answer_value"),
                    "item_option_name", "item_option_value", "item_option_score")


def score_join_m1(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return joins.left_join_m1(o, c, ["o_custkey"])


def _line_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows from lineitem: one numeric answer for each line."""
    configure(spark)
    li = _t(spark, sf_dir, "lineitem")
    s = lambda c: F.col(c).cast("string")
    return li.select(
        F.concat(s("l_orderkey"), F.lit("/"), s("l_linenumber")).alias("activity_submission_id"),
        F.lit("line").alias("item_name"), F.lit("slider").alias("item_type"), F.col("l_linestatus").alias("item_response_status"),
        F.concat(F.lit("value: "), s("l_linenumber"), F.lit(", "), F.col("l_suppkey").cast("string"), F.lit(" | text: "),
                 F.col("l_returnflag")).alias("item_response"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit("none")).otherwise(F.col("l_partkey").cast("string")).alias("rawScore"))


def _response_fields(report: DataFrame) -> DataFrame:
    r = "response"
    return report.select(_sub(), F.col(f"{r}.status").alias("status"), F.col(f"{r}.raw_score").alias("raw_score"),
                         F.col(f"{r}.raw_response").alias("raw_response"), F.col(f"{r}.value.type").alias("value_type"),
                         F.get(F.col(f"{r}.value.value"), 0).alias("first_value"), F.get(F.col(f"{r}.value.value"), 1).alias("second_value"),
                         F.col(f"{r}.value.optional_text").alias("optional_text"))


def response_fields(spark, sf_dir):
    """Every field of the response struct, parsed by item type."""
    return _response_fields(normalize(_line_answers(spark, sf_dir)))


def response_untyped(spark, sf_dir):
    """The same answers through the untyped grammar, whatever the item type says."""
    return _response_fields(normalize(_line_answers(spark, sf_dir).withColumn("item_type", F.lit("text")), typed=False))


#: A list of ``parse_long_lists`` has about half as many options as this, and hardly ever more.
LIST_OPTIONS = 1 << 16


def _option_lists(lines: DataFrame, most: int = LIST_OPTIONS) -> DataFrame:
    """(l_suppkey, text): the lines of a supplier as one option list, or as several where they are more than ``most``.

    The suppliers with several lists are broadcast, at most one for every ``most`` lines.
    """
    one = F.concat(F.lit("line "), F.col("l_orderkey").cast("string"), F.lit(" no "), F.col("l_linenumber").cast("string"), F.lit(": "),
                   F.col("l_orderkey").cast("string"), F.lit(" (score: "), F.col("l_linenumber").cast("string"), F.lit(")"))
    many = (lines.groupBy(F.col("l_suppkey").alias("_many")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
            .select("_many", F.ceil(F.col("_n") * 2 / most).alias("_lists")))
    part = F.coalesce(F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.col("_lists")), F.lit(0).cast("bigint"))
    dealt = lines.join(F.broadcast(many), F.col("l_suppkey").eqNullSafe(F.col("_many")), "left")
    return (dealt.select("l_suppkey", part.alias("_part"), one.alias("_one")).groupBy("l_suppkey", "_part")
            .agg(F.array_join(F.collect_list("_one"), ", ").alias("text")).select("l_suppkey", "text"))


def parse_long_lists(spark, sf_dir):
    """Option lists as long as a supplier has lines, up to ``LIST_OPTIONS``, from one text for each; sums for each supplier."""
    configure(spark)
    opts = _option_lists(_t(spark, sf_dir, "lineitem")).select("l_suppkey", opt_parser.parse_options(F.col("text")).alias("o"))
    total = lambda f: F.aggregate("o", F.lit(0).cast("bigint"), lambda t, x: t + x[f])
    each = opts.select("l_suppkey", F.size("o").cast("bigint").alias("n"), total("value").alias("value"), total("score").alias("score"))
    return each.groupBy("l_suppkey").agg(F.sum("n").alias("n_options"), F.sum("value").alias("sum_value"), F.sum("score").alias("sum_score"))


# --- wide ------------------------------------------------------------------------------

def _wide_of(report: DataFrame, **kw) -> DataFrame:
    return flat(wide_op.wide(report, **kw))


def wide_all(spark, sf_dir):
    return _wide_of(orders_report(spark, sf_dir))


def wide_single_select(spark, sf_dir):
    r = orders_report(spark, sf_dir)
    return _wide_of(r.where(F.col("item.type") == "singleSelect"))


def wide_single_select_unscored(spark, sf_dir):
    r = orders_report(spark, sf_dir)
    return _wide_of(r.where(F.col("item.name") == "energy"))


def wide_mixed_scores(spark, sf_dir):
    """An item whose newer version has scores: its column holds labels while no chosen option has a score."""
    configure(spark)
    o = spread(_t(spark, sf_dir, "orders").select("o_orderkey"), ROWS_A_TASK)
    k = F.col("o_orderkey")
    newer = k % 3 == 0
    raw = o.select(
        F.concat(F.lit("sub-"), k.cast("string")).alias("activity_submission_id"), F.lit("rating").alias("item_name"),
        F.lit("singleSelect").alias("item_type"), F.lit(None).cast("string").alias("rawScore"),
        F.when(newer, F.lit("Low: 0 (score: 5), High: 1 (score: 6)")).otherwise(F.lit("Low: 0, High: 1")).alias("item_response_options"),
        F.when(newer, F.lit("value: null")).otherwise(F.concat(F.lit("value: "), (k % 2).cast("string"))).alias("item_response"))
    return _wide_of(normalize(raw)).select("activity_submission_id", "rating", "rating__index", "rating__response")


def wide_multi_select(spark, sf_dir):
    r = orders_report(spark, sf_dir)
    return _wide_of(r.where(F.col("item.type") == "multiSelect"))


def wide_subscale(spark, sf_dir):
    r = orders_report(spark, sf_dir)
    return _wide_of(r.where(F.col("item.type") == "subscale"))


def lines_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows from lineitem: submission = order, two items answered once for each line, subscale
    cells that repeat on every line of an order."""
    configure(spark)
    li = spread(_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"), 4 * ROWS_A_TASK)
    s = lambda c: F.col(c).cast("string")
    items = F.array(
        F.struct(F.lit("carrier").alias("name"), F.lit("singleSelect").alias("type"),
                 F.lit("air: 0 (score: 9), rail: 1 (score: 5), sea: 2 (score: 7)").alias("options"),
                 F.concat(F.lit("value: "), ((F.col("l_partkey") + F.col("l_linenumber")) % 3).cast("string")).alias("answer")),
        F.struct(F.lit("remark").alias("name"), F.lit("text").alias("type"), F.lit(None).cast("string").alias("options"),
                 F.concat(F.col("l_returnflag"), F.lit("/"), F.col("l_linestatus"), F.lit("/"), s("l_linenumber")).alias("answer")))
    return li.select("*", F.explode(items).alias("_i")).select(
        s("l_orderkey").alias("activity_submission_id"), F.col("_i.name").alias("item_name"), F.col("_i.type").alias("item_type"),
        F.col("_i.options").alias("item_response_options"), F.col("_i.answer").alias("item_response"),
        F.lit("completed").alias("item_response_status"), F.lit(None).cast("string").alias("rawScore"),
        (F.col("l_orderkey") % 10).cast("string").alias("subscale_name_order"),
        F.when(F.col("l_linenumber") % 2 == 0, s("l_linenumber")).alias("activity_score"))


def wide_first(spark, sf_dir):
    """Items answered once for each line of an order: the first answer in the order of the answer fields stays."""
    raw = lines_export(spark, sf_dir).drop("subscale_name_order", "activity_score")
    w = wide_op.wide(normalize(raw), on_duplicate="first")
    return w.select(F.col("activity_submission_id").cast("bigint").alias("order_key"), "carrier", "carrier__index", "carrier__response",
                    "response_value__remark", "response_response__remark")


def subscales_deduped(spark, sf_dir):
    """Answer rows as they are, each subscale value of a submission once."""
    r = normalize(lines_export(spark, sf_dir), dedupe_subscales=True)
    return r.select(F.col("activity_submission.id").cast("bigint").alias("order_key"), F.col("item.name").alias("item_name"),
                    F.col("item.type").alias("item_type"), F.col("response.value.text").alias("text"),
                    F.col("response.value.single_value").alias("single_value"), F.col("response.value.subscale").alias("subscale"))


def conversations_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows from conversations: submission = conversation, item = turn (text)."""
    configure(spark)
    cv = _t(spark, sf_dir, "conversations")
    cid = F.col("conv_id").cast("string")
    return cv.select(
        F.concat(F.lit("conv-"), cid).alias("activity_submission_id"),
        F.lit("chat").alias("activity_id"), F.lit("Conversation").alias("activity_name"),
        F.concat(F.lit("speaker-"), cid).alias("target_id"),
        F.concat(F.lit("turn-"), F.col("turn").cast("string")).alias("item_id"),
        F.concat(F.lit("turn_"), F.col("turn").cast("string")).alias("item_name"),
        F.col("role").alias("item_prompt"), F.lit("text").alias("item_type"),
        F.col("text").alias("item_response"), F.lit("completed").alias("item_response_status"),
        F.lit(None).cast("string").alias("rawScore"),
    )


def wide_text(spark, sf_dir):
    return _wide_of(normalize(conversations_export(spark, sf_dir)))


def split_wide(spark, sf_dir):
    parts = wide_op.split_wide(orders_report(spark, sf_dir))
    frames = [flat(df).withColumn("output_name", F.lit(name)) for name, df in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def align_full_outer(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    key = F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind")
    day = F.to_date(F.col("ts")).alias("day")
    a = e.groupBy(key, day).agg(F.count(F.lit(1)).alias("n_events"))
    b = (e.where(F.col("value") > 50).groupBy(key, day)
         .agg(F.max("event_id").alias("max_big_event")))
    return joins.align([a, b], ["kind", "day"])


# --- grids ------------------------------------------------------------------------------

def attendance_grid(spark, sf_dir):
    return grids.attendance(events_report(spark, sf_dir), tables.participants(spark, sf_dir))


def completion_grid(spark, sf_dir):
    return grids.completion(events_report(spark, sf_dir), tables.participants(spark, sf_dir))


def renamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events report under activity names that are hard to tell apart or equal to the grids' own columns."""
    name = F.trim(F.col("activity.name"))
    new = (F.when(name == "Student Check-In", "Student Check A").when(name == "Student Check-Out", "Student Check a")
           .when(name == "Purchase survey", "site").when(name == "Signup survey", "SITE").otherwise("complete"))
    return events_report(spark, sf_dir).withColumn("activity", F.col("activity").withField("name", new))


def attendance_names(spark, sf_dir):
    return grids.attendance(renamed_events(spark, sf_dir), tables.participants(spark, sf_dir))


def completion_names(spark, sf_dir):
    return grids.completion(renamed_events(spark, sf_dir), tables.participants(spark, sf_dir))


def completion_summary(spark, sf_dir):
    return grids.completion_summary(completion_grid(spark, sf_dir))


# --- sinks ------------------------------------------------------------------------------

def drop_null_columns_q(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("o_comment", F.lit(None).cast("string"))
    return drop_null_columns(o)


def csv_encode_q(spark, sf_dir):
    r = orders_report(spark, sf_dir)
    enc = csv_encode(r.select(_sub(), F.col("item.name").alias("item_name"), F.col("activity").alias("activity"),
                              F.col("item.response_options").alias("response_options"),
                              "utc_timezone_offset",
                              F.col("response.value.time_range").alias("time_range")))
    return enc


def csv_roundtrip(spark, sf_dir):
    configure(spark)
    cv = _t(spark, sf_dir, "conversations")
    base = scratch_path(spark, "csv")
    write_csv(NamedOutput("conversations", cv), base)
    back = read_csv_strings(spark, [f"{base}/conversations.csv"], cv.columns)
    return back.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                       "role", "text")


def parquet_roundtrip(spark, sf_dir):
    configure(spark)
    w = wide_op.wide(normalize(conversations_export(spark, sf_dir)))
    base = scratch_path(spark, "parquet")
    path = write_parquet(NamedOutput("wide data", w), base)
    return flat(spark.read.parquet(path))


#: Rows of an export file; a file whose records may hold line breaks is read by one task.
ROWS_A_FILE = 500_000


def _export_files(spark: SparkSession, frame: DataFrame, name: str) -> str:
    """``frame`` as an export folder: gzip-compressed CSV files named as response exports."""
    base = scratch_path(spark, "export")
    write_csv(NamedOutput(name, frame), f"{base}/parts", compression="gzip", rows_a_file=ROWS_A_FILE, effort="BEST_SPEED")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/parts/{name}.csv")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for i, st in enumerate(f for f in fs.listStatus(path) if f.getPath().getName().startswith("part-")):
        fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(f"{base}/{name}_responses {i}.csv.gz"))
    return base


def export_report(spark, sf_dir):
    """The orders report written as CSV export files, read back and normalised."""
    configure(spark)
    folder = _export_files(spark, tables.orders_export(spark, sf_dir), "orders")
    r = read_export(spark, folder)
    return flat(r.select(_sub(), "applet_version", F.col("item.name").alias("item_name"), F.col("item.type").alias("item_type"),
                         F.col("item.raw_options").alias("raw_options"), F.col("activity_time.start_time").alias("start_time"),
                         F.col("response.value.text").alias("text"), F.col("response.value.single_value").alias("single_value"),
                         F.col("response.value.date").alias("answer_date"), F.col("response.value.subscale").alias("subscale")))


def job_outputs(spark, sf_dir):
    """The batch job over CSV export files of events: rows of everything that it wrote, read back by name."""
    configure(spark)
    folder = _export_files(spark, tables.events_export(spark, sf_dir), "events")
    roster = write_csv(NamedOutput("roster", tables.participants(spark, sf_dir).withColumnRenamed("secret_id", "secretUserId")),
                       scratch_path(spark, "roster"))
    written = job.run(spark, folder, scratch_path(spark, "job"), outputs=["report", "wide", "long", "dictionary", "options", "scored", "attendance"],
                      fmt="parquet", extra={"split_activities": "true", "participants": roster})
    counts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(p.rsplit("/", 1)[1]).alias("output"), "n_rows")
              for p in written]
    return reduce(DataFrame.unionAll, counts)


def partitioned_roundtrip(spark, sf_dir):
    """Orders written to a folder for each status and read back, with the key in the files and in the folder."""
    configure(spark)
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    path = write_parquet(NamedOutput("orders by status", o, ["o_orderstatus"]), scratch_path(spark, "parts"))
    return spark.read.parquet(path)


def roster_from_csv(spark, sf_dir):
    """The participants file: customers written as a roster with more columns than are read."""
    configure(spark)
    cu = _t(spark, sf_dir, "customer")
    path = write_csv(NamedOutput("roster", cu.select(
        F.col("c_mktsegment").alias("site"), F.col("c_name").alias("secretUserId"), F.col("c_custkey").cast("string").alias("nickname"),
        F.lit("x").alias("unread"), F.col("c_nationkey").cast("string").alias("room"))), scratch_path(spark, "roster"))
    return read_participants(spark, path)


QUERIES: dict[str, Query] = {
    "parse_single_select": parse_single_select,
    "parse_multi_select": parse_multi_select,
    "parse_date": parse_date,
    "parse_time_range_ms": parse_time_range_ms,
    "parse_geo": parse_geo,
    "parse_matrix_long": parse_matrix_long,
    "parse_form_types": parse_form_types,
    "parse_options_scored": parse_options_scored,
    "parse_options_plain": parse_options_plain,
    "parse_options_range": parse_options_range,
    "epoch_ms_times": epoch_ms_times,
    "nest_unnest_users": nest_unnest_users,
    "users_distinct": users_distinct,
    "csv_merge_by_name": csv_merge_by_name,
    "union_by_name": union_by_name,
    "subscale_unpivot": subscale_unpivot,
    "expand_options": expand_options,
    "long_responses": long_responses,
    "data_dictionary": data_dictionary,
    "data_dictionary_full": data_dictionary_full,
    "options": options,
    "item_response_options": item_response_options,
    "scored_responses": scored_responses,
    "score_join_m1": score_join_m1,
    "response_fields": response_fields,
    "response_untyped": response_untyped,
    "parse_long_lists": parse_long_lists,
    "wide_mixed_scores": wide_mixed_scores,
    "partitioned_roundtrip": partitioned_roundtrip,
    "long_report": long_report,
    "wide_first": wide_first,
    "subscales_deduped": subscales_deduped,
    "attendance_names": attendance_names,
    "completion_names": completion_names,
    "export_report": export_report,
    "job_outputs": job_outputs,
    "roster_from_csv": roster_from_csv,
    "wide_all": wide_all,
    "wide_single_select": wide_single_select,
    "wide_single_select_unscored": wide_single_select_unscored,
    "wide_multi_select": wide_multi_select,
    "wide_subscale": wide_subscale,
    "wide_text": wide_text,
    "split_wide": split_wide,
    "align_full_outer": align_full_outer,
    "attendance_grid": attendance_grid,
    "completion_grid": completion_grid,
    "completion_summary": completion_summary,
    "drop_null_columns": drop_null_columns_q,
    "csv_encode": csv_encode_q,
    "csv_roundtrip": csv_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
}
