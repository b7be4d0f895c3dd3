"""Work that is done once for each text, order or submission, not for each answer row; files read no further than needed."""

import gzip
import random
import re

import pytest
from pyspark.sql import functions as F

from formspark.functions import answers
from formspark.functions.scalars import interval_ms
from formspark.operators import wide as wide_op
from formspark.operators.dictionary import option_dictionary, parsed_texts
from formspark.operators.normalize import normalize
from formspark.session import configure
from formspark.sources import tables
from formspark.sources.exports import headers

COLUMNS = "applet_version, activity_submission_id, utc_timezone_offset, item_name, item_type, item_response_options, item_response, rawScore, subscale_name_q, activity_score"


def _raw(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS.split(", ")))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


ROWS = [("1.0", "s1", "-240", "a", "singleSelect", "x: 0 (score: 4), y: 1 (score: 5)", "value: 1", "3", "2.5", None),
        ("1.0", "s1", "-240", "b", "multiSelect", "x: 0, y: 1", "value: 0", "3", None, "7"),
        ("1.0", "s2", None, "a", "singleSelect", "not a list", "value: 1", None, None, None)]


def test_header_job_stops_after_the_first_record(spark, tmp_path):
    rng = random.Random(1)
    body = "a,b\n" + "".join(f"{rng.random()},{rng.random()}\n" for _ in range(400_000))
    whole = gzip.compress(body.encode(), 1)
    (tmp_path / "cut_responses.csv.gz").write_bytes(whole[:len(whole) * 9 // 10])
    found = headers(spark, [str(tmp_path / "cut_responses.csv.gz")])
    plan = _plan(found)
    assert plan.index("MapInArrow") < plan.index("Aggregate", plan.index("MapInArrow")) < plan.index("LocalLimit 1")
    (group,) = found.collect()
    assert group["header"] == ["a", "b"] and len(group["paths"]) == 1


def test_columns_of_an_order_are_made_before_its_items(spark, tmp_path):
    spark.sql("select 1L o_orderkey, 2L o_custkey, 'F' o_orderstatus, 3.5D o_totalprice, timestamp'2020-01-02 00:00:00' o_orderdate, '1-URGENT' o_orderpriority"
              ).write.parquet(str(tmp_path / "orders.parquet"))
    raw = tables.orders_export(spark, str(tmp_path))
    lines = _plan(raw).splitlines()
    explode = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    assert not any("cust-" in line for line in lines[:explode]) and any("cust-" in line for line in lines[explode:])
    assert raw.count() == 12 and {r[0] for r in raw.select("target_id").collect()} == {"cust-2"}


def test_unread_fields_are_not_unpivoted(spark):
    report = normalize(_raw(spark, ROWS).repartition(2))
    assert not re.search(r"\bitem_response#", _plan(report.select("item.raw_options")).split("Repartition")[0])
    got = report.select("item.name", "item.type", "response.raw_response").collect()
    assert sorted(map(tuple, got)) == [("a", "singleSelect", "value: 1"), ("a", "singleSelect", "value: 1"), ("activity_score", "subscale", "7"),
                                       ("b", "multiSelect", "value: 0"), ("q", "subscale", "2.5")]


def test_options_are_parsed_after_the_distinct(spark):
    report = normalize(_raw(spark, ROWS))
    plan = _plan(parsed_texts(report, F.col("item.raw_options")))
    top, below = plan.split("\n+- ", 1)
    assert plan.startswith("Aggregate [raw") and "score:" in top and "score:" not in below
    assert option_dictionary(report).frame.count() == 2


def test_wide_offset_is_written_after_submissions_are_collected(spark, monkeypatch):
    report = normalize(_raw(spark, ROWS))
    plan = _plan(wide_op.wide(report))
    below = plan[plan.index("RepartitionByExpression"):]
    assert "PT0S" in plan and "PT0S" not in below
    assert plan.count("Aggregate [") == 1
    got = wide_op.wide(report).select("activity_submission_id", "utc_timezone_offset", "a", "a__index", "a__response", "b_0", "b_1", "response_value__q").collect()
    assert sorted(map(str, map(tuple, got))) == [
        "('s1', '-PT4H', 5, 1, 'y', True, False, 2.5)", "('s2', None, None, 1, None, None, None, None)"]
    again = normalize(_raw(spark, ROWS + ROWS[:1]))
    with pytest.raises(Exception, match="duplicate answers"):
        wide_op.wide(again).collect()


def test_answer_forms_without_regular_expressions(spark):
    texts = {"date: 29/2/68 | text: 5": ("2068-02-29", None, None, "5"), "date: 31/4/2020": (None, None, None, None),
             "date: 1/1/99": ("1999-01-01", None, None, None), "time: (hr 5, min 7)": (None, "05:07:00", None, None),
             "time: hr 24 min 7 | text: 1": (None, None, None, "1"),
             "time_range: from hr 23 min 2 / to hr 3 min 4 | text: 9 | 8": (None, None, -71_880_000, "9 | 8")}
    df = configure(spark).createDataFrame([(t,) for t in texts], "s string").select("s", answers.parse_full(F.col("s")).alias("v"))
    got = {r["s"]: tuple(r)[1:] for r in df.select("s", F.col("v.date").cast("string"), "v.time", interval_ms(F.col("v.time_range")), "v.optional_text").collect()}
    assert got == texts
    lists = spark.createDataFrame([("value: 1, x,\t2.5,  7",), ("r_1:  4,\t5\r\n\r\nq: a\n",)], "s string").select(answers.parse_full(F.col("s")).alias("v"))
    (ints, _), (_, matrix) = lists.select("v.value", "v.matrix").collect()
    assert ints == [1, None, None, 7]
    assert [(m["row"], m["value"]) for m in matrix] == [("r_1", ["4", "5"]), ("q", ["a"])]


def test_no_form_is_looked_for_by_pattern_where_its_start_tells(spark):
    plan = _plan(spark.createDataFrame([("x",)], "s string").repartition(1).select(answers.classify_full(F.col("s"))))
    assert plan.count("StartsWith") >= 6
