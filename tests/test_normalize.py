"""Normalisation steps and the report contract."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from formspark import schema
from formspark.operators import normalize as N


def test_epoch_ms_times(spark):
    df = spark.createDataFrame([("951782400123", "330"), ("", "-90"), ("soon", None)], "activity_start_time string, utc_timezone_offset string")
    rows = N.parse_times(df).select(F.col("activity_start_time").cast("timestamp_ntz").alias("t"), "utc_timezone_offset").collect()
    assert [r.t for r in rows] == [dt.datetime(2000, 2, 29, 0, 0, 0, 123000), None, None]
    assert [r.utc_timezone_offset for r in rows] == [dt.timedelta(minutes=330), dt.timedelta(minutes=-90), None]


# One submission for each visit; the four score columns become rows of their own.
SCORES = {"activity_score": ("41", None), "activity_score_lookup_text": ("fair", "n/a"), "subscale_sleep": ("8.5", "0"),
          "subscale_text_sleep": ("rested", None)}
VISITS = {"activity_submission_id": ("visit-1", "visit-2"), "item_name": ("hours", "hours"), "item_id": ("h", "h"),
          "item_type": ("slider", "slider"), "item_response": ("value: 7", "value: 3"), "item_prompt": ("How long?",) * 2,
          "item_response_options": ("Min: 0, Max: 12",) * 2, "item_response_status": ("completed", "skipped"), "rawScore": ("7", "3"),
          "site": ("east", "west")}


def test_subscale_unpivot(spark):
    table = VISITS | SCORES
    df = spark.createDataFrame(list(zip(*table.values())), ", ".join(f"{c} string" for c in table))
    out = N.unpivot_subscales(df)
    assert set(out.columns) == set(VISITS)
    new = {(f"visit-{i + 1}", name, v) for name, values in SCORES.items() for i, v in enumerate(values) if v is not None}
    rows = out.select("activity_submission_id", "item_name", "item_response", "item_type", "rawScore", "site").collect()
    assert {tuple(r)[:3] for r in rows if r.item_type == "subscale"} == new
    assert {tuple(r)[:3] for r in rows if r.item_type == "slider"} == {("visit-1", "hours", "value: 7"), ("visit-2", "hours", "value: 3")}
    assert len(rows) == 2 + len(new)
    assert {(r.rawScore, r.site) for r in rows if r.item_type == "subscale"} == {(None, "east"), (None, "west")}


def test_subscale_name_prefix_removed_once(spark):
    df = spark.createDataFrame([("s", "x", "subscale_name_a_subscale_name_b", "rs")],
                               "id string, item_response string, subscale_name_a_subscale_name_b string, rawScore string")
    out = N.unpivot_subscales(df).where(F.col("item_type") == "subscale")
    assert out.first().item_name == "a_subscale_name_b"


def test_no_subscale_is_noop(spark):
    df = spark.createDataFrame([("a",)], "x string")
    assert N.unpivot_subscales(df) is df


def test_users_struct(spark):
    df = spark.createDataFrame([("t1", "ts", "tn", "tt", "u1", "us", "legacy", "x")],
                               "target_id string, target_secret_id string, target_nickname string, target_tag string,"
                               " userId string, secret_user_id string, legacy_user_id string, target_extra string")
    out = N.nest_users(N.drop_legacy_user_id(df))
    assert set(out.columns) == {"target_user", "source_user", "input_user", "account_user"}
    r = out.first()
    assert r.target_user.asDict() == {"id": "t1", "secret_id": "ts", "nickname": "tn", "relation": None, "tag": "tt"}
    assert r.account_user.asDict() == {"id": "u1", "secret_id": "us", "nickname": None, "relation": None, "tag": None}
    assert r.source_user.id is None


def _raw(spark, rows):
    cols = ["userId", "secret_user_id", "activity_id", "activity_name", "activity_submission_id", "item_id",
            "item_name", "item_type", "item_response_options", "item_response", "item_response_status", "rawScore"]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_normalize_contract(spark):
    raw = _raw(spark, [("u", "s", "a", "A", "sub", "i", "q", "singleSelect", " a: 0 (score: 2)\n", "value: 0 ",
                        "completed", "7")])
    rep = N.normalize(raw)
    assert rep.schema["response"].dataType.simpleString() == schema.RESPONSE.simpleString()
    assert rep.schema["item"].dataType.simpleString() == schema.ITEM.simpleString()
    r = rep.first()
    assert r.response.raw_score == 7 and r.response.value.single_value == 0
    assert r.item.response_options[0].asDict() == {"name": "a", "value": 0, "score": 2}


def test_on_error(spark):
    raw = _raw(spark, [("u", "s", "a", "A", "sub", "i", "q", "singleSelect", None, "garbage", "completed", "1.5")])
    lenient = N.normalize(raw).first()
    assert lenient.response.value is None and lenient.response.raw_score is None
    assert lenient.response.raw_response == "garbage"
    with pytest.raises(Exception, match="cannot parse answer|CAST|NUMBER|cast"):
        N.normalize(raw, on_error="fail").collect()
    bad_type = _raw(spark, [("u", "s", "a", "A", "sub", "i", "q", "nope", None, "x", "completed", "1")])
    with pytest.raises(Exception, match="unknown item type"):
        N.normalize(bad_type, on_error="fail").collect()


def test_raw_score_required(spark):
    with pytest.raises(ValueError):
        N.normalize(spark.createDataFrame([("x",)], "item_response string"))


def test_dedupe_subscales(spark):
    cols = ["activity_submission_id", "item_name", "item_type", "item_response", "rawScore", "activity_score"]
    df = spark.createDataFrame([("s1", "a", "text", "x", None, "7"), ("s1", "b", "text", "y", None, "7")],
                               ", ".join(f"{c} string" for c in cols))
    assert N.normalize(df).where(F.col("item.type") == "subscale").count() == 2
    assert N.normalize(df, dedupe_subscales=True).where(F.col("item.type") == "subscale").count() == 1
