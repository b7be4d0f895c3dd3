"""Answer and option parsers, one group of invented answers for each form of the grammar."""

import datetime as dt
import time

import pytest
from formspark.functions import answers as A
from formspark.functions import options as O
from pyspark.sql import functions as F


def parsed(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    rows = df.select("i", fn(F.col("s")).alias("v")).orderBy("i").collect()
    return [None if r.v is None else {k: v for k, v in r.v.asDict(recursive=True).items() if v is not None} for r in rows]


def value(*numbers, why=None):
    return {"type": "value", "value": list(numbers)} | ({"optional_text": why} if why else {})


def matrix(**rows):
    return {"type": "matrix", "matrix": [{"row": k, "value": list(v)} for k, v in rows.items()]}


def raw(text):
    return {"type": "raw_value", "raw_value": text}


# form -> {answer: what the untyped grammar makes of it}
FORMS = {
    "plain": {"7": raw("7"), "-3.25": raw("-3.25"), "two words": raw("two words"), "value: no way": raw("value: no way"),
              "geo: lat 12 long 3": raw("geo: lat 12 long 3")},
    "text": {"text: slept badly": {"type": "text", "text": "slept badly"},
             "text: a\n\nb | text: c": {"type": "text", "text": "a\n\nb | text: c"}, "text:tight": matrix(text=["tight"])},
    "null": {"value: null": {"type": "null_value", "null_value": True}, "value: null | text: eh": value(None, why="eh")},
    "value": {"value: 4": value(4), "value: 5, 0,  11": value(5, 0, 11), "value: 3.5": value(None), "value: é, 2": value(None, 2),
              "value: 6 | text: since\nMonday": value(6, why="since\nMonday")},
    "date": {"date: 3/7/2019": {"type": "date", "date": dt.date(2019, 7, 3)}, "date: 09/10/18": {"type": "date", "date": dt.date(2018, 10, 9)},
             "date: 5/6/68": {"type": "date", "date": dt.date(2068, 6, 5)}, "date: 5/6/69": {"type": "date", "date": dt.date(1969, 6, 5)},
             "date: 30/2/2022": {"type": "date"}, "date: 44": matrix(date=["44"]),
             "date: 1/1/2020 | text: new year": {"type": "date", "date": dt.date(2020, 1, 1), "optional_text": "new year"}},
    "time": {"time: hr 7 min 5": {"type": "time", "time": "07:05:00"}, "time: (hr 23, min 59)": {"type": "time", "time": "23:59:00"},
             "time: hr 24 min 0": {"type": "time"}},
    "time range": {"time_range: from hr 21 min 15 / to hr 23 min 0": {"type": "time_range", "time_range": dt.timedelta(minutes=105)},
                   "time_range: from (hr 22, min 0) / to (hr 6, min 30)": {"type": "time_range", "time_range": dt.timedelta(minutes=-930)}},
    "geo": {"geo: lat -33.9 long 18.42": {"type": "geo", "geo": {"latitude": -33.9, "longitude": 18.42}},
            "geo: lat (1e1) / long (+.5)": {"type": "geo", "geo": {"latitude": 10.0, "longitude": 0.5}}},
    "matrix": {"left: 8\nright: 9": matrix(left=["8"], right=["9"]), "am: x, y\r\n\r\npm: z": matrix(am=["x", "y"], pm=["z"])},
    "file": {"clip-07.wav": {"type": "file", "file": "clip-07.wav"}, "media/2020/a b.jpeg": {"type": "file", "file": "media/2020/a b.jpeg"},
             "-x.wav": raw("-x.wav"), "x-.wav": raw("x-.wav"), "a-b\nc.wav": raw("a-b\nc.wav"), "a-b.toolong": raw("a-b.toolong"),
             "plain.wav": raw("plain.wav")},
    "none": {None: None, "": None},
}


@pytest.mark.parametrize("form", FORMS)
def test_untyped_grammar(spark, form):
    got = parsed(spark, A.parse_full, list(FORMS[form]))
    assert dict(zip(FORMS[form], got)) == FORMS[form]


# parser -> {answer: result}
TYPED = {
    A.parse_single_select: {"value: 8": {"single_value": 8}, "value: 0 | text: never": {"single_value": 0, "optional_text": "never"},
                            "value: null": {"null_value": True}, "value: null | text: eh": None, "value: 3, 4": None},
    A.parse_multi_select: {"value: 9": value(9), "value: 2, 6 | text: both": value(2, 6, why="both"), "value: two": None,
                           "value: null": {"type": "null_value", "null_value": True}},
    A.parse_text: {"line\nline": {"type": "text", "text": "line\nline"}, "value: null": {"type": "text", "text": "value: null"}},
    A.parse_subscale: {"-0.5": {"type": "subscale", "subscale": -0.5}, "2E2": {"type": "subscale", "subscale": 200.0}, "inf": None, "7f": None},
    A.parse_date: {"date: 8/9/2010": {"type": "date", "date": dt.date(2010, 9, 8)}, "value: 8": None},
    A.parse_geo: {"geo: lat (0.25) / long (-0.75)": {"type": "geo", "geo": {"latitude": 0.25, "longitude": -0.75}}, "0.25": None},
}


@pytest.mark.parametrize("parser", TYPED, ids=lambda f: f.__name__)
def test_typed_grammars(spark, parser):
    assert dict(zip(TYPED[parser], parsed(spark, parser, list(TYPED[parser])))) == TYPED[parser]


def test_item_type_picks_the_parser(spark):
    want = {"singleSelect": {"single_value": 6}, "slider": value(6), "text": {"type": "text", "text": "value: 6"}, "no such type": None,
            "multiSelect": value(6)}
    df = spark.createDataFrame([(t, "value: 6") for t in want], "t string, s string")
    got = {r.t: r.v for r in df.select("t", A.parse_typed(F.col("t"), F.col("s")).alias("v")).collect()}
    assert {t: v and {k: x for k, x in v.asDict(recursive=True).items() if x is not None} for t, v in got.items()} == want


def test_one_field_of_the_full_parse(spark):
    df = spark.createDataFrame([("date: 8/9/10",)], "s string")
    assert df.select(A.selection("date")(F.col("s")).alias("d")).first().d == dt.date(2010, 9, 8)


# options text -> (name, value, score) of each option
LISTS = {
    "bad: 4 (score: 9)": [("bad", 4, 9)],
    "low: 0 (score: -1), high: 1 (score:+5)": [("low", 0, -1), ("high", 1, 5)],
    "tea: 2, coffee (black), hot: 3": [("tea", 2, None), ("coffee (black), hot", 3, None)],
    "Min: 7, Max: 9": [("7", 7, 7), ("8", 8, 8), ("9", 9, 9)],
    "Max: 1, Min: 0": [("0", 0, 0), ("1", 1, 1)],
    "Min: 2, Max: 1": [],
    "low: 0 (score: 1), high: 1": None,
    "when: 10:30": None,
    "cold: -4": None,
    "just words": None,
    "": None,
}


def test_option_lists(spark):
    df = spark.createDataFrame([(t,) for t in LISTS], "s string")
    got = {r.s: r.o for r in df.select("s", O.parse_options(F.col("s")).alias("o")).collect()}
    assert {t: None if o is None else [(x.name, x.value, x.score) for x in o] for t, o in got.items()} == LISTS


N = 100_000


def test_long_lists_parse(spark):
    number = [str(i) for i in range(N)]
    answers = ["value: " + ", ".join(number), "\n".join(f"r{i}: {i}" for i in range(N))]
    df = spark.createDataFrame([(t,) for t in answers], "s string")
    got = df.select(A.parse_full(F.col("s")).alias("v")).select("v.type", F.size("v.value"), F.size("v.matrix")).collect()
    assert [tuple(r) for r in got] == [("value", N, None), ("matrix", None, N)]
    multi = df.limit(1).select(F.size(A.parse_multi_select(F.col("s")).getField("value"))).first()[0]
    assert multi == N
    lists = [", ".join(f"o{i}: {i} (score: {i})" for i in range(N)), ", ".join(f"o{i}: {i}" for i in range(N)),
             ", ".join(f"o{i}: {i}" for i in range(N)) + ", open"]
    df = spark.createDataFrame([(t,) for t in lists], "s string")
    assert [r[0] for r in df.select(F.size(O.parse_options(F.col("s")))).collect()] == [N, N, None]


def test_file_rule_is_linear(spark):
    df = spark.createDataFrame([("-/" * 500_000 + ".",), ("a-" * 500_000 + "b.wav",), ("." * 1_000_000,)], "s string")
    begin = time.monotonic()
    assert [r[0] for r in df.select(A.is_file(F.col("s"))).collect()] == [False, True, False]
    assert time.monotonic() - begin < 30
