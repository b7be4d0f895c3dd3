"""Output tables: wide rules, dictionary/options/scored, grids, job runner."""

import pytest
from pyspark.sql import functions as F

from conftest import OPTS, _row, write_export
from formspark.operators import grids, wide as W
from formspark.plans import job, outputs, table_queries
from formspark.sources.exports import read_export
from formspark.sources.participants import RosterColumnError, select_roster


def test_wide_rules(spark, export_dir):
    rep = read_export(spark, str(export_dir))
    w = W.wide(rep)
    rows = {r.activity_submission_id: r for r in w.collect()}
    assert len(rows) == 3
    r1, r2 = rows["sub-1"], rows["sub-2"]
    assert (r1.sleep_q, r1.sleep_q__index, r1.sleep_q__response) == (3, 2, "Often")
    assert (r2.sleep_q, r2.sleep_q__index, r2.sleep_q__response) == (None, None, None)
    assert (r1.foods_0, r1.foods_1, r2.foods_0, r2.foods_1) == (True, True, False, True)
    assert rows["sub-3"].foods_0 is None
    assert r1.response_value__feel == 'Tired but\nfine, "really"' == r1.response_response__feel
    assert rows["sub-3"].response_value__mood == 2.5
    assert r1.utc_timezone_offset == "-PT4H"
    assert w.columns[0] == "applet_version" and "target_user_secret_id" in w.columns[:10]
    assert not any(c in w.columns for c in ("item", "response", "target_user"))


def test_wide_label_when_unscored(spark, tmp_path):
    rows = [_row("s1", 1, 1, "i", "q", "singleSelect", "Low: 0, High: 1", "value: 1"),
            _row("s2", 2, 1, "i", "q", "singleSelect", "Low: 0, High: 1", "value: 7")]
    write_export(tmp_path / "x_responses.csv", rows)
    w = W.wide(read_export(spark, str(tmp_path)))
    got = {r.activity_submission_id: (r.q, r.q__index, r.q__response) for r in w.collect()}
    assert got == {"s1": ("High", 1, "High"), "s2": (None, 7, None)}


def test_wide_duplicates(spark, tmp_path):
    rows = [_row("s1", 1, 1, "i", "q", "singleSelect", OPTS, "value: 1"),
            _row("s1", 1, 1, "i", "q", "singleSelect", OPTS, "value: 2")]
    write_export(tmp_path / "x_responses.csv", rows)
    rep = read_export(spark, str(tmp_path))
    with pytest.raises(Exception, match="duplicate answers"):
        W.wide(rep).collect()
    assert W.wide(rep, on_duplicate="first").count() == 1


def test_wide_clean_names_and_split(spark, export_dir):
    rep = read_export(spark, str(export_dir))
    assert "feel" in W.wide(rep, clean_names=True).columns
    parts = W.split_wide(rep)
    assert [n for n, _ in parts] == ["Morning-act-1"]
    assert parts[0][1].count() == 3


def test_dictionary_options_scored(spark, export_dir):
    rep = read_export(spark, str(export_dir))
    assert outputs.data_dictionary(rep).count() == 4
    opts = outputs.options(rep)
    assert opts.count() == 3 + 1 + 2 + 1
    assert opts.where(F.col("item_name") == "sleep_q").select(F.sum("item_option_score")).first()[0] == 6
    sc = outputs.scored_responses(rep)
    got = sorted((r.activity_submission.id, r.item.name, r.item_option_name) for r in sc.collect()
                 if r.item_option_name is not None)
    assert got == [("sub-1", "foods", "apple"), ("sub-1", "foods", "pear"), ("sub-1", "sleep_q", "Often"),
                   ("sub-2", "foods", "pear"), ("sub-3", "sleep_q", "Never")]
    assert outputs.data_dictionary_full(rep).count() == 4


def test_grids(spark):
    rows = []
    acts = [("st1", "Student Check-In", "1749138592012", "i1"), ("st1", "Student Check-Out", "1749138592012", None),
            ("st2", " Survey A ", "1749238592012", "i1"), ("st1", "Survey A", "1749138592012", "i1"),
            ("zz", "Student Check-In", "1749338592012", "i1")]
    cols = ["target_secret_id", "activity_name", "activity_start_time", "item_id", "item_response", "rawScore",
            "item_type", "activity_submission_id"]
    for sid, name, ts, item in acts:
        rows.append((sid, name, ts, item, "value: 1", None, "slider", f"{sid}-{name}"))
    rep = __import__("formspark.operators.normalize", fromlist=["normalize"]).normalize(
        spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)))
    roster = select_roster(spark.createDataFrame(
        [("st1", "a", "A", "Aa", "north", "1"), ("st2", "b", "B", "Bb", "south", "2"), ("st3", "c", "C", "Cc", "north", "3")],
        "secretUserId string, nickname string, firstName string, lastName string, site string, room string"))
    att = grids.attendance(rep, roster)
    assert att.count() == 3 * 2
    a = {(r.secret_id, str(r.activity_date)): (r["Student Check-In"], r["Student Check-Out"]) for r in att.collect()}
    assert a[("st1", "2025-06-05")] == (True, False)
    assert a[("st3", "2025-06-07")] == (False, False)
    comp = {r.secret_id: (r["Survey A"], r.complete) for r in grids.completion(rep, roster).collect()}
    assert comp == {"st1": (True, True), "st2": (True, True), "st3": (False, False)}
    with pytest.raises(RosterColumnError):
        select_roster(spark.createDataFrame([("x",)], "nickname string"))


def test_job_run(spark, export_dir, tmp_path):
    out = tmp_path / "out"
    paths = job.run(spark, str(export_dir), str(out), fmt="csv", drop_null_columns=True)
    assert len(paths) == 4
    wide = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(
        str(out / "wide_data.csv"))
    assert wide.count() == 3 and "activity_flow_id" not in wide.columns
    pq = job.run(spark, str(export_dir), str(tmp_path / "pq"), outputs=["long", "scored"], fmt="parquet")
    assert spark.read.parquet(pq[0]).count() == 8
    with pytest.raises(ValueError, match="no output"):
        job.run(spark, str(export_dir), str(tmp_path / "x"), outputs=["nope"])
    assert set(outputs.default_outputs()) == {"wide", "long", "dictionary", "options"}


def _file_scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_users_reads_its_input_once(spark, export_dir, tmp_path):
    path = str(tmp_path / "report")
    read_export(spark, str(export_dir)).write.parquet(path)
    u = outputs.users(spark.read.parquet(path))
    assert _file_scans(u) == 1
    assert {(r.user_type, r.id) for r in u.collect()} >= {("target_user", "t-3"), ("source_user", "s-2"), ("account_user", "acct-1")}


def test_checkpoint_folder_must_be_named_on_a_cluster(spark):
    from types import SimpleNamespace

    from formspark.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda *a: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master="yarn")))


def test_grid_timezone(spark):
    from formspark.operators.normalize import normalize

    raw = spark.createDataFrame([("p1", "Student Check-In", "1749175200000", "i")],  # 2025-06-06 02:00 UTC
                                "target_secret_id string, activity_name string, activity_start_time string,"
                                " item_id string")
    rep = normalize(raw.withColumn("rawScore", F.lit(None).cast("string")))
    utc = grids.activity_facts(rep).first().activity_date
    ny = grids.activity_facts(rep, "America/New_York").first().activity_date
    assert (str(utc), str(ny)) == ("2025-06-06", "2025-06-05")


def _wide(spark, tmp_path, rows, **kw):
    write_export(tmp_path / "x_responses.csv", rows)
    return W.wide(read_export(spark, str(tmp_path)), **kw)


def test_label_unless_a_chosen_option_has_a_score(spark, tmp_path):
    w = _wide(spark, tmp_path, [
        _row("s1", 1, 1, "i", "q", "singleSelect", "Low: 0, High: 1", "value: 1"),
        _row("s2", 2, 1, "i", "q", "singleSelect", "Low: 0 (score: 5), High: 1 (score: 6)", "value: null")])
    assert {r.activity_submission_id: r.q for r in w.collect()} == {"s1": "High", "s2": None}


@pytest.mark.parametrize("use", [lambda w: w.select("q"), lambda w: w.groupBy().count(), lambda w: w.select("activity_id")])
def test_no_projection_removes_the_duplicate_check(spark, tmp_path, use):
    rows = [_row("s1", 1, 1, "i", "q", "singleSelect", OPTS, "value: 2"), _row("s1", 1, 1, "i", "q", "singleSelect", OPTS, "value: 1")]
    with pytest.raises(Exception, match="duplicate answers"):
        use(_wide(spark, tmp_path, rows)).collect()


def test_first_duplicate_does_not_depend_on_the_order_of_rows(spark, tmp_path):
    rows = [_row("s1", 1, 1, "i", "q", "singleSelect", OPTS, f"value: {v}") for v in (2, 0, 1)]
    got = [_wide(spark, tmp_path, r, on_duplicate="first").first().q__index for r in (rows, rows[::-1])]
    assert got == [0, 0]


def test_names_that_differ_in_case_or_hold_a_backtick(spark, tmp_path):
    rows = [_row("s1", 1, 1, str(i), n, "text", "", f"answer {i}") for i, n in enumerate(["Mood", "mood", "a`b", "c.d"])]
    w = _wide(spark, tmp_path, rows, clean_names=True)
    r = w.first()
    assert (r["Mood"], r["mood__2"], r["a`b"], r["c.d"]) == ("answer 0", "answer 1", "answer 2", "answer 3")
    assert w.select("`a``b`").first()[0] == "answer 2"
    (_, part), = W.split_wide(read_export(spark, str(tmp_path)), clean_names=True)
    assert part.columns == w.columns and part.count() == 1


def test_long_slider_range_costs_nothing(spark, tmp_path):
    w = _wide(spark, tmp_path, [_row("s1", 1, 1, "i", "pain", "slider", "Min: 0, Max: 100000000", "value: 7")], all_types=True)
    assert w.select("pain__value").first()[0] == [7]


def test_wide_all_types(spark, tmp_path):
    rows = [_row("s1", 1, 1, "d", "day", "date", "", "date: 3/4/2021"),
            _row("s1", 1, 1, "g", "spot", "geolocation", "", "geo: lat 1.5 long -2.25 | text: home"),
            _row("s1", 1, 1, "n", "note", "text", "", "hello"),
            _row("s2", 2, 1, "d", "day", "date", "", "date: 5/6/2022")]
    write_export(tmp_path / "x_responses.csv", rows)
    rep = read_export(spark, str(tmp_path))
    plain = W.wide(rep)
    assert "day__date" not in plain.columns
    w = {r.activity_submission_id: r for r in W.wide(rep, all_types=True).collect()}
    assert str(w["s1"].day__date) == "2021-04-03" and str(w["s2"].day__date) == "2022-06-05"
    assert (w["s1"].spot__latitude, w["s1"].spot__longitude, w["s1"].spot__optional_text) == (1.5, -2.25, "home")
    assert w["s1"].response_value__note == "hello" and "note__text" not in W.wide(rep, all_types=True).columns


def test_long_lists_are_bounded(spark, tmp_path):
    n, most = 150_000, table_queries.LIST_OPTIONS
    lines = spark.range(n + 3000).select(
        F.when(F.col("id") < n / 2, F.lit(7)).when(F.col("id") >= n, F.col("id") % 3).cast("bigint").alias("l_suppkey"),
        F.col("id").alias("l_orderkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    sizes = (table_queries._option_lists(lines).groupBy("l_suppkey", F.size(F.split("text", ", ")).alias("n")).count().collect())
    assert max(r["n"] for r in sizes) <= most and min(r["n"] for r in sizes if r["l_suppkey"] in (None, 7)) > most / 4
    assert {r["l_suppkey"]: r["n"] for r in sizes if r["l_suppkey"] in (0, 1, 2)} == {0: 1000, 1: 1000, 2: 1000}
    got = {r["l_suppkey"]: tuple(r)[1:] for r in table_queries.parse_long_lists(spark, str(tmp_path)).collect()}
    want = lines.groupBy("l_suppkey").agg(F.count("*"), F.sum("l_orderkey"), F.sum(F.col("l_linenumber").cast("bigint"))).collect()
    assert got == {r[0]: tuple(r)[1:] for r in want}
