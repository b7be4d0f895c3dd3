"""Option dictionary, two-level wide, partitioned split, staged writes, executor-side headers."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import HEADER, OPTS, _row, write_export
from formspark.operators import grids, reshape, wide as W
from formspark.operators.dictionary import option_dictionary, with_options
from formspark.operators.normalize import normalize
from formspark.plans import outputs
from formspark.sinks.writers import NamedOutput, drop_null_columns, write_csv, write_parquet
from formspark.sources.exports import headers, list_export_files, read_export, read_export_frame

SLIDER = "Min: 0, Max: 200000"


def raw_rows(spark, rows):
    names = "activity_submission_id, item_name, item_type, item_response_options, item_response"
    df = spark.createDataFrame(rows, ", ".join(f"{n.strip()} string" for n in names.split(",")))
    return df.withColumn("rawScore", F.lit(None).cast("string"))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_parsed_once_and_not_per_row(spark):
    rep = normalize(raw_rows(spark, [(str(i), "q", "slider", SLIDER if i % 2 else None, f"value: {i}") for i in range(400)]))
    d = option_dictionary(rep)
    assert d.frame.count() == 1 and d.small
    full = reshape.expand_options(rep, d)
    assert not re.search(r"sequence\(", plan(full))
    scored = outputs.scored_responses(rep)
    assert "sequence(" not in plan(scored) and "sequence(" not in plan(W.wide(rep))
    got = sorted(r[0] for r in scored.select("item_option_value").collect())
    assert got == [i for i in range(400) if i % 2]
    assert full.where(F.col("activity_submission.id") == "1").count() == 200_001


def test_a_dictionary_too_large_to_broadcast_gives_the_same(spark, export_dir):
    rep = read_export(spark, str(export_dir))
    d = option_dictionary(rep)
    large = type(d)(d.frame, False)
    key = lambda df: sorted(map(str, df.select("activity_submission.id", "item.name", "item_response_options").collect()))
    assert key(reshape.expand_options(rep, d)) == key(reshape.expand_options(rep, large))
    assert with_options(rep, large).schema == rep.schema


def test_scored_rules(spark):
    rows = [("1", "a", "singleSelect", OPTS, "value: 1"), ("2", "a", "singleSelect", OPTS, "value: null"),
            ("3", "b", "text", None, "words"), ("4", "c", "numberSelect", "no list", "value: 3"), ("5", "d", "slider", "Min: 9, Max: 1", "value: null"),
            ("6", "e", "multiSelect", OPTS, "value: 0, 2, 7"), ("7", "f", "singleSelect", "big: 99999999999999999999", "value: null")]
    got = outputs.scored_responses(normalize(raw_rows(spark, rows)))
    found = sorted(map(tuple, got.select("activity_submission.id", "item_option_name", "item_option_score").collect()), key=str)
    assert found == sorted([("1", "Sometimes", 2), ("3", None, None), ("5", None, None), ("6", "Never", 1), ("6", "Often", 3),
                            ("7", "big", None)], key=str)


def test_wide_rows_keep_nulls_apart(spark):
    rows = [("a", "q", "text", None, "x"), (None, "q", "text", None, "y"), ("", "q", "text", None, "z"), ("b", None, "text", None, "w")]
    raw = raw_rows(spark, rows).withColumn("target_id", F.when(F.col("activity_submission_id") == "a", None).otherwise(F.lit("a")))
    got = {(r.activity_submission_id, r.target_user_id): r.response_value__q for r in W.wide(normalize(raw)).collect()}
    assert got == {("a", None): "x", (None, "a"): "y", ("", "a"): "z", ("b", "a"): None}


def test_wide_duplicates_first_and_fail(spark):
    rows = [("s", "q", "singleSelect", OPTS, f"value: {i % 3}") for i in range(50)] + [("s", "t", "text", None, f"text {i:02}") for i in range(50)]
    rep = normalize(raw_rows(spark, rows).repartition(7))
    (r,) = W.wide(rep, on_duplicate="first").collect()
    assert (r.q, r.q__index, r.q__response, r.response_value__t) == (1, 0, "Never", "text 00")
    for action in (lambda w: w.count(), lambda w: w.collect()):
        with pytest.raises(Exception, match="duplicate answers"):
            action(W.wide(rep))


def test_split_reads_its_own_folder(spark):
    rows = [(f"s{i}", f"q{i % 50}", "text", None, f"v{i}") for i in range(500)]
    raw = raw_rows(spark, rows).withColumn("activity_id", F.regexp_replace("item_name", "q", "a")).withColumn(
        "activity_name", F.when(F.col("item_name") == "q1", " Act").when(F.col("item_name") == "q2", "Act").otherwise(F.col("item_name")))
    raw = raw.withColumn("activity_id", F.when(F.col("item_name").isin("q1", "q2"), "same").otherwise(F.col("activity_id")))
    parts = W.split_wide(normalize(raw))
    assert len(parts) == 50 and len({n.lower() for n, _ in parts}) == 50
    for name, df in parts[:3]:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(_act" in text, name
    total = parts[0][1].select(F.lit(1))
    for _, df in parts[1:]:
        total = total.unionAll(df.select(F.lit(1)))
    assert total.count() == 500
    assert {"response_value__q1", "response_value__q2"} <= {c for n, df in parts for c in df.columns if n.startswith("Act-same")}


def counted(spark, df):
    """``df`` and an accumulator of the rows computed of it."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(look, df.schema), seen


def test_dropping_null_columns_computes_the_frame_once(spark, tmp_path):
    df = spark.range(30).selectExpr("id", "cast(null as string) AS `none`", "if(id = 7, 'x', null) AS `a b`", "cast(null as int) AS k")
    frame, seen = counted(spark, df)
    write_parquet(NamedOutput("p", frame, ["k"]), str(tmp_path), drop_nulls=True)
    assert seen.value == 30 and spark.read.parquet(f"{tmp_path}/p.parquet").columns == ["id", "a b", "k", "by_k"]
    frame, seen = counted(spark, df)
    write_csv(NamedOutput("c", frame), str(tmp_path), drop_nulls=True)
    assert seen.value == 30
    frame, seen = counted(spark, df)
    got = drop_null_columns(frame)
    assert got.columns == ["id", "a b"] and got.count() == 30 and seen.value == 30
    assert drop_null_columns(df.limit(0)).columns == [] and drop_null_columns(df.withColumn("v", F.lit(None))).columns == ["id", "a b"]


def test_dedupe_reads_the_input_once(spark):
    raw = raw_rows(spark, [("s", f"q{i}", "text", None, "x") for i in range(9)]).withColumn("subscale_name_m", F.lit("2.5")).withColumn(
        "activity_score", F.when(F.col("item_name") == "q3", "7"))
    frame, seen = counted(spark, raw)
    rep = normalize(frame, dedupe_subscales=True)
    got = sorted(map(tuple, rep.select("item.name", "response.value.subscale").collect()), key=str)
    assert seen.value == 9
    assert got == sorted([(f"q{i}", None) for i in range(9)] + [("m", 2.5), ("activity_score", 7.0)], key=str)


def test_header_with_line_breaks_and_odd_file_names(spark, tmp_path):
    odd = [*HEADER, 'note,\n"two" lines']
    write_export(tmp_path / "a b_responses%20.csv", [[*_row("s1", 1, 1, "i", "q", "text", "", "one\ntwo"), "extra"]], header=odd)
    write_export(tmp_path / "b_responses.csv", [_row("s2", 1, 1, "i", "q", "text", "", "x")], bom=False)
    write_export(tmp_path / "c_responses.csv", [], bom=True)
    (tmp_path / "d_responses.csv").write_text("")
    (tmp_path / "e_responses.csv").write_text("only\nvalue\n")
    files = list_export_files(spark, str(tmp_path))
    groups = {tuple(r["header"]): len(r["paths"]) for r in headers(spark, files).collect()}
    assert groups == {tuple(odd): 1, tuple(HEADER): 2, ("only",): 1}
    raw = read_export_frame(spark, files)
    assert set(raw.columns) == {*odd, "only"}
    rows = {r["activity_submission_id"]: r.asDict() for r in raw.collect()}
    assert len(rows) == 3 and rows["s1"][odd[-1]] == "extra" and rows["s1"]["item_response"] == "one\ntwo" and rows[None]["only"] == "value"


def grid_report(spark, rows):
    """rows: (secret_id, activity name, epoch ms, item id)."""
    df = spark.createDataFrame(rows, "target_secret_id string, activity_name string, activity_start_time string, item_id string")
    return normalize(df.withColumns({"rawScore": F.lit(None).cast("string"), "activity_end_time": F.lit(None).cast("string")}))


def test_grids_of_any_names(spark):
    roster = spark.createDataFrame([("p1", "n1", "s1"), ("p2", "n2", "s2")], "secret_id string, nickname string, site string")
    names = ["Lunch", "lunch", "site", "secret_id", "complete", "a.b`c", "x"]
    rep = grid_report(spark, [("p1", n, "0", "i" if n != "x" else None) for n in names] + [("p3", "Lunch", "0", "i")])
    got = grids.completion(rep, roster)
    assert got.columns == ["secret_id", "nickname", "site", "Lunch", "a.b`c", "complete__2", "lunch__2", "secret_id__2", "site__2", "x", "complete"]
    rows = {r[0]: r[3:] for r in got.collect()}
    assert rows == {"p1": (True,) * 6 + (False, False), "p2": (False,) * 8}
    daily = grid_report(spark, [("p1", f"Student Check {n}", "86400000", "i") for n in ("A", "a")] + [("p2", "Student Check A", "0", None)])
    att = grids.attendance(daily, roster)
    assert att.columns[3:] == ["activity_date", "Student Check A", "Student Check a__2"]
    assert {(r[0], str(r[3])): tuple(r[4:]) for r in att.collect()} == {
        ("p1", "1970-01-02"): (True, True), ("p1", "1970-01-01"): (False, False),
        ("p2", "1970-01-02"): (False, False), ("p2", "1970-01-01"): (False, False)}


def test_grid_of_many_dates(spark, monkeypatch):
    roster = spark.createDataFrame([("p1", "n"), ("p2", "m")], "secret_id string, nickname string")
    days = spark.range(100_000).select(F.lit("p1").alias("target_secret_id"), F.lit("Student Check-In").alias("activity_name"),
                                       (F.col("id") * 86_400_000).cast("string").alias("activity_start_time"), F.lit("i").alias("item_id"))
    rep = normalize(days.withColumns({"rawScore": F.lit(None).cast("string"), "activity_end_time": F.lit(None).cast("string")}))
    for most in (grids.BROADCAST_DATES, 10):
        monkeypatch.setattr(grids, "BROADCAST_DATES", most)
        grid = grids.attendance(rep, roster)
        assert len(plan(grid)) < 20_000
        assert grid.agg(F.count(F.lit(1)), F.sum(F.col("`Student Check-In`").cast("int"))).first()[:] == (200_000, 100_000)
