"""What grows with the input: files and tasks of bounded size, narrow rows in shuffles."""

from pyspark.sql import functions as F

from formspark.operators import reshape, wide as wide_op
from formspark.operators.normalize import normalize
from formspark.plans import table_queries
from formspark.session import configure, spread
from formspark.sources.exports import list_export_files, read_export_frame


def _raw(spark, rows):
    cols = "applet_version, activity_submission_id, target_id, item_name, item_type, item_response_options, item_response, rawScore"
    return spark.createDataFrame([("1.0", *r) for r in rows], ", ".join(f"{c} string" for c in cols.split(", ")))


def test_generated_methods_stay_compilable(spark):
    assert int(configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_spread_by_rows(spark):
    many = spark.range(0, 1000, 1, spark.sparkContext.defaultParallelism)
    assert spread(many, 1000) is many
    dealt = spread(many, 10)
    assert dealt.rdd.getNumPartitions() == 100
    assert dealt.orderBy("id").collect() == many.collect()


def test_export_files_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(table_queries, "ROWS_A_FILE", 10)
    frame = spark.range(25).coalesce(1).select(F.col("id").cast("string").alias("a"), F.lit('x,"y"\nz').alias("b"))
    files = list_export_files(spark, table_queries._export_files(spark, frame, "t"))
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    assert sorted(map(tuple, read_export_frame(spark, files).collect())) == sorted(map(tuple, frame.collect()))


def test_plain_and_compressed_exports_are_listed(spark, tmp_path):
    for name in ("a_responses.csv", "b_responses.csv.gz", "c_responses.txt", "d.csv.gz"):
        (tmp_path / name).write_bytes(b"")
    assert [f.rsplit("/", 1)[1] for f in list_export_files(spark, str(tmp_path))] == ["a_responses.csv", "b_responses.csv.gz"]


def test_item_options_need_one_shuffle(spark):
    rows = [(s, "t", n, "singleSelect", o, "value: 0", None) for s in ("s1", "s2") for n, o in (
        ("a", "x: 0, x: 0, y: 1"), ("b", "x: 0"), ("c", None), (None, "x: 0, y: 1"))]
    t = reshape.item_response_options(normalize(_raw(spark, rows)))
    got = t.select("item.name", "item_option_name", "item_option_value").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
        ("a", "x", 0), ("a", "y", 1), ("b", "x", 0), ("c", None, None), (None, "x", 0), (None, "y", 1)]))
    assert t._jdf.queryExecution().sparkPlan().toString().count("Aggregate") <= 2


def test_wide_first_sorts_answers_without_the_index(spark):
    rows = [(s, t, "q", "text", None, a, None) for s, t in (("s1", "t1"), ("s1", None), (None, None)) for a in ("b", "a", "a", None)]
    report = normalize(_raw(spark, rows))
    assert sorted(map(str, map(tuple, wide_op.wide(report, on_duplicate="first").select(
        "activity_submission_id", "target_user_id", "response_value__q").collect()))) == sorted(map(str, [
            (s, t, None) for s, t in (("s1", "t1"), ("s1", None), (None, None))]))
    plan = wide_op.collected(report, on_duplicate="first")._jdf.queryExecution().optimizedPlan().toString()
    assert all("_index" not in line for line in plan.splitlines() if "min(_answer" in line)


def test_wide_tasks_by_number_of_answers(spark, monkeypatch):
    monkeypatch.setattr(wide_op, "ANSWERS_A_TASK", 2)
    rows = [(f"s{i}", "t", n, "text", None, f"{i}", None) for i in range(20) for n in ("p", "q")]
    report = normalize(_raw(spark, rows))
    assert wide_op.layout(report).rows == 40
    assert wide_op.collected(report, n_rows=40).rdd.getNumPartitions() == 20
    w = wide_op.wide(report).collect()
    assert sorted((r["activity_submission_id"], r["response_value__p"], r["response_value__q"]) for r in w) == sorted(
        (f"s{i}", f"{i}", f"{i}") for i in range(20))


def test_times_without_digits_are_null(spark):
    from formspark.functions.scalars import epoch_ms_to_timestamp
    df = spark.createDataFrame([("not scheduled",), ("",), (None,), ("1733927671657",), (" 5 ",), ("x5",), ("-7",)], "c string")
    got = [r[0] for r in df.select(F.unix_millis(epoch_ms_to_timestamp(F.col("c")))).collect()]
    assert got == [None, None, None, 1733927671657, 5, None, -7]
