"""Sinks: CSV encoding of nested values, null-column drop, Parquet round trip."""

import datetime as dt

from pyspark.sql import functions as F

from formspark.sinks.writers import NamedOutput, csv_encode, drop_null_columns, safe_name, write_csv, write_parquet


def _frame(spark):
    rows = [(7, "north", (0.5, "x"), [10, 20], None), (8, "south", (None, "y"), [], None), (9, None, None, [30], None)]
    return spark.createDataFrame(rows, "visit int, ward string, pulse struct<rate:double,unit:string>, doses array<int>, nothing date")


def test_csv_writer(spark, tmp_path):
    df = _frame(spark).withColumn("stay", F.make_dt_interval(F.lit(1), F.lit(0), F.lit(3), F.lit(0)))
    path = write_csv(NamedOutput("ward visits", df), str(tmp_path), drop_nulls=True)
    back = spark.read.option("header", "true").option("escape", '"').csv(path)
    assert set(back.columns) == {"visit", "ward", "pulse", "doses", "stay_ms"}
    r = back.where("visit = 8").first()
    assert (r.pulse, r.doses, r.stay_ms) == ('{"rate":null,"unit":"y"}', '{"doses":[]}', str((24 * 60 + 3) * 60_000))


def test_intervals_inside_nested_columns_are_milliseconds(spark):
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(2), F.lit(0))
    df = spark.range(1).select(F.struct(F.lit(1).alias("a"), span.alias("b")).alias("s"), F.array(F.struct(span.alias("c"))).alias("l"))
    r = csv_encode(df).first()
    assert (r.s, r.l) == ('{"a":1,"b_ms":120000}', '{"l":[{"c_ms":120000}]}')


def test_json_keeps_null_fields(spark):
    df = spark.createDataFrame([((None, 2),)], "s struct<a:int,b:int>")
    assert csv_encode(df).first().s == '{"a":null,"b":2}'


def test_drop_null_columns(spark, tmp_path):
    assert drop_null_columns(_frame(spark)).columns == ["visit", "ward", "pulse", "doses"]
    assert drop_null_columns(_frame(spark).limit(0)).columns == []
    path = write_parquet(NamedOutput("none", _frame(spark).limit(0)), str(tmp_path), drop_nulls=True)
    assert spark.read.parquet(path).columns == _frame(spark).columns


def test_parquet_round_trip(spark, tmp_path):
    df = _frame(spark).withColumn("d", F.lit(dt.date(2024, 1, 2)))
    path = write_parquet(NamedOutput("my  out", df), str(tmp_path))
    assert path.endswith("my_out.parquet")
    back = spark.read.parquet(path)
    assert sorted(back.collect()) == sorted(df.collect())


def test_partitioned_write(spark, tmp_path):
    df = spark.createDataFrame([("n", 1, None), ("s", 2, None)], "site string, v int, room string")
    path = write_csv(NamedOutput("grid", df, ["site", "room"]), str(tmp_path), drop_nulls=True)
    assert sorted(p.name for p in (tmp_path / "grid.csv").iterdir() if "=" in p.name) == ["by_site=n", "by_site=s"]
    part = spark.read.option("header", "true").csv(f"{path}/by_site=n")
    assert part.first().site == "n" and "room" in part.columns
    assert safe_name(" a b/c ") == "a_b_c"
