"""Scalar helpers: ISO-8601 durations, interval milliseconds, whitespace trim, spread."""

from pyspark.sql import functions as F

from formspark.functions.scalars import interval_ms, iso_duration, strip_all
from formspark.session import spread


def test_iso_duration(spark):
    df = spark.createDataFrame([(m, s) for m, s in [(0, 0), (-240, 0), (330, 0), (1500, 0), (0, 90500), (-1, 0)]],
                               "m int, ms int")
    iv = F.make_dt_interval(F.lit(0), F.lit(0), F.col("m"), F.col("ms") / F.lit(1000))
    got = [(r.iso, r.ms) for r in df.select(iso_duration(iv).alias("iso"), interval_ms(iv).alias("ms")).collect()]
    assert got == [("PT0S", 0), ("-PT4H", -14_400_000), ("PT5H30M", 19_800_000), ("P1DT1H", 90_000_000),
                   ("PT1M30.5S", 90_500), ("-PT1M", -60_000)]


def test_strip_all(spark):
    df = spark.createDataFrame([(" \t a b\n\r\x0b\x0c",)], "s string")
    assert df.select(strip_all(F.col("s")).alias("t")).first().t == "a b"


def test_spread_only_when_under_partitioned(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(spark.sparkContext.defaultParallelism * 2)
    assert spread(many) is many
