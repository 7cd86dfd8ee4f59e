import datetime as dt

from pyspark.sql import functions as F, types as T

from tidemark.functions import (add_days, add_hours, days_between, drop_unshipped_international,
                                hours_between, max_if_complete, non_blank)

TS = T.TimestampNTZType()


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_elapsed_day_and_hour_differences(spark):
    rows = [(_ts("2020-01-01 23:00:00"), _ts("2020-01-02 01:00:00"), 0, 2),
            (_ts("2020-01-01 00:00:00"), _ts("2020-01-02 00:00:00"), 1, 24),
            (_ts("2020-01-03 00:30:00"), _ts("2020-01-01 01:00:00"), -1, -47),
            (_ts("2020-01-01 00:00:00"), _ts("2020-01-01 00:59:59"), 0, 0)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("a", TS), T.StructField("b", TS),
                                                    T.StructField("d", T.IntegerType()),
                                                    T.StructField("h", T.IntegerType())]))
    out = df.select(days_between("a", "b").alias("d2"), hours_between("a", "b").alias("h2"), "d", "h").collect()
    for r in out:
        assert (r.d2, r.h2) == (r.d, r.h)


def test_dateadd_null_amount_gives_null(spark):
    df = spark.createDataFrame([(_ts("2020-01-01 00:00:00"), None, 5)],
                               "t timestamp_ntz, n int, k int")
    r = df.select(add_days(F.col("n"), F.col("t")).alias("a"), add_days(-F.col("k"), F.col("t")).alias("b"),
                  add_hours(F.col("k"), F.col("t")).alias("c")).first()
    assert r.a is None
    assert r.b == _ts("2019-12-27 00:00:00")
    assert r.c == _ts("2020-01-01 05:00:00")


def test_non_blank(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "v string")
    assert [r.v for r in df.where(non_blank("v")).collect()] == ["x"]


def test_drop_unshipped_international_three_valued(spark):
    rows = [("INTERNATIONAL", None), ("INTERNATIONAL", "S1"), (None, None), (None, "S2"), ("COLLECT", None)]
    df = spark.createDataFrame(rows, "t string, s string")
    kept = sorted((r.t or "-", r.s or "-") for r in df.where(drop_unshipped_international("t", "s")).collect())
    assert kept == [("-", "S2"), ("COLLECT", "-"), ("INTERNATIONAL", "S1")]


def test_max_if_complete(spark):
    rows = [("a", _ts("2020-01-01 00:00:00")), ("a", None), ("b", None), ("b", None),
            ("c", _ts("2020-01-01 00:00:00")), ("c", _ts("2020-01-05 00:00:00"))]
    df = spark.createDataFrame(rows, "k string, v timestamp_ntz")
    got = {r.k: r.m for r in df.groupBy("k").agg(max_if_complete("v").alias("m")).collect()}
    assert got == {"a": None, "b": None, "c": _ts("2020-01-05 00:00:00")}
