from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small, exists_flag, left_join


def test_left_join_null_keys_never_match_and_rows_kept(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (2, "d")], "k long, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y"), (3, "z")], "rk long, w string")
    out = left_join(left, right, [("k", "rk")])
    got = sorted((r.v, r.w) for r in out.collect())
    assert got == [("a", "x"), ("b", None), ("c", None), ("d", None)]
    assert out.columns == ["k", "v", "w"]


def test_left_join_spread_key_and_guard_stay_in_the_join(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    right = spark.createDataFrame([(1, "x"), (0, "y"), (5, "z")], "rk long, w string")
    df = left_join(left, right, [("k", "rk")])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "__lk" in plan and "isnotnull(k" in plan
    # whatever spread value the NULL row gets, it matches nothing
    assert sorted((r.v, r.w) for r in df.collect()) == [("a", "x"), ("b", None)]


def test_left_join_string_keys_spread(spark):
    left = spark.createDataFrame([("0", "a"), (None, "b"), ("1", "c")], "k string, v string")
    right = spark.createDataFrame([(str(i), i) for i in range(50)], "rk string, n int")
    got = sorted((r.v, r.n) for r in left_join(left, right, [("k", "rk")]).collect())
    assert got == [("a", 0), ("b", None), ("c", 1)]


def test_left_join_two_keys_fan_out_kept(spark):
    left = spark.createDataFrame([(1, "p", "a")], "k long, f string, v string")
    right = spark.createDataFrame([(1, "p", 10), (1, "p", 11), (1, "q", 12)], "k long, f string, n int")
    out = left_join(left, right, [("k", "k"), ("f", "f")], drop_right_keys=True)
    assert sorted(r.n for r in out.collect()) == [10, 11]


def test_exists_flag(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    got = {r.k: r.f for r in exists_flag(left, keys, "k", "x", "f").collect()}
    assert got == {"a": True, "b": False, None: False}


def test_broadcast_only_below_bound(spark):
    small = spark.range(5)
    big = spark.range(50)
    left = spark.range(100).withColumnRenamed("id", "k")
    p_small = left.join(broadcast_if_small(small, 10), F.col("k") == F.col("id"))._jdf.queryExecution().optimizedPlan().toString()
    p_big = left.join(broadcast_if_small(big, 10), F.col("k") == F.col("id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in p_small.lower()
    assert "broadcast" not in p_big.lower()
