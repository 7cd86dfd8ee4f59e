"""Heavy keys: split joins and a PO that holds a third of the control-tower lines."""
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import facts as fx, skew
from tidemark.operators.skew import Heavy, heavy_keys, is_heavy, packed, split_left_join, stripes, stripes_by_pairs, unpacked
from tidemark.plans.catalog import j2_heavy_split
from tidemark.plans.silver_job import silver_milestones
from tidemark.sources import bronze as br

AS_OF = "2000-01-01 00:00:00"


def rows(df):
    return sorted(map(str, df.collect()))


def test_heavy_keys_are_found_and_bounded(spark):
    df = spark.createDataFrame([(k,) for k in ["a"] * 50 + ["b"] * 30 + [None] * 90 + [f"x{i}" for i in range(30)]], "k string")
    assert heavy_keys(df, "k", 20, 10) == (["a", "b"], 20) or heavy_keys(df, "k", 20, 10) == (["b", "a"], 20)
    assert heavy_keys(df, "k", 1, 5) == (["a"], 40)
    assert heavy_keys(df, "k", 1000) == ([], 1000) and heavy_keys(df.limit(0), "k", 0, 5) == ([], 1)
    keys, bound = heavy_keys(df, "k", 0, 200)
    assert bound == 1 and set(keys) == {"a", "b"}
    assert stripes(0, 10) == 1 and stripes(10, 10) == 1 and stripes(11, 10) == 2


@pytest.mark.parametrize("kind", ["long", "string", "decimal(20,0)"])
@pytest.mark.parametrize("left_stripes, right_stripes", [(1, 1), (1, 7), (5, 1), (4, 6)])
def test_split_equals_left_join(spark, kind, left_stripes, right_stripes):
    rng = random.Random(left_stripes * 10 + right_stripes)
    # 1, 2: both sides; 3: left only; 4: right only; 9: not heavy; repeated rows on both sides
    left = spark.createDataFrame([(rng.choice([1, 1, 1, 2, 3, 9, None]), rng.randrange(5)) for _ in range(150)], "k long, v long")
    right = spark.createDataFrame([(rng.choice([1, 1, 2, 4]), rng.randrange(9)) for _ in range(80)] + [(2, None)], "r long, w long")
    left, right = left.withColumn("k", F.col("k").cast(kind)), right.withColumn("r", F.col("r").cast(kind))
    heavy = [Heavy(k, left_stripes, right_stripes) for k in (1, 2, 3, 4)]
    want = left.join(right, F.col("k") == F.col("r"), "left")
    kept = split_left_join(left, right, [("k", "r")], heavy, drop_right_keys=False)
    assert kept.columns == want.columns and rows(kept) == rows(want)
    assert rows(split_left_join(left, right, [("k", "r")], heavy)) == rows(want.drop("r"))
    assert rows(split_left_join(left, right, [("k", "r")], [])) == rows(want.drop("r"))


def test_split_on_two_keys_with_a_unique_right_side(spark):
    left = spark.createDataFrame([(1, i % 4, i) for i in range(60)] + [(2, 0, 99)], "k long, a long, v long")
    right = spark.createDataFrame([(1, 0, "x"), (1, 1, "y"), (2, 5, "z")], "k long, a long, w string")
    got = split_left_join(left, right, [("k", "k"), ("a", "a")], [Heavy(1, 8), Heavy(2, 3)])
    assert got.columns == ["k", "a", "v", "w"]
    assert rows(got) == rows(left.join(right, ["k", "a"], "left"))


def test_rows_of_a_heavy_key_are_spread(spark):
    left = spark.range(1).select(F.lit("hot").alias("k"))
    right = spark.range(30_000).select(F.lit("hot").alias("r"), "id").repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        out = split_left_join(left, right, [("k", "r")], [Heavy("hot", 1, 200)])
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(sizes) == 30_000 and max(sizes) <= 0.05 * 30_000


@pytest.fixture(scope="module")
def hot(spark, bronze):
    """Fixture sources in which one international PO holds a third of the control-tower
    lines, one collect PO many line groups, and one PO lines without export orders."""
    types = fx.po_types(bronze.purchase_orders, bronze.export_order)
    pos = {t: types.where(F.col("PO_TYPE") == t).agg(F.min("TC_PURCHASE_ORDERS_ID")).first()[0] for t in ("INTERNATIONAL", "COLLECT")}
    last = types.where("PO_TYPE = 'INTERNATIONAL'").agg(F.max("TC_PURCHASE_ORDERS_ID")).first()[0]
    b = br.Bronze(bronze)
    n = bronze.ct_shipment.count() // 2
    day = F.lit("1999-06-01").cast("timestamp_ntz")
    extra = spark.range(n).select(F.concat(F.lit("H"), F.col("id") % (n // 2)).alias("SC_CT_SHIPMENT_ID"),
                                  F.lit(pos["INTERNATIONAL"]).alias("TSC_PO_NO"), (F.col("id") % 7).alias("ARTICLE_NO"),
                                  (day + F.make_dt_interval(F.col("id").cast("int") % 30)).alias("SHIPMENT_START_DATE"))
    lost = extra.withColumns({"TSC_PO_NO": F.lit(last), "SC_CT_SHIPMENT_ID": F.concat(F.lit("L"), "SC_CT_SHIPMENT_ID"),
                              "ARTICLE_NO": F.col("ARTICLE_NO") + 10**9})
    b["ct_shipment"] = bronze.ct_shipment.unionByName(extra).unionByName(lost)
    exports = spark.range(5).select(F.lit(pos["INTERNATIONAL"]).alias("SC_EXP_PO_NO"), F.col("id").alias("ARTICLE_NO"),
                                    *[(day + F.make_dt_interval(F.col("id").cast("int") * 3)).alias(c) for c in
                                      ("SHIP_NOT_AFTER", "SHIP_NOT_BEFORE", "VENDOR_BOOKED_DATE", "CARGO_READY_DATE")])
    b["export_order"] = bronze.export_order.unionByName(exports)
    line = bronze.purchase_order_line.limit(1)
    b["purchase_order_line"] = bronze.purchase_order_line.unionByName(
        line.drop("PO_NO", "PO_TRACKING_NO").crossJoin(spark.range(2000).select(
            F.lit(pos["COLLECT"]).alias("PO_NO"), F.concat(F.lit("G"), F.col("id") % 900).alias("PO_TRACKING_NO"))))
    b["pos"] = pos | {"last": last}
    return b


def test_hot_pos_give_the_same_table(hot):
    pos = hot.pop("pos")
    heavy = fx.heavy_pos(hot, 100, 20)
    assert {h.key for h in heavy} == set(pos.values())
    by_key = {h.key: h for h in heavy}
    assert by_key[pos["INTERNATIONAL"]].right > 1 and by_key[pos["COLLECT"]].left > 1
    for used_only in (True, False):
        plain, split = (fx.milestone_input(hot, used_only, h) for h in ((), heavy))
        assert split.columns == plain.columns
        assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()
    plain = silver_milestones(hot, AS_OF, heavy_rows=10**9)
    split = silver_milestones(hot, AS_OF, heavy_rows=100, shares=20)
    assert plain.count() == split.count() > 1000
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


def test_is_heavy_is_false_for_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    assert [r.h for r in df.select(is_heavy("k", [Heavy("a")]).alias("h")).collect()] == [True, False, False]


def test_cells_are_bounded_by_the_pairs_they_make(spark):
    """The more rows a key has, the more cells; adaptive execution leaves them apart."""
    def sides(n):
        left = spark.range(n).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
        return left, spark.range(n).select((F.col("id") % 2).alias("r"), F.col("id").alias("w"))
    for n in (200, 800):
        left, right = sides(n)
        heavy = stripes_by_pairs(left, "k", right, "r", [Heavy(0, 2, 3), Heavy(1, 2, 3)], pairs=1000)
        assert all((n // 2) ** 2 <= h.left * h.right * 1000 for h in heavy)
    assert stripes_by_pairs(left, "k", right, "r", [Heavy(7, 2, 3)]) == [Heavy(7, 2, 3)]
    out = split_left_join(left, right, [("k", "r")], heavy)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 2 * 400 * 400 and max(sizes) <= 8000


@pytest.mark.parametrize("left_stripes, right_stripes", [(1, 1), (5, 1), (4, 6)])
@pytest.mark.parametrize("per_array", [1024, 4])
def test_packed_join_equals_left_join(spark, monkeypatch, left_stripes, right_stripes, per_array):
    """Rows without a match, NULL keys, repeated rows and keys with several arrays."""
    monkeypatch.setattr(skew, "PACKED_ROWS", per_array)
    rng = random.Random(left_stripes)
    left = spark.createDataFrame([(rng.choice([1, 1, 2, 3, 9, None]), rng.randrange(5)) for _ in range(150)], "k long, v long")
    right = spark.createDataFrame([(rng.choice([1, 1, 2, 4]), rng.choice([None, 1, 2]), "x") for _ in range(80)], "r long, w long, z string")
    on, heavy = [("k", "r")], [Heavy(k, left_stripes, right_stripes) for k in (1, 2, 3, 4)]
    want = left.join(right, F.col("k") == F.col("r"), "left")
    got = unpacked(split_left_join(left, right, on, heavy, drop_right_keys=False, pack=True))
    assert got.select(want.columns).dtypes == want.dtypes and rows(got.select(want.columns)) == rows(want)
    assert rows(unpacked(split_left_join(left, right, on, [], pack=True))) == rows(want.drop("r"))
    keys_only = unpacked(split_left_join(left, right.select("r"), on, heavy, pack=True))
    assert keys_only.columns == left.columns and rows(keys_only) == rows(want.select(*left.columns))
    sizes = [len(r[0]) for r in packed(right, ["r"]).select("__rows").collect()]
    assert sum(sizes) == 80 and max(sizes) <= per_array


def test_heavy_fan_out_makes_its_pairs_last(spark):
    """The pairs of j2_heavy_split are made by the last step of the plan, after the union."""
    plan = j2_heavy_split(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Union")
