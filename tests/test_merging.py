"""Tables that increments are merged into."""
import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.states import Agg, finish
from tidemark.sources import merging
from tidemark.sources.merging import BUCKET, accumulate, latest, merge_increment, read_merged, upsert

SCHEMA = "k string, j long, t timestamp_ntz, v string"


def name():
    return f"merged_{uuid.uuid4().hex[:8]}"


def at(day):
    return None if day is None else dt.datetime(2024, 1, day)


def frame(spark, rows):
    return spark.createDataFrame([(k, j, at(t), v) for k, j, t, v in rows], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(spark, table, bucket=None):
    df = spark.table(table)
    return sorted((df.where(F.col(BUCKET) == bucket) if bucket is not None else df).select(F.input_file_name()).distinct()
                  .toPandas().iloc[:, 0])


def test_upsert_keeps_the_latest_row_per_key(spark):
    t = name()
    done = upsert(spark, frame(spark, [("a", 1, 1, "old"), ("a", 1, 2, "new"), ("a", None, 3, "null key"), ("b", 1, None, "no time")]),
                  t, ["k", "j"], ["t"], "20240102000000", buckets=8)
    assert done.next_start == at(3) and not done.skipped
    done = upsert(spark, frame(spark, [("a", 1, 1, "late"), ("a", None, 3, "tie"), ("b", 1, 1, "time"), ("c", 2, 2, "first")]),
                  t, ["k", "j"], ["t"], "20240103000000", done.next_start)
    assert rows(read_merged(spark, t)) == rows(frame(spark, [("a", 1, 2, "new"), ("a", None, 3, "tie"), ("b", 1, 1, "time"),
                                                             ("c", 2, 2, "first")]))
    assert done.next_start == at(3)
    # nothing new: the lower bound stays
    assert upsert(spark, frame(spark, []), t, ["k", "j"], ["t"], "20240104000000", at(3)).next_start == at(3)


def test_two_increments_equal_the_full_extract(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    t, cut = name(), F.lit("2024-01-09").cast("timestamp_ntz")
    done = upsert(spark, events.where(F.col("ts") <= cut), t, ["event_id"], ["ts"], "20240109000000")
    done = upsert(spark, events.where(F.col("ts") > F.lit(str(done.next_start)).cast("timestamp_ntz")), t, ["event_id"], ["ts"], "20240110000000")
    got = read_merged(spark, t)
    assert got.dtypes == events.dtypes and got.count() == events.count() and got.exceptAll(events).isEmpty()


def test_ties_and_a_hot_key_are_settled_alike(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), F.lit(1).alias("t"), (F.col("id") % 700).alias("v"))
    picked = {tuple(latest(df.repartition(n), ["k"], ["t"]).first()) for n in (1, 3, 7)}
    assert len(picked) == 1
    assert "Window" not in latest(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    only = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    assert rows(latest(only, ["k"], ["k"])) == [(1,), (None,)]


def test_only_touched_buckets_are_rewritten(spark):
    t = name()
    upsert(spark, frame(spark, [(str(i), 0, 1, "x") for i in range(100)]), t, ["k"], ["t"], "1", buckets=16)
    before = {b: files(spark, t, b) for b in range(16)}
    done = upsert(spark, frame(spark, [("3", 0, 2, "y"), ("77", 0, 2, "y")]), t, ["k"], ["t"], "2")
    assert 1 <= len(done.rewritten) <= 2
    for b in range(16):
        assert (files(spark, t, b) == before[b]) == (b not in done.rewritten)
    assert read_merged(spark, t).where("v = 'y'").count() == 2 and read_merged(spark, t).count() == 100


def test_a_batch_counts_once(spark, monkeypatch):
    """Sums survive a rerun, also of a batch that only some buckets got."""
    t, aggs = name(), (Agg("N", "sum", "j"),)
    base = frame(spark, [(str(i), 1, 1, "x") for i in range(40)])
    accumulate(spark, base, t, ["k"], aggs, "20240101000000", buckets=4)
    more = frame(spark, [(str(i), 10, 1, "x") for i in range(0, 80, 2)])
    # the batch reaches two buckets only, then dies
    plain = merging.merge_increment
    half = more.where(F.pmod(F.xxhash64("k"), F.lit(4)) < 2)
    accumulate(spark, half, t, ["k"], aggs, "20240102000000")
    done = accumulate(spark, more, t, ["k"], aggs, "20240102000000")
    assert set(done.skipped) == {0, 1} and set(done.rewritten) == {2, 3} and plain is merge_increment
    want = {str(i): (1 if i < 40 else 0) + (10 if i % 2 == 0 else 0) for i in range(80)}
    got = {r.k: r.N for r in finish(read_merged(spark, t), ["k"], aggs).collect()}
    assert got == {k: n for k, n in want.items() if n}
    assert accumulate(spark, more, t, ["k"], aggs, "20240102000000").rewritten == ()


def test_keys_and_columns_are_checked(spark):
    t = name()
    upsert(spark, frame(spark, [("a", 1, 1, "x")]), t, ["k"], ["t"], "1")
    with pytest.raises(ValueError, match="keyed by k"):
        upsert(spark, frame(spark, [("a", 1, 1, "x")]), t, ["k", "j"], ["t"], "2")
    with pytest.raises(ValueError, match="columns of"):
        upsert(spark, frame(spark, [("a", 1, 1, "x")]).drop("v"), t, ["k"], ["t"], "2")
    assert read_merged(spark, t).count() == 1


def test_an_empty_first_increment_makes_the_table(spark):
    t = name()
    assert upsert(spark, frame(spark, []), t, ["k"], ["t"], "1").rewritten == ()
    upsert(spark, frame(spark, [("a", 1, 1, "x")]), t, ["k"], ["t"], "2")
    assert read_merged(spark, t).count() == 1


def test_a_batch_that_is_there_is_not_computed_again(spark, monkeypatch):
    """Its buckets are found from the keys; nothing is written aside or shuffled for it."""
    t, aggs = name(), (Agg("N", "sum", "j"),)
    rows_ = frame(spark, [(str(i % 30), 1, 1, "x") for i in range(90)])
    monkeypatch.setattr(merging, "staged", lambda *a: pytest.fail("written aside"))
    assert len(accumulate(spark, rows_, t, ["k"], aggs, "1", buckets=4).rewritten) == 4
    assert accumulate(spark, rows_, t, ["k"], aggs, "2").skipped == ()
    assert len(accumulate(spark, rows_, t, ["k"], aggs, "2").skipped) == 4
    assert {r.N for r in read_merged(spark, t).collect()} == {6}
    assert all(len(files(spark, t, b)) == 1 for b in range(4))
