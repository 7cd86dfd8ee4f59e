import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions.runinfo import run_info
from tidemark.plans.ingest_job import ingest_all
from tidemark.session import shared_dir
from tidemark.sources.control import active_sources, example_control, resolve_options
from tidemark.sources.extract import extract_incremental
from tidemark.sources.sinks import (append_run_log, compact_table, publish, replace_table, table_count,
                                    truncate_append, with_audit_ts)
from tidemark.streaming.incremental import bound_query, render_query

SF = "/root/testdata/sf0.001"


def _name(p):
    return f"{p}_{uuid.uuid4().hex[:8]}"


def test_tables_live_under_the_table_root(spark, tmp_path):
    name = _name("t")
    loc = replace_table(spark, spark.range(10), name)
    assert not loc.startswith(shared_dir(spark))  # scratch holds no tables
    assert loc.startswith(spark.conf.get("spark.sql.warehouse.dir").rstrip("/"))
    own = replace_table(spark, spark.range(10), name, root=f"file:{tmp_path}")
    assert own.startswith(f"file:{tmp_path}")
    assert spark.table(name).count() == 10
    spark.sql(f"drop table {name}")


def test_replace_table_allows_new_schema(spark):
    name = _name("t")
    replace_table(spark, spark.range(3), name)
    replace_table(spark, spark.range(2).withColumn("x", F.lit("a")), name)
    assert spark.table(name).columns == ["id", "x"] and table_count(spark, name) == 2


def test_compact_reduces_files_keeps_rows(spark):
    name = _name("t")
    replace_table(spark, spark.range(1000).repartition(12), name)
    before, after = compact_table(spark, name, target_bytes=1 << 30)
    assert before == 12 and after == 1
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(1000))


def test_publish_twice_and_truncate_append(spark):
    name = _name("silver")
    publish(spark, spark.range(5), name)
    publish(spark, spark.range(7), name)
    assert table_count(spark, name) == 7
    truncate_append(spark, spark.range(3), name)
    assert table_count(spark, name) == 3


def test_run_log_keeps_quotes(spark):
    log = _name("log")
    q = "SELECT * FROM t WHERE a = 'x' AND b = \"y\""
    t0 = dt.datetime(2024, 1, 1, 6, 0)
    append_run_log(spark, [("20240101060000", "t", t0, t0, 5, q)], log)
    append_run_log(spark, [("20240101060000", "u", t0, t0, 0, q)], log)
    rows = spark.table(log).orderBy("sourceName").collect()
    assert [r.queryUsed for r in rows] == [q, q] and [r.sourceCount for r in rows] == [5, 0]


def test_run_info_central_time():
    from tidemark.session import get_session
    spark = get_session()
    summer = run_info(spark, dt.datetime(2024, 7, 1, 12, 0))
    winter = run_info(spark, dt.datetime(2024, 1, 20, 18, 0))
    assert summer.batch_id == "20240701070000"
    assert winter.batch_id == "20240120120000" and winter.job_start_iso == "2024-01-20T12:00:00"


def test_incremental_window_bounds():
    tpl = "SELECT * FROM e WHERE <IncrementalColumn> > '<IncrementalStartTime>' AND <IncrementalColumn> <= '<JobStartTime>'"
    lo, hi = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20, 12)
    text, args = bound_query(tpl, "ts", lo, hi)
    assert "'" not in text and args["inc_start"] == "2024-01-10 00:00:00"
    assert render_query(tpl, "ts", lo, hi) == (
        "SELECT * FROM e WHERE ts > '2024-01-10 00:00:00' AND ts <= '2024-01-20 12:00:00'")


def test_incremental_extract_open_closed(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (9, 10, 11, 20, 21)], "ts timestamp_ntz")
    df.createOrReplaceTempView("inc_probe")
    out, _ = extract_incremental(spark, "SELECT * FROM inc_probe WHERE <IncrementalColumn> > '<IncrementalStartTime>' "
                                 "AND <IncrementalColumn> <= '<JobStartTime>'", "ts",
                                 dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))
    assert sorted(r.ts.day for r in out.collect()) == [11, 20]


@pytest.mark.parametrize("where", [
    "<IncrementalColumn> > '<IncrementalStartTime>' AND <IncrementalColumn> <= '<JobStartTime>'",
    "e.<IncrementalColumn> > '<IncrementalStartTime>' AND e.<IncrementalColumn> <= '<JobStartTime>'",
    "<IncrementalColumn> > TIMESTAMP '<IncrementalStartTime>' AND <IncrementalColumn> <= timestamp_ntz'<JobStartTime>'",
    "concat('[', <IncrementalColumn>) > '[<IncrementalStartTime>' AND concat('[', <IncrementalColumn>) <= '[<JobStartTime>'",
])
def test_incremental_template_forms(spark, where):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (9, 10, 11, 20, 21)], "ts timestamp_ntz")
    df.createOrReplaceTempView("inc_forms")
    out, _ = extract_incremental(spark, f"SELECT * FROM inc_forms e WHERE {where}", "ts",
                                 dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))
    assert sorted(r.ts.day for r in out.collect()) == [11, 20]


def test_incremental_column_is_a_name():
    text, _ = bound_query("SELECT <IncrementalColumn> FROM e", "ts` FROM x --", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    assert text == "SELECT `ts`` FROM x --` FROM e"


def test_control_and_options(spark):
    rows = active_sources(example_control(spark)).collect()
    assert [r.sourceName for r in rows] == ["events", "lineitem", "orders"]
    assert resolve_options({"schema": "<Schema>_X", "k": 1}, "tpch") == {"schema": "tpch_X", "k": 1}


def test_audit_column(spark):
    r = with_audit_ts(spark.range(1), dt.datetime(2024, 1, 20, 12)).first()
    assert r.ETL_CREATED_DTTM is not None


def test_ingest_all(spark):
    for n in ("orders", "lineitem", "events", "customer"):
        spark.read.parquet(f"{SF}/{n}.parquet").createOrReplaceTempView(n)
    run = run_info(spark, dt.datetime(2024, 1, 20, 18, 0))
    prefix = _name("bronze") + "_"
    log = ingest_all(spark, example_control(spark), run, _name("log"), table_prefix=prefix)
    got = {r.sourceName: r.sourceCount for r in log.collect()}
    n_orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert got["orders"] == n_orders and got["lineitem"] == spark.table("lineitem").count() and "customer" not in got
    assert got["events"] > 0
    assert "ETL_CREATED_DTTM" in spark.table(prefix + "orders").columns


def test_failed_write_keeps_the_table(spark):
    from pyspark.sql import functions as F
    from tidemark.sources.sinks import replace_table
    replace_table(spark, spark.range(3), "t_keep")
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        replace_table(spark, bad, "t_keep")
    assert spark.table("t_keep").count() == 3
    replace_table(spark, spark.table("t_keep").where("id > 0"), "t_keep")  # reads itself
    assert spark.table("t_keep").count() == 2
    spark.sql("drop table t_keep")


def test_publish_refuses_another_type(spark):
    from tidemark.sources.sinks import publish
    publish(spark, spark.range(2), "t_type")
    with pytest.raises(ValueError, match="differ"):
        publish(spark, spark.range(2).selectExpr("cast(id as string) id"), "t_type")
    assert spark.table("t_type").count() == 2
    spark.sql("drop table t_type")


def test_replace_keeps_a_table_at_every_moment(spark, monkeypatch):
    """A create that fails, and a rename that fails, leave the old table readable."""
    from pyspark.sql.catalog import Catalog
    name = _name("t")
    replace_table(spark, spark.range(3), name)
    wider = spark.range(5).withColumn("x", F.lit(1))
    with monkeypatch.context() as m:
        m.setattr(Catalog, "createTable", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("no create")))
        with pytest.raises(RuntimeError, match="no create"):
            replace_table(spark, wider, name)
    assert table_count(spark, name) == 3 and spark.table(name).columns == ["id"]
    plain = type(spark).sql

    def failing(self, text, *a, **k):
        if "__new_" in text and "RENAME" in text:
            raise RuntimeError("no rename")
        return plain(self, text, *a, **k)
    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", failing)
        with pytest.raises(RuntimeError, match="no rename"):
            replace_table(spark, wider, name)
    assert table_count(spark, name) == 3
    replace_table(spark, wider, name)
    assert table_count(spark, name) == 5 and spark.table(name).columns == ["id", "x"]
    # the same columns: no definition goes, the table is pointed anew
    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", lambda self, text, *a, **k: (_ for _ in ()).throw(RuntimeError(text))
                  if "DROP" in text or "RENAME" in text else plain(self, text, *a, **k))
        replace_table(spark, wider.limit(2), name)
    assert table_count(spark, name) == 2


def test_old_versions_are_bounded(spark, tmp_path):
    import os
    name, root = _name("t"), f"file:{tmp_path}"
    locs = [replace_table(spark, spark.range(k), name, root=root, keep=2) for k in range(1, 6)]
    here = os.path.join(tmp_path, "tidemark_tables", name)
    left = {f"v={loc.split('v=')[1]}" for loc in locs[2:]}
    assert set(os.listdir(here)) == left and table_count(spark, name) == 5
    (tmp_path / "tidemark_tables" / name / "notes").mkdir()
    publish(spark, spark.range(9), name, root=root)
    assert "notes" in os.listdir(here) and len(os.listdir(here)) == 4 and table_count(spark, name) == 9


def _control(spark, rows):
    from tidemark.schemas import CONTROL_SCHEMA
    return spark.createDataFrame(rows, CONTROL_SCHEMA)


@pytest.mark.parametrize("parallel", [1, 3])
def test_one_bad_source_and_a_rerun(spark, parallel):
    from tidemark.plans.ingest_job import IngestFailed
    spark.range(10).createOrReplaceTempView("ok_rows")
    spark.range(4).createOrReplaceTempView("late_rows_none")
    run = run_info(spark, dt.datetime(2024, 1, 20, 18, 0, 0))
    log, prefix = _name("log"), _name("bronze") + "_"
    view = _name("late")
    control = _control(spark, [(True, "a_ok", "s", "full", "SELECT * FROM ok_rows", None, None),
                               (True, "b_bad", "s", "full", f"SELECT * FROM {view}", None, None),
                               (True, "c_ok", "s", "full", "SELECT id FROM ok_rows", None, None)])
    with pytest.raises(IngestFailed, match="b_bad") as e:
        ingest_all(spark, control, run, log, table_prefix=prefix, parallel=parallel)
    assert set(e.value.errors) == {"b_bad"}
    rows = {r.sourceName: r for r in spark.table(log).collect()}
    assert set(rows) == {"a_ok", "b_bad", "c_ok"} and rows["b_bad"].sourceCount is None and view in rows["b_bad"].error
    assert rows["c_ok"].sourceCount == 10 and rows["c_ok"].error is None and spark.table(prefix + "c_ok").count() == 10
    files = spark.table(prefix + "a_ok").inputFiles()
    spark.range(7).createOrReplaceTempView(view)
    out = ingest_all(spark, control, run, log, table_prefix=prefix, parallel=parallel).collect()
    assert sorted((r.sourceName, r.sourceCount) for r in out) == [("a_ok", 10), ("b_bad", 7), ("c_ok", 10)]
    assert spark.table(prefix + "a_ok").inputFiles() == files  # not loaded again
    assert spark.table(log).where("sourceCount is not null").groupBy("sourceName").count().where("count > 1").isEmpty()
    assert ingest_all(spark, control, run, log, table_prefix=prefix).count() == 3


def test_ingest_that_keeps_history(spark):
    from tidemark.sources.merging import read_merged
    tpl = "SELECT * FROM hist WHERE <IncrementalColumn> > '<IncrementalStartTime>' AND <IncrementalColumn> <= '<JobStartTime>'"
    log, prefix = _name("log"), _name("bronze") + "_"
    day = [dt.datetime(2024, 1, d) for d in range(1, 9)]
    for now, start, rows in ((day[3], day[0], [(1, day[1], "a"), (2, day[2], "b")]), (day[6], day[2], [(1, day[4], "c"), (3, day[5], "d")])):
        spark.createDataFrame(rows, "id long, t timestamp_ntz, v string").createOrReplaceTempView("hist")
        ingest_all(spark, _control(spark, [(True, "hist", "s", "incremental", tpl, "t", start)]),
                   run_info(spark, now + dt.timedelta(hours=12)), log, table_prefix=prefix, upsert_keys={"hist": ["id"]})
    got = read_merged(spark, prefix + "hist").select("id", "v").collect()
    assert sorted(map(tuple, got)) == [(1, "c"), (2, "b"), (3, "d")]


LO, HI = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20, 12)


@pytest.mark.parametrize("template, text, params", [
    ("-- don't cut\nSELECT * FROM e WHERE <IncrementalColumn> > '<IncrementalStartTime>'",
     "-- don't cut\nSELECT * FROM e WHERE `ts` > :inc_start", {"inc_start"}),
    ("SELECT 1 /* it's <JobStartTime> /* \"nested */ ' */ + 0 WHERE <IncrementalColumn> <= <JobStartTime>",
     "SELECT 1 /* it's <JobStartTime> /* \"nested */ ' */ + 0 WHERE `ts` <= :inc_job_start", {"inc_job_start"}),
    ("SELECT `a'b`, '--' AS x FROM e WHERE `<IncrementalColumn>` > '<IncrementalStartTime>'",
     "SELECT `a'b`, '--' AS x FROM e WHERE `ts` > :inc_start", {"inc_start"}),
    ("SELECT 'it''s /* no comment' FROM e WHERE e.<IncrementalColumn> > TIMESTAMP '<IncrementalStartTime>'",
     "SELECT 'it''s /* no comment' FROM e WHERE e.`ts` > TIMESTAMP '2024-01-10 00:00:00'", set()),
    ("SELECT \"don't\" FROM e WHERE x = 'from <IncrementalStartTime> on' -- <IncrementalStartTime>",
     "SELECT \"don't\" FROM e WHERE x = 'from 2024-01-10 00:00:00 on' -- <IncrementalStartTime>", set()),
    ("SELECT 'a\\'b' FROM e WHERE <IncrementalColumn> > DATE /* day */ '<IncrementalStartTime>'",
     "SELECT 'a\\'b' FROM e WHERE `ts` > DATE /* day */ '2024-01-10 00:00:00'", set()),
    ("SELECT `x``--` FROM e WHERE <IncrementalColumn> BETWEEN '<IncrementalStartTime>' AND \"<JobStartTime>\"",
     "SELECT `x``--` FROM e WHERE `ts` BETWEEN :inc_start AND :inc_job_start", {"inc_start", "inc_job_start"})])
def test_templates_with_quotes_and_comments(template, text, params):
    from tidemark.streaming.incremental import scan
    assert "".join(part for _, part in scan(template)) == template
    got, args = bound_query(template, "ts", LO, HI)
    assert got == text and set(args) == params
    rendered = render_query(template, "ts", LO, HI)
    assert rendered.count("2024-01") == template.count("StartTime>") - sum(p.count("StartTime>") for k, p in scan(template) if k == "comment")


@pytest.mark.parametrize("template", ["SELECT 'open", "SELECT /* open", "SELECT `open", "SELECT \"open"])
def test_templates_with_open_ends(template):
    with pytest.raises(ValueError, match="has no end"):
        bound_query(template, "ts", LO, HI)


@pytest.mark.parametrize("kind, low, high", [("long", -50, 900), ("double", -2.5, 60.0), ("decimal(18,2)", 0, 99), ("date", 0, 400),
                                             ("timestamp_ntz", 0, 400), ("int", 7, 7)])
def test_ranges_are_disjoint_and_complete(spark, kind, low, high):
    from tidemark.sources.extract import cut_points, extract_in_ranges, range_predicates
    value = F.when(F.col("id") % 11 != 3, F.lit(low) + (F.col("id") * 37 % 101) / 100 * (high - low))
    if kind in ("date", "timestamp_ntz"):
        value = F.timestamp_add("HOUR", (value * 24).cast("int"), F.lit("2023-05-01").cast("timestamp_ntz"))
    df = spark.range(2000).select("id", value.cast(kind).alias("c"))
    if kind == "double":
        df = df.withColumn("c", F.when(F.col("id") % 50 == 1, float("nan")).otherwise(F.col("c")))
    df.createOrReplaceTempView("ranged")
    cuts = cut_points(df, "c", 8)
    preds = range_predicates("c", cuts)
    assert len(preds) == (len(cuts) + 2 if cuts else 2) and (len(cuts) == 7 or low == high)
    met = df.select(sum((F.expr(f"({p}) <=> true").cast("int") for p in preds), F.lit(0)).alias("n"))
    assert [r.n for r in met.distinct().collect()] == [1]
    got = extract_in_ranges(spark, "SELECT * FROM ranged -- all\n;", "c", 8)
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    sizes = [df.where(p).count() for p in preds[:-1]]
    assert low == high or max(sizes) < 2 * 2000 / 8


def test_range_options(spark, monkeypatch):
    from pyspark.sql import DataFrameReader
    from tidemark.sources.extract import extract_in_ranges, range_predicates
    with pytest.raises(ValueError, match="ascend"):
        range_predicates("c", [2, 1])
    with pytest.raises(ValueError, match="no range over str"):
        range_predicates("c", ["a"])
    assert range_predicates("c", []) == ["c IS NOT NULL", "c IS NULL"]
    assert range_predicates("d", [dt.date(2024, 1, 2)])[0] == "d < DATE '2024-01-02'"
    seen = {}
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **kw: seen.update(url=url, table=table, **kw) or spark.range(1))
    extract_in_ranges(spark, "SELECT * FROM t;", "c", cuts=[10], fmt="jdbc", options={"url": "jdbc:x", "fetchsize": "9"})
    assert seen["url"] == "jdbc:x" and seen["table"] == "(\nSELECT * FROM t\n) extract_ranges"
    assert seen["predicates"] == ["c < 10", "c >= 10", "c IS NULL"]
    queries = []
    monkeypatch.setattr("tidemark.sources.extract.extract_full", lambda s, q, f, o: queries.append(q) or spark.range(1))
    assert extract_in_ranges(spark, "SELECT * FROM t", "c", cuts=[10], fmt="warehouse").count() == 3
    assert queries[1] == "SELECT * FROM (\nSELECT * FROM t\n) extract_ranges WHERE c >= 10"
