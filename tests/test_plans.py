"""Plan shape: thresholds broadcast, no cartesian products, filters pushed."""
import uuid

from pyspark.sql import functions as F

from tidemark.operators.milestones import silver
from tidemark.operators.skew import Heavy
from tidemark.plans.silver_job import milestone_table, milestone_table_by_union
from tidemark.operators.facts import po_context, po_orders, po_types, stops_of_shipment, tracking_of_shipment, with_shipment_facts
from tidemark.session import staged, staged_by
from tidemark.sources import bronze as br
from tidemark.sources.sinks import replace_table


def _bronze_tables(spark, bronze):
    names = {}
    for n, df in bronze.items():
        names[n] = f"pt_{n}_{uuid.uuid4().hex[:6]}"
        replace_table(spark, df, names[n])
    out = br.from_tables(spark, names)
    out.names = names
    return out


def test_silver_plan(spark, bronze):
    b = _bronze_tables(spark, bronze)
    b.stop_table, b.tracking_table = b.names["stop"], b.names["tracking_message"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = milestone_table(b, "2000-01-01 00:00:00")
        plan = df._jdf.queryExecution().executedPlan().toString()
        ms = staged(df.limit(100), "plan-test")
        table = [silver(ms, "2000-01-01 00:00:00", "AMBER", heavy)._jdf.queryExecution().executedPlan().toString()
                 for heavy in ((), [Heavy("PO1", 4)])]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The per-PO values come from an aggregate joined back: no task buffers a PO.
    assert not any("Window" in p for p in [plan, *table])
    assert all("partial_min" in p and "partial_max" in p for p in table)
    assert all("CartesianProduct" not in p and "NestedLoop" not in p for p in table)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # Only the checked threshold table is broadcast when automatic
    # broadcasting is off.
    assert plan.count("BroadcastExchange") == 1
    # Pushed filters reach the scans of the sources filtered by constants.
    low = plan.lower()
    assert "equalto(created_source,sap)" in low
    assert "equalto(field_name,status)" in low and "equalto(new_value,assig" in low
    assert "equalto(message_status,10)" in low
    # One Generate evaluates all seven milestone rules.
    assert plan.count("Generate inline(array(struct(EXPECTED_ETA_FOR_MILESTONE") == 1
    # Origin and destination lookups read the stop and tracking tables once.
    import re
    scans = re.findall(r"FileScan parquet \S+?\.(\w+)\[", plan)
    assert scans.count(b.stop_table) == 1 and scans.count(b.tracking_table) == 1


def _plan(spark, make):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_milestones_in_buckets_of_the_po_are_not_exchanged(spark, bronze):
    ms = staged_by(milestone_table(bronze, "2000-01-01 00:00:00").limit(300), "plan-test", "TC_PURCHASE_ORDERS_ID")
    assert "Exchange" not in _plan(spark, lambda: silver(ms, "2000-01-01 00:00:00"))
    assert ms.count() == 300 and not [t.name for t in spark.catalog.listTables() if t.name.startswith("tidemark_staged")]


def test_the_literal_union_reads_the_input_once_written(spark, bronze):
    plan = _plan(spark, lambda: milestone_table_by_union(bronze, "2000-01-01 00:00:00"))
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_shipment_facts_take_one_exchange_by_shipment(spark, bronze):
    plan = _plan(spark, lambda: with_shipment_facts(staged(po_orders(bronze), "po"), bronze))
    # of the PO frame: by shipment and by pickup order; it isn't unpivoted and grouped again
    assert plan.count("hashpartitioning(__lk") == 2 and "inline" not in plan


def test_po_context_exchanges_lines_and_po_rows_by_po_once(spark, bronze):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, lambda: po_context(bronze))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the rollups take the partitioning of the join; pickups meet the PO rows before they are rolled up
    assert plan.count("hashpartitioning(PO_NO") == 1 and plan.count("hashpartitioning(TC_PURCHASE_ORDERS_ID") == 1
    assert plan.count("hashpartitioning(__lk") == 3  # raw PO rows by pickup order, order links by order, order facts by shipment


def test_pickup_of_the_greatest_order_of_a_po(spark, bronze):
    row = bronze.purchase_orders.where("CREATED_SOURCE = 'SAP'").limit(1)
    ids = [("A", 1), ("A", 2), ("B", None), (None, 3), (None, 1)]
    keys = spark.createDataFrame(ids, "po string, id long")
    po = row.crossJoin(keys).withColumns({"TC_PURCHASE_ORDERS_ID": F.col("po"), "PURCHASE_ORDERS_ID": F.col("id")}).drop("po", "id")
    rli = spark.sql("select * from values (1L, timestamp_ntz'2001-01-01'), (1L, timestamp_ntz'2009-01-01'), "
                    "(3L, timestamp_ntz'2003-01-01'), (null, timestamp_ntz'2004-01-01') as t(ORDER_ID, PICKUP_END_DTTM)")
    got = {r.TC_PURCHASE_ORDERS_ID: r.PICKUP_END_DTTM and r.PICKUP_END_DTTM.year
           for r in po_types(po, bronze.export_order, rli).collect()}
    assert got == {"A": None, "B": None, None: 2003}


def test_maps_of_a_shipment_take_one_exchange(spark, bronze):
    for make in (lambda: stops_of_shipment(bronze.stop), lambda: tracking_of_shipment(bronze.tracking_message)):
        assert _plan(spark, make).count("Exchange hashpartitioning") == 1
