import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.operators import facts as fx
from tidemark.operators import milestones as ml
from tidemark.plans.silver_job import silver_milestones

AS_OF = dt.datetime(2000, 1, 1)
D0 = dt.datetime(1999, 6, 1)

_INT = {"SHIPMENT_STATUS": T.IntegerType(), "ORDER_ID": T.LongType(), "SHIPMENT_ID_O": T.LongType()}
_STR = {"TC_PURCHASE_ORDERS_ID", "PO_TYPE", "SC_CT_SHIPMENT_ID", "TC_SHIPMENT_ID", "P_PO_NO", "PO_NO"}
M_SCHEMA = T.StructType([
    T.StructField(c, _INT.get(c, T.StringType() if c in _STR else T.TimestampNTZType()))
    for c in fx.MILESTONE_INPUT_COLUMNS])


def m_rows(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in fx.MILESTONE_INPUT_COLUMNS) for r in rows], M_SCHEMA)


def statuses(df, milestone):
    return {r.TC_PURCHASE_ORDERS_ID: r.ADHERENCE_STATUS for r in df.where(F.col("MILESTONE") == milestone).collect()}


def test_vendor_booked_boundaries(spark, thresholds):
    # INTERNATIONAL thresholds: G=20, A=10, R=10 (days before ship-not-after).
    sna = D0 + dt.timedelta(days=40)
    rows = [dict(TC_PURCHASE_ORDERS_ID=f"P{d}", PO_TYPE="INTERNATIONAL", SC_CT_SHIPMENT_ID="S",
                 SHIP_NOT_AFTER=sna, VENDOR_BOOKED_DATE=sna - dt.timedelta(days=d), PO_DATE=D0)
            for d in (21, 20, 19, 11, 10, 9)]
    got = statuses(ml.milestones(m_rows(spark, rows), thresholds, AS_OF), "VENDOR_BOOKED")
    assert got == {"P21": "GREEN", "P20": "GREEN", "P19": "AMBER", "P11": "AMBER", "P10": "AMBER", "P9": "RED"}


def test_threshold_gap_gives_null_status(spark):
    th = spark.createDataFrame([("INTERNATIONAL",) + (0,) * 17], T.StructType(
        [T.StructField("PO_TYPE", T.StringType())] +
        [T.StructField(c, T.IntegerType()) for c in ml.THRESHOLD_COLUMNS]))
    th = th.withColumn("VENDOR_BOOKED_G", F.lit(20)).withColumn("VENDOR_BOOKED_A", F.lit(10)) \
           .withColumn("VENDOR_BOOKED_R", F.lit(5))
    sna = D0 + dt.timedelta(days=40)
    rows = [dict(TC_PURCHASE_ORDERS_ID=f"P{d}", PO_TYPE="INTERNATIONAL", SC_CT_SHIPMENT_ID="S",
                 SHIP_NOT_AFTER=sna, VENDOR_BOOKED_DATE=sna - dt.timedelta(days=d), PO_DATE=D0) for d in (7, 4)]
    got = statuses(ml.milestones(m_rows(spark, rows), th, AS_OF), "VENDOR_BOOKED")
    assert got == {"P7": None, "P4": "RED"}


def test_received_age_rule(spark, thresholds):
    rows = [dict(TC_PURCHASE_ORDERS_ID=f"P{h}{'p' if pend else ''}", PO_TYPE="COLLECT",
                 PO_DATE=AS_OF - dt.timedelta(hours=h), P_PO_NO=("X" if pend else None))
            for h in (25, 26, 27) for pend in (False, True)]
    rows.append(dict(TC_PURCHASE_ORDERS_ID="FULL", PO_TYPE=None, PO_DATE=AS_OF, P_PO_NO="X",
                     PO_FULL_RCVD_DATE=D0, PO_RCVD_DATE=D0))
    ms = ml.milestones(m_rows(spark, rows), thresholds, AS_OF)
    got = sorted(r.TC_PURCHASE_ORDERS_ID for r in ms.where(F.col("MILESTONE") == "RECEIVED").collect())
    assert got == ["FULL", "P27"]
    full = ms.where(F.col("TC_PURCHASE_ORDERS_ID") == "FULL").first()
    assert full.ADHERENCE_STATUS is None and full.EXPECTED_ETA_FOR_MILESTONE is None


def test_created_always_green_without_delay(spark, thresholds):
    rows = [dict(TC_PURCHASE_ORDERS_ID="A", PO_TYPE=t, PO_DATE=D0, SC_CT_SHIPMENT_ID="S")
            for t in ("COLLECT", "PREPAID", "INTERNATIONAL")]
    rows = [dict(r, TC_PURCHASE_ORDERS_ID=r["PO_TYPE"]) for r in rows] + [
        dict(TC_PURCHASE_ORDERS_ID="N", PO_TYPE=None, PO_DATE=D0)]
    ms = ml.milestones(m_rows(spark, rows), thresholds, AS_OF).where(F.col("MILESTONE") == "CREATED")
    got = {r.TC_PURCHASE_ORDERS_ID: (r.ADHERENCE_STATUS, r.CURRENT_DELAY_IN_DAYS) for r in ms.collect()}
    assert got == {t: ("GREEN", None) for t in ("COLLECT", "PREPAID", "INTERNATIONAL")}


def test_first_amber_red_and_active(spark):
    ms = spark.createDataFrame(
        [("P", "S1", "COLLECT", 3, "MARKED_AS_READY", "AMBER"), ("P", "S1", "COLLECT", 5, "IN_TRANSIT", "AMBER"),
         ("P", "S1", "COLLECT", 4, "PLANNED", "RED"), ("P", "S2", "COLLECT", 5, "IN_TRANSIT", "GREEN"),
         ("Q", "S3", "COLLECT", 1, "CREATED", "GREEN")],
        "TC_PURCHASE_ORDERS_ID string, TC_SHIPMENT_ID string, PO_TYPE string, MILESTONE_RANK int, "
        "MILESTONE string, ADHERENCE_STATUS string")
    for c in ("EXPECTED_ETA_FOR_MILESTONE", "ACTUAL_ETA_FOR_MILESTONE", "NEXT_MILESTONE_EXPECTED_ETA",
              "REVISED_ETA_FOR_PO"):
        ms = ms.withColumn(c, F.lit(None).cast("timestamp_ntz"))
    ms = ms.withColumn("CURRENT_DELAY_IN_DAYS", F.lit(None).cast("bigint"))
    red = ml.silver(ms, AS_OF, "RED").collect()
    quirk = ml.silver(ms, AS_OF, "AMBER").collect()
    p = [r for r in red if r.ORDER_NO == "P"]
    assert {r.FIRST_MILESTONE_TO_AMBER for r in p} == {"MARKED_AS_READY"}
    assert {r.FIRST_MILESTONE_TO_RED for r in p} == {"PLANNED"}
    assert {r.FIRST_MILESTONE_TO_RED for r in quirk if r.ORDER_NO == "P"} == {"MARKED_AS_READY"}
    active = sorted((r.TC_SHIPMENT_ID, r.MILESTONE) for r in p if r.ACTIVE_STATUS == "ACTIVE")
    assert active == [("S1", "IN_TRANSIT"), ("S2", "IN_TRANSIT")]
    q = [r for r in red if r.ORDER_NO == "Q"]
    assert q[0].ACTIVE_STATUS == "ACTIVE" and q[0].FIRST_MILESTONE_TO_AMBER is None


@pytest.fixture(scope="module")
def silver_small(bronze):
    return silver_milestones(bronze, AS_OF, first_red_status="AMBER").cache()


def test_single_pass_equals_literal_union(bronze):
    m = fx.milestone_input(bronze)
    th = bronze.config_milestone_status
    a = ml.milestones(m, th, AS_OF)
    b = ml.milestones_by_union(m, th, AS_OF)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_silver_properties(silver_small):
    rows = silver_small.collect()
    assert rows
    rank = {n: i for i, n in enumerate(ml.MILESTONE_NAMES, start=1)}
    top = {}
    for r in rows:
        top[r.ORDER_NO] = max(top.get(r.ORDER_NO, 0), rank[r.MILESTONE])
        assert r.CURRENT_DELAY_IN_DAYS is None or r.CURRENT_DELAY_IN_DAYS >= 0
        if r.MILESTONE == "CREATED":
            assert r.ADHERENCE_STATUS == "GREEN" and r.CURRENT_DELAY_IN_DAYS is None
        if r.PO_TYPE is None:
            assert r.MILESTONE == "RECEIVED" and r.ADHERENCE_STATUS is None and r.RECORD_TYPE is None
    for r in rows:
        assert (r.ACTIVE_STATUS == "ACTIVE") == (rank[r.MILESTONE] == top[r.ORDER_NO])
    assert len(rows) == len(set(rows))
    assert silver_small.columns == [f.name for f in __import__("tidemark.schemas", fromlist=["x"]).SILVER_SCHEMA.fields]


def test_checkpointed_input_and_publish(spark, bronze):
    import uuid
    from tidemark.plans.silver_job import publish_silver
    a = silver_milestones(bronze, AS_OF, "AMBER", checkpoint_input=True)
    b = silver_milestones(bronze, AS_OF, "AMBER")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    name = f"silver_{uuid.uuid4().hex[:8]}"
    publish_silver(spark, bronze, name, AS_OF, "AMBER")
    publish_silver(spark, bronze, name, AS_OF, "AMBER")
    assert spark.table(name).count() == b.count()


def test_input_for_used_types_gives_the_same_milestones(bronze):
    """Fan-out limited to the PO types that use it: fewer rows in, same rows out."""
    from tidemark.operators.facts import milestone_input
    from tidemark.operators.milestones import milestones
    every, used = (milestone_input(bronze, used_only=u) for u in (False, True))
    assert used.count() < every.count()
    a, b = (milestones(m, bronze.config_milestone_status, "2000-01-01 00:00:00") for m in (every, used))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
