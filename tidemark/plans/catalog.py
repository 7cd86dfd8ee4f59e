"""Registered queries: one per operator of the inventory, each with its SQL.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame over the test tables in
``sf_dir`` (source views derived from them); ``ORACLE[name]`` is DuckDB SQL
over the raw tables giving the same rows.  Every query reads whole tables.
Fixed clocks keep results repeatable: the milestone clock is 2000-01-01 and
the ingest runs at 2024-01-20 18:00 UTC.
"""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import (add_days, add_hours, days_between, hours_between, keep_timestamp,
                         non_blank)
from ..functions.dates import batch_id, central_time
from ..functions.runinfo import run_info
from ..operators import facts as fx
from ..operators import milestones as ml
from ..operators import states
from ..operators.joins import left_join
from ..operators.skew import Heavy, heavy_keys, packed, split_left_join, stripes, stripes_by_pairs, unpacked
from ..session import staged, staged_by
from ..sources import bronze as br
from ..sources.control import example_control
from ..sources.extract import extract_full, extract_in_ranges, extract_incremental
from ..sources.merging import accumulate, read_merged, upsert
from ..sources.sinks import (append_run_log, compact_table, publish, replace_table, table_count, truncate_append,
                             with_audit_ts)
from . import oracle as o
from .ingest_job import ingest_all
from .refresh import refresh_silver
from .silver_job import milestone_table, milestone_table_by_union, silver_milestones

AS_OF = dt.datetime(2000, 1, 1)
INGEST_NOW_UTC = dt.datetime(2024, 1, 20, 18, 0, 0)
INGEST_JOB_START = "2024-01-20 12:00:00"        # the same instant in US Central
INGEST_BATCH = "20240120120000"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def bronze(spark: SparkSession, sf_dir: str) -> br.Bronze:
    return br.from_fixtures(spark, sf_dir)


def _uniq(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _dbl(*cols: str):
    return [F.col(c).cast("double").alias(c) for c in cols]


# ---------------------------------------------------------------- milestones

@query("m8_silver", o.silver_sql("amber"))
def m8_silver(spark, sf):
    """Flagship: the silver table as the original job writes it (its
    FIRST_MILESTONE_TO_RED looks for AMBER, quirk Q1)."""
    return silver_milestones(bronze(spark, sf), AS_OF, first_red_status="AMBER")


@query("m8_silver_red", o.silver_sql("red"))
def m8_silver_red(spark, sf):
    """Silver table with FIRST_MILESTONE_TO_RED looking for RED."""
    return silver_milestones(bronze(spark, sf), AS_OF, first_red_status="RED")


@query("m8_silver_literal", o.silver_sql("amber"))
def m8_silver_literal(spark, sf):
    """Silver table through the literal seven-branch union (comparison)."""
    ms = staged(milestone_table_by_union(bronze(spark, sf), AS_OF), "milestones")
    return ml.silver(ms, AS_OF, first_red_status="AMBER")


# A third of all control-tower lines, and their export orders, under one PO.
_HOT_PO = "(select concat('PO', cast(min(o_orderkey) as string)) from orders where o_orderkey%5=0 and o_orderkey%20<>7)"
_HOT_VIEWS = {n: br.fixtures.RECIPES[n].replace(
    "concat('PO',cast(o_orderkey as string)) " + column,
    f"case when o_orderkey%3=0 then {_HOT_PO} else concat('PO',cast(o_orderkey as string)) end {column}")
    for n, column in (("ct_shipment", "tsc_po_no"), ("export_order", "sc_exp_po_no"))}


@query("m8_silver_hot_po", o.silver_sql("red", _HOT_VIEWS))
def m8_silver_hot_po(spark, sf):
    """The silver table where one PO holds a third of all control-tower lines: the
    PO is found by counting and split."""
    frames = br.fixtures.register_views(spark, sf) | {n: spark.sql(text) for n, text in _HOT_VIEWS.items()}
    b = br.from_frames({n: br.as_delivered(n, df) for n, df in frames.items()})
    heavy = fx.heavy_pos(b, 20, 20)
    assert len(heavy) == 1
    return silver_milestones(b, AS_OF, first_red_status="RED", heavy=heavy)


_MS = f"SELECT {o.MILESTONE_SELECT} FROM ms"


@query("k1_milestones", o.sql(_MS, "ms"))
def k1_milestones(spark, sf):
    return milestone_table(bronze(spark, sf), AS_OF)


@query("k1_union_distinct", o.sql(_MS, "ms"))
def k1_union_distinct(spark, sf):
    return milestone_table_by_union(bronze(spark, sf), AS_OF)


def _branch_query(name: str, key: str):
    def fn(spark, sf):
        b = bronze(spark, sf)
        return ml.milestone_branch(fx.milestone_input(b), b.config_milestone_status, name, AS_OF)
    fn.__name__ = key
    body = f"SELECT {o.MILESTONE_SELECT} FROM judged WHERE step = {o.STEPS.index(name) + 1}"
    query(key, o.sql(body, "judged"))(fn)


for _i, _n in enumerate(ml.MILESTONE_NAMES, start=1):
    _branch_query(_n, f"m{_i}_{_n.lower()}")


def _first_sql(colour: str, alias: str) -> str:
    return o.sql(f"SELECT po AS ORDER_NO, {o.step_name(colour)} AS {alias} FROM per_po", "per_po")


@query("k2_first_amber", _first_sql("amber", "FIRST_MILESTONE_TO_AMBER"))
def k2_first_amber(spark, sf):
    ms = milestone_table(bronze(spark, sf), AS_OF)
    return ml.first_status_by_po(ms, "AMBER", "FIRST_MILESTONE_TO_AMBER")


@query("k2_first_red", _first_sql("red", "FIRST_MILESTONE_TO_RED"))
def k2_first_red(spark, sf):
    ms = milestone_table(bronze(spark, sf), AS_OF)
    return ml.first_status_by_po(ms, "RED", "FIRST_MILESTONE_TO_RED")


@query("k3_active_status", o.sql("""
SELECT s.po AS ORDER_NO, milestone AS MILESTONE, unit AS TC_SHIPMENT_ID, if(step = top, 'ACTIVE', 'INACTIVE') AS ACTIVE_STATUS
FROM ms s LEFT JOIN per_po p ON p.po = s.po""", "ms", "per_po"))
def k3_active_status(spark, sf):
    ms = staged_by(milestone_table(bronze(spark, sf), AS_OF), "milestones", "TC_PURCHASE_ORDERS_ID")
    return ml.silver(ms, AS_OF).select("ORDER_NO", "MILESTONE", "TC_SHIPMENT_ID", "ACTIVE_STATUS")


@query("m8_refresh", o.silver_sql("red"))
def m8_refresh(spark, sf):
    """The silver table from a first run over what was there at some time and a
    refresh of the POs that later rows of six sources affect."""
    b = br.from_fixtures(spark, sf, by_order=True)  # the orders and their lines are joined some twenty times
    late = {"tracking_message": F.col("EVENT_DTTM") >= "1997-01-01", "stop": F.col("ARRIVAL_START_DTTM") >= "1997-06-01",
            "shipment_event": F.col("CREATED_DTTM") >= "1997-03-01", "asn": F.col("ACTUAL_SHIPPED_DTTM") >= "1997-05-01",
            "ct_shipment_event": F.col("EVENT_TS") >= "1997-02-01", "purchase_order_line": F.col("DELIV_DATE") >= "1998-01-01"}
    before = br.Bronze(b | {n: b[n].where(~F.coalesce(cond, F.lit(False))) for n, cond in late.items()})
    name = _uniq("silver_kept")
    refresh_silver(spark, before, name, "20240119120000", AS_OF)
    done = refresh_silver(spark, b, name, INGEST_BATCH, AS_OF, {n: b[n].where(cond) for n, cond in late.items()}, AS_OF)
    assert not done.skipped
    return read_merged(spark, name)


# ---------------------------------------------------------------- facts (M0*)

@query("m0_po_type", o.sql("""
SELECT tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID, po_type AS PO_TYPE,
       d_facility_alias_id AS D_FACILITY_ALIAS_ID, business_partner_id AS BUSINESS_PARTNER_ID,
       d_city AS D_CITY, d_country_code AS D_COUNTRY_CODE, o_country_code AS O_COUNTRY_CODE,
       billing_method AS BILLING_METHOD, o_city AS O_CITY, o_state_prov AS O_STATE_PROV,
       purchase_orders_id AS PURCHASE_ORDERS_ID, last_updated_dttm AS LAST_UPDATED_DTTM,
       created_dttm AS CREATED_DTTM FROM po_kind""", "po_kind"))
def m0_po_type(spark, sf):
    b = bronze(spark, sf)
    return fx.po_types(b.purchase_orders, b.export_order).select(
        "TC_PURCHASE_ORDERS_ID", "PO_TYPE", "D_FACILITY_ALIAS_ID", "BUSINESS_PARTNER_ID", "D_CITY",
        "D_COUNTRY_CODE", "O_COUNTRY_CODE", "BILLING_METHOD", "O_CITY", "O_STATE_PROV",
        "PURCHASE_ORDERS_ID", "LAST_UPDATED_DTTM", "CREATED_DTTM")


_POL_COLS = ("PO_NO", "PO_TRACKING_NO", "FREIGHT_TYPE_CODE", "PO_LINE_MOVE_TYPE_CODE", "DELIV_DATE",
             "SHIP_START_DATE", "SHIP_END_DATE", "DELIV_START_DATE", "DELIV_END_DATE", "PO_RCVD_DATE",
             "PO_FULL_RCVD_DATE")
_POL_NUM = ("MONETARY_VALUE", "ORDER_QTY", "RCVD_QTY", "PO_WEIGHT", "PO_VOLUME")


def _sel_sql(cols, num=()):
    return ", ".join([f"{c.lower()} AS {c}" for c in cols] +
                     [f"CAST({c.lower()} AS DOUBLE) AS {c}" for c in num])


@query("m0b_po_lines", o.sql(f"SELECT {_sel_sql(_POL_COLS, _POL_NUM)} FROM line_group", "line_group"))
def m0b_po_lines(spark, sf):
    return fx.po_line_rollup(bronze(spark, sf).purchase_order_line).select(*_POL_COLS, *_dbl(*_POL_NUM))


_CTS_COLS = ("PO", "SC_CT_SHIPMENT_ID", "VENDOR_BOOKED_DATE", "CARGO_READY_DATE",
             "SC_CT_SHIPMENT_START_DATE", "SHIP_NOT_AFTER", "SHIP_NOT_BEFORE")


@query("m0c_ct_shipments", o.sql(f"SELECT {_sel_sql(_CTS_COLS)} FROM ct_unit", "ct_unit"))
def m0c_ct_shipments(spark, sf):
    b = bronze(spark, sf)
    return fx.ct_shipment_rollup(b.ct_shipment, b.export_order).select(*_CTS_COLS)


_A_COLS = ("TC_PURCHASE_ORDERS_ID", "PO_TYPE", "O_FACILITY_ALIAS_ID", "D_FACILITY_ALIAS_ID",
           "SHIPMENT_ID", "TC_SHIPMENT_ID", "BUSINESS_PARTNER_ID", "PO_TRACKING_NO", "PO_DATE",
           "D_CITY", "D_COUNTRY_CODE", "O_COUNTRY_CODE", "BILLING_METHOD", "PO_RCVD_DATE",
           "SHIPMENT_ID_O", "SHIPMENT_STATUS", "STATUS_CHANGE_DTTM", "ORDER_ID", "CREATED_DTTM",
           "SHIP_END_DATE", "DELIV_DATE", "DELIV_START_DATE", "DELIV_END_DATE", "SHIP_START_DATE",
           "O_CITY", "O_STATE_PROV", "TRAILER_NUMBER", "FREIGHT_TYPE_CODE", "PO_LINE_MOVE_TYPE_CODE",
           "PICKUP_END_DTTM", "PO_NO", "PO_FULL_RCVD_DATE", "LAST_UPDATED_DTTM")
_A_NUM = ("PO_WEIGHT", "PO_VOLUME", "ORDER_QTY", "MONETARY_VALUE")


@query("m0f_po_context", o.sql(f"SELECT {_sel_sql(_A_COLS, _A_NUM)} FROM context", "context"))
def m0f_po_context(spark, sf):
    return fx.po_context(bronze(spark, sf)).select(*_A_COLS, *_dbl(*_A_NUM))


@query("m0j_milestone_input", o.sql(f"SELECT {_sel_sql(fx.MILESTONE_INPUT_COLUMNS)} FROM watch", "watch"))
def m0j_milestone_input(spark, sf):
    return fx.milestone_input(bronze(spark, sf))


# ---------------------------------------------------------------- aggregates

@query("a1_group_max", o.sql("""SELECT shipment_id AS SHIPMENT_ID, shipment_status AS SHIPMENT_STATUS,
  status_change_dttm AS STATUS_CHANGE_DTTM, trailer_number AS TRAILER_NUMBER FROM ship_now""", "ship_now"))
def a1_group_max(spark, sf):
    return fx.shipment_status(bronze(spark, sf).tlm_shipment)


@query("a2_group_min", o.sql("""SELECT sc_exp_po_no AS PO, min(vendor_booked_date) AS FIRST_VENDOR_BOOKED,
  min(cargo_ready_date) AS FIRST_CARGO_READY FROM export_order GROUP BY sc_exp_po_no""", "export_order"))
def a2_group_min(spark, sf):
    return bronze(spark, sf).export_order.groupBy(F.col("SC_EXP_PO_NO").alias("PO")).agg(
        F.min("VENDOR_BOOKED_DATE").alias("FIRST_VENDOR_BOOKED"),
        F.min("CARGO_READY_DATE").alias("FIRST_CARGO_READY"))


@query("a3_sum_product", o.sql("""SELECT po_no AS PO_NO,
  CAST(sum(po_line_unit_price * po_line_order_qty) AS DOUBLE) AS MONETARY_VALUE,
  CAST(sum(po_line_order_qty) AS DOUBLE) AS ORDER_QTY, CAST(sum(po_line_rcvd_qty) AS DOUBLE) AS RCVD_QTY
  FROM purchase_order_line GROUP BY po_no""", "purchase_order_line"))
def a3_sum_product(spark, sf):
    pol = bronze(spark, sf).purchase_order_line
    return pol.groupBy("PO_NO").agg(
        F.sum(F.col("PO_LINE_UNIT_PRICE") * F.col("PO_LINE_ORDER_QTY")).cast("double").alias("MONETARY_VALUE"),
        F.sum("PO_LINE_ORDER_QTY").cast("double").alias("ORDER_QTY"),
        F.sum("PO_LINE_RCVD_QTY").cast("double").alias("RCVD_QTY"))


@query("a4_any_value", o.sql("""SELECT tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID,
  max(d_country_code) AS D_COUNTRY_CODE, max(o_country_code) AS O_COUNTRY_CODE
  FROM purchase_orders WHERE created_source = 'SAP' GROUP BY tc_purchase_orders_id""", "purchase_orders"))
def a4_any_value(spark, sf):
    """ANY_VALUE taken as MAX: one legal answer, repeatable run to run."""
    po = bronze(spark, sf).purchase_orders.where(F.col("CREATED_SOURCE") == "SAP")
    return po.groupBy("TC_PURCHASE_ORDERS_ID").agg(F.max("D_COUNTRY_CODE").alias("D_COUNTRY_CODE"),
                                                   F.max("O_COUNTRY_CODE").alias("O_COUNTRY_CODE"))


@query("a5_distinct", o.sql("SELECT po_no AS PO_NO FROM waiting", "waiting"))
def a5_distinct(spark, sf):
    return fx.pending_pos(bronze(spark, sf).pending_po_line)


@query("a6_conditional_max", o.sql("""SELECT ct_shipment_id AS CT_SHIPMENT_ID, cob_ts AS COB_TS,
  carrier_drop_ts AS CARRIER_DROP_TS FROM ct_times""", "ct_times"))
def a6_conditional_max(spark, sf):
    return fx.ct_event_times(bronze(spark, sf).ct_shipment_event)


@query("a7_stop_times", o.sql("""SELECT DISTINCT tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID,
  shipment_id AS SHIPMENT_ID, origin_departure_dttm AS ORIGIN_DEPARTURE_DTTM,
  destination_arrival_dttm AS DESTINATION_ARRIVAL_DTTM, origin_stop AS ORIGIN_STOP, dest_stop AS DEST_STOP
  FROM route""", "route"))
def a7_stop_times(spark, sf):
    b = bronze(spark, sf)
    po = fx.po_orders(b)
    return fx.route_times(po, b.stop, b.tracking_message).join(
        po.select("TC_PURCHASE_ORDERS_ID", "SHIPMENT_ID"), "TC_PURCHASE_ORDERS_ID").select(
        "TC_PURCHASE_ORDERS_ID", "SHIPMENT_ID", "ORIGIN_DEPARTURE_DTTM", "DESTINATION_ARRIVAL_DTTM",
        "ORIGIN_STOP", "DEST_STOP")


@query("a8_max_if_complete", o.sql("""SELECT po_no AS PO_NO, po_tracking_no AS PO_TRACKING_NO,
  freight_type_code AS FREIGHT_TYPE_CODE, po_line_move_type_code AS PO_LINE_MOVE_TYPE_CODE,
  po_rcvd_date AS PO_RCVD_DATE, po_full_rcvd_date AS PO_FULL_RCVD_DATE FROM line_group""", "line_group"))
def a8_max_if_complete(spark, sf):
    return fx.po_line_rollup(bronze(spark, sf).purchase_order_line).select(
        *fx.PO_LINE_KEYS, "PO_RCVD_DATE", "PO_FULL_RCVD_DATE")


@query("a8_merged_state", o.sql(f"SELECT {_sel_sql(_POL_COLS, _POL_NUM)} FROM line_group", "line_group"))
def a8_merged_state(spark, sf):
    """The PO line rollup from stored states: earlier lines first, later ones merged in."""
    lines = bronze(spark, sf).purchase_order_line
    early = F.coalesce(F.col("PO_LINE_MAX_RCVD_DATE") < "1996-01-01", F.lit(False))
    name = _uniq("line_state")
    for batch, increment in (("20240119120000", lines.where(early)), (INGEST_BATCH, lines.where(~early)),
                             (INGEST_BATCH, lines.where(~early))):  # the second batch twice, as after a failure
        accumulate(spark, increment, name, fx.PO_LINE_KEYS, fx.PO_LINE_AGGS, batch)
    return states.finish(read_merged(spark, name), fx.PO_LINE_KEYS, fx.PO_LINE_AGGS).select(*_POL_COLS, *_dbl(*_POL_NUM))


@query("a6_merged_state", o.sql("""SELECT ct_shipment_id AS CT_SHIPMENT_ID, cob_ts AS COB_TS,
  carrier_drop_ts AS CARRIER_DROP_TS FROM ct_times""", "ct_times"))
def a6_merged_state(spark, sf):
    """Event times per shipment from the states of two increments."""
    events, keys = bronze(spark, sf).ct_shipment_event, ("SC_CT_SHIPMENT_ID",)
    early = F.col("EVENT_TS") < "1996-01-01"
    parts = [states.partial(events.where(cond), keys, fx.CT_EVENT_AGGS) for cond in (early, ~early)]
    return states.finish(states.merge(parts, keys, fx.CT_EVENT_AGGS), keys, fx.CT_EVENT_AGGS) \
        .withColumnRenamed("SC_CT_SHIPMENT_ID", "CT_SHIPMENT_ID")


@query("a9_multi_key", o.sql("""SELECT shipment_id AS SHIPMENT_ID, stop_seq AS STOP_SEQ,
  message_status AS MESSAGE_STATUS, message_type AS MESSAGE_TYPE, event_dttm AS EVENT_DTTM FROM heard""", "heard"))
def a9_multi_key(spark, sf):
    return fx.tracking_rollup(bronze(spark, sf).tracking_message)


@query("a10_group_alias", o.sql("""SELECT po AS PO, sku AS SKU, ship_not_after AS SHIP_NOT_AFTER,
  ship_not_before AS SHIP_NOT_BEFORE, vendor_booked_date AS VENDOR_BOOKED_DATE,
  cargo_ready_date AS CARGO_READY_DATE FROM export_sku""", "export_sku"))
def a10_group_alias(spark, sf):
    return fx.export_article_rollup(bronze(spark, sf).export_order)


@query("a13_filtered_max", o.sql("SELECT shipment_id AS SHIPMENT_ID, planned_time AS PLANNED_TIME FROM assigned", "assigned"))
def a13_filtered_max(spark, sf):
    return fx.planned_times(bronze(spark, sf).shipment_event)


# ---------------------------------------------------------------- joins

@query("j1_left_equi", o.sql("""SELECT t.tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID, t.po_type AS PO_TYPE,
  r.shipment_id AS SHIPMENT_ID, r.tc_shipment_id AS TC_SHIPMENT_ID, r.order_id AS ORDER_ID,
  r.o_facility_alias_id AS O_FACILITY_ALIAS_ID
  FROM po_kind t LEFT JOIN linked r ON t.tc_purchase_orders_id = r.tc_master_order_id""", "po_kind", "linked"))
def j1_left_equi(spark, sf):
    return fx.po_orders(bronze(spark, sf)).select(
        "TC_PURCHASE_ORDERS_ID", "PO_TYPE", "SHIPMENT_ID", "TC_SHIPMENT_ID", "ORDER_ID", "O_FACILITY_ALIAS_ID")


@query("j2_left_fanout", o.sql("""SELECT t.tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID, t.po_type AS PO_TYPE,
  l.po_tracking_no AS PO_TRACKING_NO, l.freight_type_code AS FREIGHT_TYPE_CODE,
  l.po_line_move_type_code AS PO_LINE_MOVE_TYPE_CODE, l.deliv_date AS DELIV_DATE
  FROM po_kind t LEFT JOIN line_group l ON t.tc_purchase_orders_id = l.po_no""", "po_kind", "line_group"))
def j2_left_fanout(spark, sf):
    b = bronze(spark, sf)
    tpo = fx.po_types(b.purchase_orders, b.export_order).select("TC_PURCHASE_ORDERS_ID", "PO_TYPE")
    pol = fx.po_line_rollup(b.purchase_order_line).select(*fx.PO_LINE_KEYS, "DELIV_DATE")
    return left_join(tpo, pol, [("TC_PURCHASE_ORDERS_ID", "PO_NO")], spread_null_keys=False).select(
        "TC_PURCHASE_ORDERS_ID", "PO_TYPE", "PO_TRACKING_NO", "FREIGHT_TYPE_CODE",
        "PO_LINE_MOVE_TYPE_CODE", "DELIV_DATE")


_CTJ = ("SC_CT_SHIPMENT_ID", "TSC_PO_NO", "ARTICLE_NO", "SHIPMENT_START_DATE", "PO", "SKU",
        "SHIP_NOT_AFTER", "SHIP_NOT_BEFORE", "VENDOR_BOOKED_DATE", "CARGO_READY_DATE")


@query("j2_heavy_split", """SELECT c_custkey, c_nationkey, s_suppkey FROM customer
  LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey <> 3) ON c_nationkey = s_nationkey""")
def j2_heavy_split(spark, sf):
    """A fan-out in which nearly every key is heavy, one of them without a match."""
    left = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_nationkey")
    right = spark.read.parquet(f"{sf}/supplier.parquet").where("s_nationkey <> 3").select("s_suppkey", "s_nationkey")
    keys, bound = heavy_keys(left, "c_nationkey", 10, 30)
    heavy = stripes_by_pairs(left, "c_nationkey", right, "s_nationkey", [Heavy(k, stripes(2 * bound, bound), 3) for k in keys])
    hot = F.col("c_nationkey").isin(keys)
    on = [("c_nationkey", "s_nationkey")]
    split = split_left_join(left.where(hot), right.where(F.col("s_nationkey").isin(keys)), on, heavy, pack=True)
    return unpacked(split.unionByName(left_join(left.where(~hot), packed(right, ["s_nationkey"]), on)))


@query("j3_left_two_keys", o.sql(f"SELECT {_sel_sql(_CTJ)} FROM ct_line", "ct_line"))
def j3_left_two_keys(spark, sf):
    b = bronze(spark, sf)
    return fx.ct_lines_with_export(b.ct_shipment, b.export_order).select(*_CTJ)


@query("j4_left_on_literals", o.sql("""SELECT s.shipment_id AS SHIPMENT_ID, s.facility_alias_id AS FACILITY_ALIAS_ID,
  s.stop_seq AS STOP_SEQ, t.event_dttm AS DEPARTED_DTTM
  FROM stop s LEFT JOIN heard t ON s.shipment_id = t.shipment_id AND t.stop_seq = s.stop_seq
       AND t.message_type = 50 AND t.message_status = 10""", "stop", "heard"))
def j4_left_on_literals(spark, sf):
    """Constants for the right side in ON: filter the right, then LEFT join."""
    b = bronze(spark, sf)
    t = fx.tracking_rollup(b.tracking_message).where(
        (F.col("MESSAGE_TYPE") == fx.DEPARTED) & (F.col("MESSAGE_STATUS") == fx.MSG_OK))
    t = t.select("SHIPMENT_ID", "STOP_SEQ", F.col("EVENT_DTTM").alias("DEPARTED_DTTM"))
    s = b.stop.select("SHIPMENT_ID", "FACILITY_ALIAS_ID", "STOP_SEQ")
    return left_join(s, t, [("SHIPMENT_ID", "SHIPMENT_ID"), ("STOP_SEQ", "STOP_SEQ")])


@query("j5_double_join", o.sql("""SELECT s.shipment_id AS SHIPMENT_ID, s.facility_alias_id AS FACILITY_ALIAS_ID,
  s.stop_seq AS STOP_SEQ, t1.event_dttm AS DEPARTED_DTTM, t2.event_dttm AS ON_YARD_DTTM
  FROM stop s
  LEFT JOIN heard t1 ON s.shipment_id = t1.shipment_id AND t1.stop_seq = s.stop_seq
       AND t1.message_type = 50 AND t1.message_status = 10
  LEFT JOIN heard t2 ON s.shipment_id = t2.shipment_id AND t2.stop_seq = s.stop_seq
       AND t2.message_type = 45 AND t2.message_status = 10""", "stop", "heard"))
def j5_double_join(spark, sf):
    """The relation joined twice under two aliases, as one conditional
    aggregate joined once."""
    b = bronze(spark, sf)
    s = b.stop.select("SHIPMENT_ID", "FACILITY_ALIAS_ID", "STOP_SEQ")
    return left_join(s, fx.tracking_by_stop(b.tracking_message),
                     [("SHIPMENT_ID", "SHIPMENT_ID"), ("STOP_SEQ", "STOP_SEQ")])


@query("j6_exists_flag", o.sql("""SELECT p.tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID,
  max(e.sc_exp_po_no) IS NOT NULL AS HAS_EXPORT
  FROM purchase_orders p LEFT JOIN exported e ON e.sc_exp_po_no = p.tc_purchase_orders_id
  GROUP BY p.tc_purchase_orders_id""", "purchase_orders", "exported"))
def j6_exists_flag(spark, sf):
    from ..operators.joins import exists_flag
    b = bronze(spark, sf)
    pos = b.purchase_orders.select("TC_PURCHASE_ORDERS_ID").distinct()
    return exists_flag(pos, fx.export_po_keys(b.export_order), "TC_PURCHASE_ORDERS_ID",
                       "SC_EXP_PO_NO", "HAS_EXPORT")


@query("j6_anti", o.sql("""SELECT t.tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID FROM po_kind t
  LEFT JOIN waiting p ON p.po_no = t.tc_purchase_orders_id WHERE p.po_no IS NULL""", "po_kind", "waiting"))
def j6_anti(spark, sf):
    """POs without a pending line: a left_anti join (NOT EXISTS)."""
    b = bronze(spark, sf)
    tpo = fx.po_types(b.purchase_orders, b.export_order).select("TC_PURCHASE_ORDERS_ID")
    return tpo.join(fx.pending_pos(b.pending_po_line),
                    F.col("TC_PURCHASE_ORDERS_ID") == F.col("PO_NO"), "left_anti")


@query("j7_broadcast_dim", o.sql("""SELECT t.tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID, t.po_type AS PO_TYPE,
  c.vendor_booked_g AS VENDOR_BOOKED_G, c.in_transit_g AS IN_TRANSIT_G, c.on_yard_a AS ON_YARD_A,
  c.received_r AS RECEIVED_R
  FROM po_kind t LEFT JOIN config_milestone_status c ON t.po_type = c.po_type""", "po_kind", "config_milestone_status"))
def j7_broadcast_dim(spark, sf):
    b = bronze(spark, sf)
    tpo = fx.po_types(b.purchase_orders, b.export_order).select("TC_PURCHASE_ORDERS_ID", "PO_TYPE")
    return ml.with_thresholds(tpo, b.config_milestone_status).select(
        "TC_PURCHASE_ORDERS_ID", "PO_TYPE", "VENDOR_BOOKED_G", "IN_TRANSIT_G", "ON_YARD_A", "RECEIVED_R")


@query("j8_join_then_group", o.sql("""SELECT tc_master_order_id AS TC_MASTER_ORDER_ID,
  o_facility_alias_id AS O_FACILITY_ALIAS_ID, shipment_id AS SHIPMENT_ID, tc_shipment_id AS TC_SHIPMENT_ID,
  order_id AS ORDER_ID, created_dttm AS CREATED_DTTM FROM linked""", "linked"))
def j8_join_then_group(spark, sf):
    b = bronze(spark, sf)
    return fx.master_order_rollup(b.order_master_order, b.tlm_orders)


@query("p2_star_plus", o.sql("""SELECT tc_master_order_id AS TC_MASTER_ORDER_ID, order_id AS ORDER_ID,
  o_facility_alias_id AS O_FACILITY_ALIAS_ID, shipment_id AS SHIPMENT_ID, tc_shipment_id AS TC_SHIPMENT_ID,
  created_dttm AS CREATED_DTTM FROM linked_order""", "linked_order"))
def p2_star_plus(spark, sf):
    b = bronze(spark, sf)
    return fx.master_order_lines(b.order_master_order, b.tlm_orders)


# ---------------------------------------------------------------- projections, predicates

@query("p1_project", o.sql("""SELECT tc_purchase_orders_id AS ORDER_NO, created_dttm AS PO_DATE,
  o_facility_alias_id AS ORIGIN_FACILITY, d_facility_alias_id AS DESTINATION_FACILITY,
  business_partner_id AS VENDOR_ID FROM purchase_orders""", "purchase_orders"))
def p1_project(spark, sf):
    return bronze(spark, sf).purchase_orders.select(
        F.col("TC_PURCHASE_ORDERS_ID").alias("ORDER_NO"), F.col("CREATED_DTTM").alias("PO_DATE"),
        F.col("O_FACILITY_ALIAS_ID").alias("ORIGIN_FACILITY"),
        F.col("D_FACILITY_ALIAS_ID").alias("DESTINATION_FACILITY"),
        F.col("BUSINESS_PARTNER_ID").alias("VENDOR_ID"))


@query("p3_lateral_alias", o.sql(f"""SELECT sc_exp_po_no AS SC_EXP_PO_NO, article_no AS ARTICLE_NO,
  e AS EXPECTED_ETA, a AS ACTUAL_ETA, dl AS CURRENT_DELAY_IN_DAYS, {o.dd('dl', 'ship_not_after')} AS REVISED_ETA
  FROM (SELECT *, CASE WHEN {o.ddiff('e', 'a')} > 0 THEN {o.ddiff('e', 'a')}
                       WHEN {o.ddiff('e', 'a')} <= 0 THEN 0 END dl
        FROM (SELECT *, {o.dd('-20', 'ship_not_after')} e, vendor_booked_date a FROM export_order) q0) q1""",
                                  "export_order"))
def p3_lateral_alias(spark, sf):
    """Later items use earlier aliases: chained ``withColumns`` steps."""
    x = bronze(spark, sf).export_order.withColumns({
        "EXPECTED_ETA": add_days(-20, F.col("SHIP_NOT_AFTER")),
        "ACTUAL_ETA": F.col("VENDOR_BOOKED_DATE")})
    d = days_between(F.col("EXPECTED_ETA"), F.col("ACTUAL_ETA"))
    x = x.withColumn("CURRENT_DELAY_IN_DAYS", F.when(d > 0, d).when(d <= 0, F.lit(0).cast("bigint")))
    x = x.withColumn("REVISED_ETA", add_days(F.col("CURRENT_DELAY_IN_DAYS"), F.col("SHIP_NOT_AFTER")))
    return x.select("SC_EXP_PO_NO", "ARTICLE_NO", "EXPECTED_ETA", "ACTUAL_ETA", "CURRENT_DELAY_IN_DAYS",
                    "REVISED_ETA")


@query("p4_filter_eq", o.sql("""SELECT tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID, billing_method AS BILLING_METHOD
  FROM purchase_orders WHERE created_source = 'SAP'""", "purchase_orders"))
def p4_filter_eq(spark, sf):
    return bronze(spark, sf).purchase_orders.where(F.col("CREATED_SOURCE") == "SAP").select(
        "TC_PURCHASE_ORDERS_ID", "BILLING_METHOD")


@query("p5_filter_and", o.sql("""SELECT shipment_id AS SHIPMENT_ID, created_dttm AS CREATED_DTTM
  FROM shipment_event WHERE field_name = 'STATUS' AND new_value = 'Assigned'""", "shipment_event"))
def p5_filter_and(spark, sf):
    se = bronze(spark, sf).shipment_event
    return se.where((F.col("FIELD_NAME") == "STATUS") & (F.col("NEW_VALUE") == "Assigned")).select(
        "SHIPMENT_ID", "CREATED_DTTM")


@query("p6_not_and_null", o.sql("""SELECT t.tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID, t.po_type AS PO_TYPE,
  x.sc_ct_shipment_id AS SC_CT_SHIPMENT_ID
  FROM po_kind t LEFT JOIN ct_unit x ON t.tc_purchase_orders_id = x.po
  WHERE NOT (t.po_type = 'INTERNATIONAL' AND x.sc_ct_shipment_id IS NULL)""", "po_kind", "ct_unit"))
def p6_not_and_null(spark, sf):
    from ..functions import drop_unshipped_international
    b = bronze(spark, sf)
    tpo = fx.po_types(b.purchase_orders, b.export_order).select("TC_PURCHASE_ORDERS_ID", "PO_TYPE")
    cts = fx.ct_shipment_rollup(b.ct_shipment, b.export_order, keep_unmatched=False).select(
        "PO", "SC_CT_SHIPMENT_ID")
    x = left_join(tpo, cts, [("TC_PURCHASE_ORDERS_ID", "PO")], spread_null_keys=False)
    return x.where(drop_unshipped_international("PO_TYPE", "SC_CT_SHIPMENT_ID"))


@query("p7_non_blank", o.sql("""SELECT o_country_code AS O_COUNTRY_CODE, count(*) AS N FROM purchase_orders
  WHERE o_country_code IS NOT NULL AND o_country_code <> '' GROUP BY o_country_code""", "purchase_orders"))
def p7_non_blank(spark, sf):
    po = bronze(spark, sf).purchase_orders
    return po.where(non_blank("O_COUNTRY_CODE")).groupBy("O_COUNTRY_CODE").agg(F.count(F.lit(1)).alias("N"))


@query("p8_in_list", o.sql("""SELECT shipment_id AS SHIPMENT_ID, shipment_status AS SHIPMENT_STATUS
  FROM tlm_shipment WHERE shipment_status IN (60, 70, 80, 90)""", "tlm_shipment"))
def p8_in_list(spark, sf):
    sh = bronze(spark, sf).tlm_shipment
    return sh.where(F.col("SHIPMENT_STATUS").isin(*ml.PLANNED_SHIPMENT_STATUSES)).select(
        "SHIPMENT_ID", "SHIPMENT_STATUS")


@query("p8_in_list_text", o.sql("""SELECT sc_ct_shipment_id AS SC_CT_SHIPMENT_ID, event_code AS EVENT_CODE
  FROM ct_shipment_event WHERE event_code IN ('CARRDROP', 'DROP')""", "ct_shipment_event"))
def p8_in_list_text(spark, sf):
    ev = bronze(spark, sf).ct_shipment_event
    return ev.where(F.col("EVENT_CODE").isin(*fx.CARRIER_DROP_CODES)).select("SC_CT_SHIPMENT_ID", "EVENT_CODE")


@query("p9_compare", o.sql("""SELECT po_no AS PO_NO, po_line_max_rcvd_date < deliv_date AS LT,
  po_line_max_rcvd_date <= deliv_date AS LE, po_line_max_rcvd_date = deliv_date AS EQ,
  po_line_max_rcvd_date <> deliv_date AS NE, po_line_max_rcvd_date > deliv_date AS GT,
  po_line_max_rcvd_date >= deliv_date AS GE FROM purchase_order_line""", "purchase_order_line"))
def p9_compare(spark, sf):
    a, b_ = F.col("PO_LINE_MAX_RCVD_DATE"), F.col("DELIV_DATE")
    return bronze(spark, sf).purchase_order_line.select(
        "PO_NO", (a < b_).alias("LT"), (a <= b_).alias("LE"), (a == b_).alias("EQ"),
        (a != b_).alias("NE"), (a > b_).alias("GT"), (a >= b_).alias("GE"))


@query("p10_null_tests", o.sql("""SELECT freight_type_code AS FREIGHT_TYPE_CODE,
  count(*) FILTER (WHERE po_line_max_rcvd_date IS NULL) AS N_NULL,
  count(*) FILTER (WHERE po_line_max_rcvd_date IS NOT NULL) AS N_SET
  FROM purchase_order_line GROUP BY freight_type_code""", "purchase_order_line"))
def p10_null_tests(spark, sf):
    c = F.col("PO_LINE_MAX_RCVD_DATE")
    return bronze(spark, sf).purchase_order_line.groupBy("FREIGHT_TYPE_CODE").agg(
        F.count(F.when(c.isNull(), 1)).alias("N_NULL"), F.count(F.when(c.isNotNull(), 1)).alias("N_SET"))


@query("p12_typed_nulls", o.sql("""SELECT tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID,
  CAST(NULL AS BOOLEAN) AS isCanceled, CAST(NULL AS TIMESTAMP) AS ETL_CREATED_DTTM,
  CAST(NULL AS TIMESTAMP) AS ETL_UPDATED_DTTM, CAST(NULL AS BIGINT) AS CURRENT_DELAY_IN_DAYS
  FROM purchase_orders""", "purchase_orders"))
def p12_typed_nulls(spark, sf):
    return bronze(spark, sf).purchase_orders.select(
        "TC_PURCHASE_ORDERS_ID", F.lit(None).cast("boolean").alias("isCanceled"),
        F.lit(None).cast("timestamp").alias("ETL_CREATED_DTTM"),
        F.lit(None).cast("timestamp").alias("ETL_UPDATED_DTTM"),
        F.lit(None).cast("bigint").alias("CURRENT_DELAY_IN_DAYS"))


# ---------------------------------------------------------------- scalar functions

@query("f1_prefix", o.sql("""SELECT tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID,
  substring(CAST(o_facility_alias_id AS VARCHAR), 1, 2) AS FACILITY_PREFIX FROM purchase_orders""",
                           "purchase_orders"))
def f1_prefix(spark, sf):
    """SUBSTRING(x, 0, 2): position 0 counts as 1 in Spark."""
    return bronze(spark, sf).purchase_orders.select(
        "TC_PURCHASE_ORDERS_ID", F.substring(F.col("O_FACILITY_ALIAS_ID").cast("string"), 0, 2).alias("FACILITY_PREFIX"))


@query("f2_cast", o.sql("""SELECT tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID,
  CAST(billing_method AS VARCHAR) AS BILLING_TEXT, CAST(purchase_orders_id AS VARCHAR) AS PO_ID_TEXT,
  CAST(billing_method AS BIGINT) AS BILLING_LONG, CAST(NULL AS BOOLEAN) AS NO_FLAG FROM purchase_orders""",
                         "purchase_orders"))
def f2_cast(spark, sf):
    return bronze(spark, sf).purchase_orders.select(
        "TC_PURCHASE_ORDERS_ID", F.col("BILLING_METHOD").cast("string").alias("BILLING_TEXT"),
        F.col("PURCHASE_ORDERS_ID").cast("string").alias("PO_ID_TEXT"),
        F.col("BILLING_METHOD").cast("bigint").alias("BILLING_LONG"),
        F.lit(None).cast("boolean").alias("NO_FLAG"))


@query("f3_case", o.sql("""SELECT tc_purchase_orders_id AS TC_PURCHASE_ORDERS_ID,
  CASE WHEN po_type = 'COLLECT' OR po_type = 'PREPAID' THEN 'PO' WHEN po_type = 'INTERNATIONAL' THEN 'SHIPMENT' END
  AS RECORD_TYPE FROM po_kind""", "po_kind"))
def f3_case(spark, sf):
    b = bronze(spark, sf)
    t = F.col("PO_TYPE")
    return fx.po_types(b.purchase_orders, b.export_order).select(
        "TC_PURCHASE_ORDERS_ID",
        F.when(t.isin(fx.COLLECT, fx.PREPAID), "PO").when(t == fx.INTERNATIONAL, "SHIPMENT").alias("RECORD_TYPE"))


@query("f5_dateadd_day", o.sql(f"""SELECT po_no AS PO_NO, {o.dd('-7', 'deliv_date')} AS DELIV_MINUS_7,
  {o.dd(o.ddiff('ship_start_date', 'ship_end_date'), 'deliv_end_date')} AS DELIV_END_PLUS_WINDOW,
  {o.dd('NULL', 'deliv_date')} AS NULL_SHIFT FROM purchase_order_line""", "purchase_order_line"))
def f5_dateadd_day(spark, sf):
    c = F.col
    return bronze(spark, sf).purchase_order_line.select(
        "PO_NO", add_days(-7, c("DELIV_DATE")).alias("DELIV_MINUS_7"),
        add_days(days_between(c("SHIP_START_DATE"), c("SHIP_END_DATE")), c("DELIV_END_DATE")).alias("DELIV_END_PLUS_WINDOW"),
        add_days(F.lit(None).cast("int"), c("DELIV_DATE")).alias("NULL_SHIFT"))


@query("f6_dateadd_hour", o.sql(f"""SELECT order_id AS ORDER_ID, {o.dh('-30', 'created_dttm')} AS CREATED_MINUS_30H,
  {o.dh('-(order_id % 100)', 'created_dttm')} AS CREATED_MINUS_K FROM tlm_orders""", "tlm_orders"))
def f6_dateadd_hour(spark, sf):
    c = F.col
    return bronze(spark, sf).tlm_orders.select(
        "ORDER_ID", add_hours(-30, c("CREATED_DTTM")).alias("CREATED_MINUS_30H"),
        add_hours(-(c("ORDER_ID") % 100), c("CREATED_DTTM")).alias("CREATED_MINUS_K"))


@query("f7_datediff_day", o.sql(f"""SELECT po_no AS PO_NO,
  {o.ddiff('po_line_max_rcvd_date', 'deliv_date')} AS RCVD_TO_DELIV,
  {o.ddiff('ship_end_date', 'deliv_start_date')} AS SHIP_TO_DELIV FROM purchase_order_line""",
                                 "purchase_order_line"))
def f7_datediff_day(spark, sf):
    c = F.col
    return bronze(spark, sf).purchase_order_line.select(
        "PO_NO", days_between(c("PO_LINE_MAX_RCVD_DATE"), c("DELIV_DATE")).alias("RCVD_TO_DELIV"),
        days_between(c("SHIP_END_DATE"), c("DELIV_START_DATE")).alias("SHIP_TO_DELIV"))


@query("f8_datediff_hour", o.sql(f"""SELECT o.order_id AS ORDER_ID,
  {o.hdiff('o.created_dttm', 'r.pickup_end_dttm')} AS HOURS_TO_PICKUP
  FROM tlm_orders o LEFT JOIN pickup r ON o.order_id = r.order_id""", "tlm_orders", "pickup"))
def f8_datediff_hour(spark, sf):
    b = bronze(spark, sf)
    x = left_join(b.tlm_orders.select("ORDER_ID", "CREATED_DTTM"), fx.pickup_end(b.rts_line_item),
                  [("ORDER_ID", "ORDER_ID")])
    return x.select("ORDER_ID", hours_between(F.col("CREATED_DTTM"), F.col("PICKUP_END_DTTM")).alias("HOURS_TO_PICKUP"))


@query("f9_to_timestamp", o.sql(f"""SELECT shipment_id AS SHIPMENT_ID, stop_seq AS STOP_SEQ,
  CAST(event_dttm AS TIMESTAMP) AS EVENT_TS,
  {o.hdiff('CAST(event_dttm AS TIMESTAMP)', 'CAST(event_dttm AS TIMESTAMP) + INTERVAL 90 MINUTE')} AS H
  FROM tracking_message""", "tracking_message"))
def f9_to_timestamp(spark, sf):
    ev = keep_timestamp(F.col("EVENT_DTTM"))
    return bronze(spark, sf).tracking_message.select(
        "SHIPMENT_ID", "STOP_SEQ", ev.alias("EVENT_TS"),
        hours_between(ev, F.timestamp_add("MINUTE", F.lit(90), ev)).alias("H"))


# ---------------------------------------------------------------- sources and sinks

_SOURCE_VIEWS = [n for n in br.SOURCES]


@query("s5_scan_counts", o.sql("\nUNION ALL\n".join(
    f"SELECT '{n}' AS SOURCE, count(*) AS N FROM {n}" for n in _SOURCE_VIEWS), *_SOURCE_VIEWS))
def s5_scan_counts(spark, sf):
    b = bronze(spark, sf)
    out = None
    for n in _SOURCE_VIEWS:
        c = b[n].groupBy().agg(F.count(F.lit(1)).alias("N")).select(F.lit(n).alias("SOURCE"), "N")
        out = c if out is None else out.unionByName(c)
    return out


@query("s2_full_extract", "SELECT * FROM orders")
def s2_full_extract(spark, sf):
    br.fixtures.register_raw(spark, sf)
    return extract_full(spark, "SELECT * FROM orders")


@query("s3_incremental_extract", f"""SELECT * FROM events
  WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '{INGEST_JOB_START}'""")
def s3_incremental_extract(spark, sf):
    spark.read.parquet(f"{sf}/events.parquet").createOrReplaceTempView("events")
    run = run_info(spark, INGEST_NOW_UTC)
    tpl = ("SELECT * FROM events WHERE <IncrementalColumn> > '<IncrementalStartTime>' "
           "AND <IncrementalColumn> <= '<JobStartTime>'")
    df, _ = extract_incremental(spark, tpl, "ts", dt.datetime(2024, 1, 10), run.job_start)
    return df


@query("s2_partitioned_extract", "SELECT * FROM orders WHERE o_custkey % 10 <> 3")
def s2_partitioned_extract(spark, sf):
    """A configured query read in ranges of its key, cut at quantiles."""
    br.fixtures.register_raw(spark, sf)
    return extract_in_ranges(spark, "SELECT * FROM orders WHERE o_custkey % 10 <> 3;", "o_custkey", 8)


def _events_between(spark, sf, start: dt.datetime, end: dt.datetime) -> DataFrame:
    spark.read.parquet(f"{sf}/events.parquet").createOrReplaceTempView("events")
    tpl = ("SELECT * FROM events WHERE <IncrementalColumn> > '<IncrementalStartTime>' "
           "AND <IncrementalColumn> <= '<JobStartTime>'")
    return extract_incremental(spark, tpl, "ts", start, end)[0]


@query("s3_upsert_history", f"""SELECT * EXCLUDE k FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events
  WHERE ts <= TIMESTAMP '{INGEST_JOB_START}') WHERE k = 1""")
def s3_upsert_history(spark, sf):
    """The latest event per user and type from three increments, each from where the last ended."""
    name, start = _uniq("bronze_events"), dt.datetime(1970, 1, 1)
    for batch, end in (("20240105000000", dt.datetime(2024, 1, 5)), ("20240112000000", dt.datetime(2024, 1, 12)),
                       (INGEST_BATCH, dt.datetime.fromisoformat(INGEST_JOB_START))):
        done = upsert(spark, _events_between(spark, sf, start, end), name, ["user_id", "event_type"], ["ts", "event_id"], batch, start)
        start = done.next_start
    return read_merged(spark, name)


@query("s6_audit_column", f"""SELECT o_orderkey, o_orderstatus,
  TIMESTAMP '{INGEST_JOB_START}' AS ETL_CREATED_DTTM FROM orders""")
def s6_audit_column(spark, sf):
    br.fixtures.register_raw(spark, sf)
    run = run_info(spark, INGEST_NOW_UTC)
    df = extract_full(spark, "SELECT o_orderkey, o_orderstatus FROM orders")
    return with_audit_ts(df, run.job_start)


def _written_orders(spark, sf) -> str:
    br.fixtures.register_raw(spark, sf)
    name = _uniq("bronze_orders")
    # Many small files on purpose, so compaction has work to do.
    replace_table(spark, extract_full(spark, "SELECT * FROM orders").repartition(16), name)
    return name


@query("s7_replace_table", "SELECT * FROM orders")
def s7_replace_table(spark, sf):
    name = _written_orders(spark, sf)
    replace_table(spark, spark.sql("SELECT * FROM orders"), name)  # second run replaces
    return spark.table(name)


@query("s8_written_count", "SELECT count(*) AS sourceCount FROM orders")
def s8_written_count(spark, sf):
    name = _written_orders(spark, sf)
    return spark.table(name).agg(F.count(F.lit(1)).alias("sourceCount"))


@query("s9_compact", "SELECT * FROM orders")
def s9_compact(spark, sf):
    name = _written_orders(spark, sf)
    before, after = compact_table(spark, name, target_bytes=64 * 1024 * 1024)
    assert after <= before, (before, after)
    return spark.table(name)


_LOG_Q = "SELECT * FROM orders"


@query("s10_run_log", f"""SELECT '{INGEST_BATCH}' AS batchId, 'orders' AS sourceName, count(*) AS sourceCount,
  '{_LOG_Q}' AS queryUsed FROM orders""")
def s10_run_log(spark, sf):
    name = _written_orders(spark, sf)
    run = run_info(spark, INGEST_NOW_UTC)
    log = _uniq("log_ingestion")
    start = dt.datetime(2024, 1, 20, 12, 0, 0)
    append_run_log(spark, [(run.batch_id, "orders", start, start, table_count(spark, name), _LOG_Q)], log)
    return spark.table(log).select("batchId", "sourceName", "sourceCount", "queryUsed")


@query("s11_truncate_append", o.silver_sql("amber"))
def s11_truncate_append(spark, sf):
    """Publish the silver table twice (second run replaces), read it back."""
    name = _uniq("silver_milestone")
    df = silver_milestones(bronze(spark, sf), AS_OF, first_red_status="AMBER")
    publish(spark, df, name)
    truncate_append(spark, df, name)
    return spark.table(name)


@query("s12_batch_id", """SELECT event_id AS EVENT_ID,
  timezone('America/Chicago', timezone('UTC', ts)) AS CENTRAL_TIME,
  strftime(timezone('America/Chicago', timezone('UTC', ts)), '%Y%m%d%H%M%S') AS BATCH_ID FROM events""")
def s12_batch_id(spark, sf):
    """Run clock on every event time: UTC -> US Central, batch-id text."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    ct = central_time(F.col("ts").cast("timestamp"))
    return ev.select(F.col("event_id").alias("EVENT_ID"), ct.cast("timestamp_ntz").alias("CENTRAL_TIME"),
                     batch_id(ct).alias("BATCH_ID"))


_INGEST_ORACLE = f"""
SELECT '{INGEST_BATCH}' AS batchId, 'events' AS sourceName, count(*) AS sourceCount,
  'SELECT * FROM events WHERE ts > ''2024-01-10 00:00:00'' AND ts <= ''{INGEST_JOB_START}''' AS queryUsed
  FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '{INGEST_JOB_START}'
UNION ALL
SELECT '{INGEST_BATCH}', 'lineitem', count(*),
  'SELECT * FROM lineitem WHERE l_returnflag <> ''none'' OR l_linestatus = "none"'
  FROM lineitem WHERE l_returnflag <> 'none' OR l_linestatus = 'none'
UNION ALL
SELECT '{INGEST_BATCH}', 'orders', count(*), 'SELECT * FROM orders' FROM orders"""


@query("s13_ingest_all", _INGEST_ORACLE)
def s13_ingest_all(spark, sf):
    """Config-driven ingest of the active sources; the run log without times."""
    for n in ("orders", "lineitem", "events", "customer"):
        spark.read.parquet(f"{sf}/{n}.parquet").createOrReplaceTempView(n)
    run = run_info(spark, INGEST_NOW_UTC)
    log = _uniq("log_ingestion")
    out = ingest_all(spark, example_control(spark), run, log, table_prefix=_uniq("bronze") + "_")
    return out.select("batchId", "sourceName", "sourceCount", "queryUsed")
