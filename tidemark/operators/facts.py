"""Per-key facts of the milestone job (M0 - M0j).

Each function takes bronze DataFrames (upper-case columns) and returns a
DataFrame at a stated grain.  All rollups are plain ``groupBy().agg()`` with
MAX/MIN/SUM, so Spark aggregates map-side before the shuffle: a key that
holds a third of all rows costs one partial row per map task.

The assembly (``milestone_input``) joins everything keyed by PO last, so the
wide rows are exchanged by PO once; per-shipment facts are attached to the
one-row-per-PO frame before the fan-out joins (lines, control-tower
shipments, ASNs) multiply it.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import drop_unshipped_international, max_where
from ..session import staged
from .joins import exists_flag, left_join, left_join_each
from .skew import MIN_ROWS, Heavy, heavy_keys, is_heavy, split_left_join, stripes
from .states import Agg, rollup

INTERNATIONAL, PREPAID, COLLECT = "INTERNATIONAL", "PREPAID", "COLLECT"


def _max(*cols: str, rename: dict | None = None):
    rename = rename or {}
    return [F.max(c).alias(rename.get(c, c)) for c in cols]


def _max_state(*cols: str) -> tuple[Agg, ...]:
    return tuple(Agg(c, "max", c) for c in cols)


# --------------------------------------------------------------------------
# Purchase orders (M0)
# --------------------------------------------------------------------------

def export_po_keys(export_order: DataFrame) -> DataFrame:
    """DISTINCT PO numbers that have an export order (A5)."""
    return export_order.select(F.col("SC_EXP_PO_NO").alias("SC_EXP_PO_NO")).distinct()


def classify_po(o_country, d_country, o_facility, has_export, billing):
    """PO type rule, tried top down; no match gives NULL.

    International when the origin country differs from the destination and
    is not Canada; else international when the origin facility starts with
    57 and the PO has an export order; else billing 0 is prepaid, 1 collect.
    """
    return (F.when((o_country != d_country) & (o_country != F.lit("CA")), F.lit(INTERNATIONAL))
            .when((F.substring(o_facility.cast("string"), 1, 2) == F.lit("57")) & has_export,
                  F.lit(INTERNATIONAL))
            .when(billing == 0, F.lit(PREPAID))
            .when(billing == 1, F.lit(COLLECT)))


def po_types(purchase_orders: DataFrame, export_order: DataFrame, rts_line_item: DataFrame | None = None) -> DataFrame:
    """One row per SAP purchase order with its PO type (M0).

    Grain: TC_PURCHASE_ORDERS_ID.  ANY_VALUE of the country codes is taken as
    MAX: one legal answer, and repeatable.  The export-order test is a
    boolean from a join to the distinct export PO numbers, made after the
    rollup so it joins one row per PO.

    With ``rts_line_item`` the row has its PICKUP_END_DTTM too.  That joins by
    PURCHASE_ORDERS_ID, so it is looked up before the rollup: the rolled-up
    rows then stay where they are for all joins by PO number.
    """
    po = purchase_orders.where(F.col("CREATED_SOURCE") == F.lit("SAP"))
    pickup = []
    if rts_line_item is not None:
        po = left_join(po, pickup_end(rts_line_item), [("PURCHASE_ORDERS_ID", "ORDER_ID")])
        # rows that tie have the same order, so the same pickup
        pickup = [F.max_by("PICKUP_END_DTTM", "PURCHASE_ORDERS_ID").alias("PICKUP_END_DTTM")]
    agg = po.groupBy("TC_PURCHASE_ORDERS_ID").agg(
        *_max("D_FACILITY_ALIAS_ID", "BUSINESS_PARTNER_ID", "D_CITY", "D_COUNTRY_CODE",
              "O_COUNTRY_CODE", "BILLING_METHOD", "O_CITY", "O_STATE_PROV",
              "PURCHASE_ORDERS_ID", "LAST_UPDATED_DTTM", "CREATED_DTTM"),
        F.max("O_FACILITY_ALIAS_ID").alias("__O_FAC"), *pickup,
    )
    agg = exists_flag(agg, export_po_keys(export_order), "TC_PURCHASE_ORDERS_ID",
                      "SC_EXP_PO_NO", "__HAS_EXPORT")
    typed = agg.withColumn("PO_TYPE", classify_po(F.col("O_COUNTRY_CODE"), F.col("D_COUNTRY_CODE"),
                                                  F.col("__O_FAC"), F.col("__HAS_EXPORT"),
                                                  F.col("BILLING_METHOD")))
    return typed.drop("__O_FAC", "__HAS_EXPORT")


def pending_pos(pending_po_line: DataFrame) -> DataFrame:
    """DISTINCT PO numbers with a pending line (A5)."""
    return pending_po_line.select("PO_NO").distinct()


# --------------------------------------------------------------------------
# PO lines (M0b)
# --------------------------------------------------------------------------

PO_LINE_KEYS = ("PO_NO", "PO_TRACKING_NO", "FREIGHT_TYPE_CODE", "PO_LINE_MOVE_TYPE_CODE")


PO_LINE_AGGS = (
    *_max_state("DELIV_DATE", "SHIP_START_DATE", "SHIP_END_DATE", "DELIV_START_DATE", "DELIV_END_DATE"),
    Agg("MONETARY_VALUE", "sum", "PO_LINE_UNIT_PRICE * PO_LINE_ORDER_QTY"),
    Agg("ORDER_QTY", "sum", "PO_LINE_ORDER_QTY"),
    Agg("RCVD_QTY", "sum", "PO_LINE_RCVD_QTY"),
    Agg("PO_WEIGHT", "max", "PO_TOTAL_WEIGHT"),
    Agg("PO_VOLUME", "max", "PO_TOTAL_VOLUME"),
    Agg("PO_RCVD_DATE", "max", "PO_LINE_MAX_RCVD_DATE"),
    Agg("PO_FULL_RCVD_DATE", "max_if_complete", "PO_LINE_MAX_RCVD_DATE"),
)


def po_line_rollup(purchase_order_line: DataFrame) -> DataFrame:
    """Lines rolled up per PO, tracking number, freight type and move type.

    MONETARY_VALUE is SUM(price * qty) in exact decimals; PO_FULL_RCVD_DATE
    is the last receipt date only when every line has one (A8).
    """
    return rollup(purchase_order_line, PO_LINE_KEYS, PO_LINE_AGGS)


def po_line_groups(purchase_order_line: DataFrame) -> DataFrame:
    """``po_line_rollup`` for a join by PO number, lines without one left out.

    The lines are exchanged by PO once and rolled up there; the plain rollup is
    exchanged by its four keys and again by PO for the join.
    """
    return po_line_rollup(purchase_order_line.where(F.col("PO_NO").isNotNull()).repartition("PO_NO"))


# --------------------------------------------------------------------------
# Control-tower shipments and events (M0c, M0d)
# --------------------------------------------------------------------------

def export_article_rollup(export_order: DataFrame) -> DataFrame:
    """Export orders per PO and article (SKU), grouped by the aliases (A10)."""
    return (export_order
            .select(F.col("SC_EXP_PO_NO").alias("PO"), F.col("ARTICLE_NO").alias("SKU"),
                    "SHIP_NOT_AFTER", "SHIP_NOT_BEFORE", "VENDOR_BOOKED_DATE", "CARGO_READY_DATE")
            .groupBy("PO", "SKU")
            .agg(F.max("SHIP_NOT_AFTER").alias("SHIP_NOT_AFTER"),
                 F.max("SHIP_NOT_BEFORE").alias("SHIP_NOT_BEFORE"),
                 F.min("VENDOR_BOOKED_DATE").alias("VENDOR_BOOKED_DATE"),
                 F.max("CARGO_READY_DATE").alias("CARGO_READY_DATE")))


def ct_lines_with_export(ct_shipment: DataFrame, export_order: DataFrame, keep_unmatched: bool = True,
                         heavy: Sequence[Heavy] = ()) -> DataFrame:
    """Shipment lines joined to export orders on PO and article.

    ``heavy`` POs, to which both frames are then limited, are split."""
    exp = export_article_rollup(export_order)
    lines = ct_shipment.select("SC_CT_SHIPMENT_ID", "TSC_PO_NO", "ARTICLE_NO", "SHIPMENT_START_DATE")
    keys = [("TSC_PO_NO", "PO"), ("ARTICLE_NO", "SKU")]
    if heavy:  # an article has one export row, so only the lines are dealt out
        j = split_left_join(lines, exp, keys, [Heavy(h.key, h.right) for h in heavy], drop_right_keys=False)
        return j if keep_unmatched else j.where(F.col("PO").isNotNull())
    if keep_unmatched:
        return left_join(lines, exp, keys, drop_right_keys=False)
    return lines.join(exp, (F.col("TSC_PO_NO") == F.col("PO")) & (F.col("ARTICLE_NO") == F.col("SKU")))


def ct_shipment_rollup(ct_shipment: DataFrame, export_order: DataFrame, keep_unmatched: bool = True,
                       heavy: Sequence[Heavy] = ()) -> DataFrame:
    """Control-tower shipments per (export PO, shipment).

    The group key is the *export* PO, so shipment lines without an export
    order fall in a NULL-PO group that never joins a PO later.  The job
    passes ``keep_unmatched=False`` to drop those lines before grouping;
    the rows that reach a PO are the same.
    """
    j = ct_lines_with_export(ct_shipment, export_order, keep_unmatched, heavy)
    return j.groupBy("PO", "SC_CT_SHIPMENT_ID").agg(
        F.max("VENDOR_BOOKED_DATE").alias("VENDOR_BOOKED_DATE"),
        F.max("CARGO_READY_DATE").alias("CARGO_READY_DATE"),
        F.max("SHIPMENT_START_DATE").alias("SC_CT_SHIPMENT_START_DATE"),
        F.max("SHIP_NOT_AFTER").alias("SHIP_NOT_AFTER"),
        F.max("SHIP_NOT_BEFORE").alias("SHIP_NOT_BEFORE"),
    )


COB_CODES = ("COB",)
CARRIER_DROP_CODES = ("CARRDROP", "DROP")


def _codes_state(name: str, codes: tuple[str, ...]) -> Agg:
    listed = ", ".join(f"'{c}'" for c in codes)
    return Agg(name, "max", f"CASE WHEN EVENT_CODE IN ({listed}) THEN EVENT_TS END")


CT_EVENT_AGGS = (_codes_state("COB_TS", COB_CODES), _codes_state("CARRIER_DROP_TS", CARRIER_DROP_CODES))


def ct_event_times(ct_shipment_event: DataFrame, only_used_codes: bool = False) -> DataFrame:
    """Per control-tower shipment: COB time and carrier-drop time.

    A pivot of event codes to columns as conditional MAX.  With
    ``only_used_codes`` rows of other codes are filtered first (pushed to the
    scan); shipments with only such codes then have no row instead of a row
    of NULLs, which a LEFT join cannot tell apart.
    """
    ev = ct_shipment_event
    if only_used_codes:
        ev = ev.where(F.col("EVENT_CODE").isin(*COB_CODES, *CARRIER_DROP_CODES))
    return rollup(ev, ("SC_CT_SHIPMENT_ID",), CT_EVENT_AGGS).withColumnRenamed("SC_CT_SHIPMENT_ID", "CT_SHIPMENT_ID")


# --------------------------------------------------------------------------
# Transport-management facts (M0e, M0g, M0h, M0i)
# --------------------------------------------------------------------------

SHIPMENT_AGGS = _max_state("SHIPMENT_STATUS", "STATUS_CHANGE_DTTM", "TRAILER_NUMBER")


def shipment_status(tlm_shipment: DataFrame) -> DataFrame:
    """Per shipment: MAX status, status-change time and trailer (A1)."""
    return rollup(tlm_shipment, ("SHIPMENT_ID",), SHIPMENT_AGGS)


def pickup_end(rts_line_item: DataFrame) -> DataFrame:
    """Per order: latest pickup end."""
    return rts_line_item.groupBy("ORDER_ID").agg(F.max("PICKUP_END_DTTM").alias("PICKUP_END_DTTM"))


def master_order_lines(order_master_order: DataFrame, tlm_orders: DataFrame) -> DataFrame:
    """``OMO.TC_MASTER_ORDER_ID, O.*``: master-order links with their order."""
    omo = order_master_order.select("TC_MASTER_ORDER_ID", F.col("ORDER_ID").alias("__OMO_ORDER_ID"))
    j = left_join(omo, tlm_orders, [("__OMO_ORDER_ID", "ORDER_ID")], drop_right_keys=False)
    return j.select("TC_MASTER_ORDER_ID", *tlm_orders.columns)


def master_order_rollup(order_master_order: DataFrame, tlm_orders: DataFrame) -> DataFrame:
    """Per master order (= PO number): order facts.

    Orders are first reduced to one row per ORDER_ID (MAX distributes over
    the later MAX), so the join is one-to-one and a hot order id is
    combined map-side instead of multiplying rows in one task.
    """
    o = tlm_orders.groupBy("ORDER_ID").agg(
        *_max("O_FACILITY_ALIAS_ID", "SHIPMENT_ID", "TC_SHIPMENT_ID", "CREATED_DTTM"),
        F.max("ORDER_ID").alias("__O_ORDER_ID"))
    omo = order_master_order.select("TC_MASTER_ORDER_ID", F.col("ORDER_ID").alias("__OMO_ORDER_ID"))
    j = left_join(omo, o, [("__OMO_ORDER_ID", "ORDER_ID")])
    return j.groupBy("TC_MASTER_ORDER_ID").agg(
        *_max("O_FACILITY_ALIAS_ID", "SHIPMENT_ID", "TC_SHIPMENT_ID"),
        F.max("__O_ORDER_ID").alias("ORDER_ID"),
        F.max("CREATED_DTTM").alias("CREATED_DTTM"),
    )


def stops_by_facility(stop: DataFrame) -> DataFrame:
    """Per (shipment, facility): latest departure, arrival and stop number.

    The origin (destination) values of a PO are the MAX over the stops of
    its shipment at its origin (destination) facility, so this rollup joined
    once per side on (shipment, facility) gives them without a fan-out.
    """
    return stop.groupBy("SHIPMENT_ID", "FACILITY_ALIAS_ID").agg(
        F.max("DEPARTURE_START_DTTM").alias("DEPARTURE_START_DTTM"),
        F.max("ARRIVAL_START_DTTM").alias("ARRIVAL_START_DTTM"),
        F.max("STOP_SEQ").alias("STOP_SEQ"),
    )


def tracking_rollup(tracking_message: DataFrame) -> DataFrame:
    """Per (shipment, stop, status, type): latest event time."""
    return tracking_message.groupBy("SHIPMENT_ID", "STOP_SEQ", "MESSAGE_STATUS", "MESSAGE_TYPE").agg(
        F.max("EVENT_DTTM").alias("EVENT_DTTM"))


DEPARTED, ON_YARD_MSG, MSG_OK = 50, 45, 10


def tracking_used(tracking_message: DataFrame) -> DataFrame:
    """The messages that the job reads: departed or on yard, status ok."""
    return tracking_message.where((F.col("MESSAGE_STATUS") == MSG_OK) & F.col("MESSAGE_TYPE").isin(DEPARTED, ON_YARD_MSG))


def tracking_by_stop(tracking_message: DataFrame) -> DataFrame:
    """Per (shipment, stop): departure (type 50) and on-yard (type 45) times.

    Both joins of the reference to the tracking rollup fix type and status
    to constants, so one filtered scan with two conditional MAXes replaces
    the two lookups (J4, J5).
    """
    t = F.col("MESSAGE_TYPE")
    return tracking_used(tracking_message).groupBy("SHIPMENT_ID", "STOP_SEQ").agg(
        max_where(t == DEPARTED, "EVENT_DTTM").alias("DEPARTED_DTTM"),
        max_where(t == ON_YARD_MSG, "EVENT_DTTM").alias("ON_YARD_DTTM"),
    )


def planned_times(shipment_event: DataFrame) -> DataFrame:
    """Per shipment: latest change of STATUS to Assigned."""
    se = shipment_event.where((F.col("FIELD_NAME") == "STATUS") & (F.col("NEW_VALUE") == "Assigned"))
    return se.groupBy("SHIPMENT_ID").agg(F.max("CREATED_DTTM").alias("PLANNED_TIME"))


# --------------------------------------------------------------------------
# Assembly (M0f, M0g, M0h, M0j)
# --------------------------------------------------------------------------

def po_orders(b, pickups: bool = False, statuses: bool = False) -> DataFrame:
    """One row per PO: type, order facts (TPO + ORD), both keyed by PO number.

    ``pickups`` adds the pickup end (RLI), ``statuses`` the shipment status (TSH):
    each is looked up on the side that has its key, before the two meet."""
    tpo = po_types(b.purchase_orders, b.export_order, b.rts_line_item if pickups else None)
    ordr = master_order_rollup(b.order_master_order, b.tlm_orders)
    if statuses:
        ordr = left_join(ordr, shipment_status(b.tlm_shipment), [("SHIPMENT_ID", "SHIPMENT_ID")])
    tpo = tpo.withColumnRenamed("CREATED_DTTM", "PO_DATE")
    return left_join(tpo, ordr, [("TC_PURCHASE_ORDERS_ID", "TC_MASTER_ORDER_ID")],
                     spread_null_keys=False)


def stops_of_shipment(stop: DataFrame) -> DataFrame:
    """Per shipment a map from facility to its row of ``stops_by_facility``.

    Stops are exchanged by shipment once; rolled up and gathered there they make the
    same map, which a task holds whole in any case."""
    known = stop.where(F.col("SHIPMENT_ID").isNotNull() & F.col("FACILITY_ALIAS_ID").isNotNull())
    f = stops_by_facility(known.repartition("SHIPMENT_ID"))
    times = F.struct("DEPARTURE_START_DTTM", "ARRIVAL_START_DTTM", "STOP_SEQ")
    return f.groupBy("SHIPMENT_ID").agg(
        F.map_from_entries(F.collect_list(F.struct("FACILITY_ALIAS_ID", times))).alias("__STOPS"))


def tracking_of_shipment(tracking_message: DataFrame) -> DataFrame:
    """Per shipment a map from stop to its row of ``tracking_by_stop``, in one exchange
    as ``stops_of_shipment``."""
    known = tracking_used(tracking_message).where(F.col("SHIPMENT_ID").isNotNull() & F.col("STOP_SEQ").isNotNull())
    t = tracking_by_stop(known.repartition("SHIPMENT_ID"))
    return t.groupBy("SHIPMENT_ID").agg(
        F.map_from_entries(F.collect_list(F.struct("STOP_SEQ", F.struct("DEPARTED_DTTM", "ON_YARD_DTTM")))).alias("__TRACKED"))


def _at(column: str, key: str):
    return F.try_element_at(F.col(column), F.col(key))


def _with_route_times(x: DataFrame) -> DataFrame:
    """The six route columns of ``route_times`` from the maps of the row's shipment."""
    x = x.withColumns({"__O": _at("__STOPS", "O_FACILITY_ALIAS_ID"), "__D": _at("__STOPS", "D_FACILITY_ALIAS_ID")})
    x = x.withColumns({"ORIGIN_DEPARTURE_DTTM": F.col("__O.DEPARTURE_START_DTTM"), "ORIGIN_STOP": F.col("__O.STOP_SEQ"),
                       "DESTINATION_ARRIVAL_DTTM": F.col("__D.ARRIVAL_START_DTTM"), "DEST_STOP": F.col("__D.STOP_SEQ")})
    return x.withColumns({"ACTUAL_ORIGIN_DEPARTURE_DTTM": _at("__TRACKED", "ORIGIN_STOP")["DEPARTED_DTTM"],
                          "ACTUAL_ON_YARD_DTTM": _at("__TRACKED", "DEST_STOP")["ON_YARD_DTTM"]}) \
        .drop("__STOPS", "__TRACKED", "__O", "__D")


def route_times(po: DataFrame, stop: DataFrame, tracking_message: DataFrame) -> DataFrame:
    """Per PO: planned origin departure / stop, destination arrival / stop
    (M0g, relation B) and actual departure / on-yard times (M0h, relation C).

    A shipment has few facilities and stops: their rollups are gathered into two
    maps per shipment, and a PO looks up its origin and destination there.  The
    PO frame (one row per PO) is exchanged once, by shipment.
    """
    legs = po.select("TC_PURCHASE_ORDERS_ID", "SHIPMENT_ID", "O_FACILITY_ALIAS_ID", "D_FACILITY_ALIAS_ID")
    x = left_join_each(legs, [stops_of_shipment(stop), tracking_of_shipment(tracking_message)], "SHIPMENT_ID")
    return _with_route_times(x).select(
        "TC_PURCHASE_ORDERS_ID", "ORIGIN_DEPARTURE_DTTM", "ORIGIN_STOP", "DESTINATION_ARRIVAL_DTTM", "DEST_STOP",
        "ACTUAL_ORIGIN_DEPARTURE_DTTM", "ACTUAL_ON_YARD_DTTM")


def with_shipment_facts(po: DataFrame, b) -> DataFrame:
    """Attach per-shipment facts to one-row-per-PO frame ``po``.

    Adds the stop and tracking times (as ``route_times``), shipment status (TSH)
    and planned time (SE), all in one exchange by shipment, then pickup end
    (RLI) unless ``po`` has it.  All joins run at PO grain, before any fan-out.
    """
    x = _with_route_times(left_join_each(po, [
        stops_of_shipment(b.stop), tracking_of_shipment(b.tracking_message),
        shipment_status(b.tlm_shipment), planned_times(b.shipment_event)], "SHIPMENT_ID"))
    if "PICKUP_END_DTTM" in x.columns:
        return x
    return left_join(x, pickup_end(b.rts_line_item), [("PURCHASE_ORDERS_ID", "ORDER_ID")])


def po_context(b) -> DataFrame:
    """The PO context of the reference (M0f, relation A): PO x line groups.

    One row per (PO, tracking number, freight type, move type); POs without
    lines keep one row.  Order facts, shipment status and pickup end joined.
    The PO rows are exchanged by PO once, and all joins of them run there.
    """
    po = po_orders(b, pickups=True, statuses=True)
    a = left_join(po, po_line_groups(b.purchase_order_line), [("TC_PURCHASE_ORDERS_ID", "PO_NO")], drop_right_keys=False,
                  spread_null_keys=False)
    return a.select(
        "TC_PURCHASE_ORDERS_ID", "PO_TYPE", "O_FACILITY_ALIAS_ID", "D_FACILITY_ALIAS_ID",
        "SHIPMENT_ID", "TC_SHIPMENT_ID", "BUSINESS_PARTNER_ID", "PO_TRACKING_NO", "PO_DATE",
        "D_CITY", "D_COUNTRY_CODE", "O_COUNTRY_CODE", "BILLING_METHOD", "PO_RCVD_DATE",
        F.col("SHIPMENT_ID").alias("SHIPMENT_ID_O"), "SHIPMENT_STATUS", "STATUS_CHANGE_DTTM",
        "ORDER_ID", "CREATED_DTTM", "SHIP_END_DATE", "DELIV_DATE", "DELIV_START_DATE",
        "DELIV_END_DATE", "SHIP_START_DATE", "O_CITY", "PO_WEIGHT", "PO_VOLUME", "ORDER_QTY",
        "MONETARY_VALUE", "O_STATE_PROV", "TRAILER_NUMBER", "FREIGHT_TYPE_CODE",
        "PO_LINE_MOVE_TYPE_CODE", "PICKUP_END_DTTM", "PO_NO", "PO_FULL_RCVD_DATE",
        "LAST_UPDATED_DTTM")


MILESTONE_INPUT_COLUMNS = (
    "TC_PURCHASE_ORDERS_ID", "PO_DATE", "PO_TYPE", "ACTUAL_ON_YARD_DTTM", "ACTUAL_SHIPPED_DTTM",
    "SC_CT_SHIPMENT_START_DATE", "SHIP_NOT_AFTER", "SHIP_NOT_BEFORE", "VENDOR_BOOKED_DATE",
    "CARGO_READY_DATE", "SC_CT_SHIPMENT_ID", "CARRIER_DROP_TS", "COB_TS", "CREATED_DTTM",
    "SHIP_END_DATE", "TC_SHIPMENT_ID", "SHIPMENT_STATUS", "SHIP_START_DATE",
    "ACTUAL_ORIGIN_DEPARTURE_DTTM", "DESTINATION_ARRIVAL_DTTM", "DELIV_DATE",
    "ORIGIN_DEPARTURE_DTTM", "DELIV_END_DATE", "PO_RCVD_DATE", "DELIV_START_DATE", "ORDER_ID",
    "SHIPMENT_ID_O", "PICKUP_END_DTTM", "P_PO_NO", "PO_NO", "PO_FULL_RCVD_DATE", "PLANNED_TIME",
)


def heavy_pos(b, min_rows: int = MIN_ROWS, shares: int | None = None) -> list[Heavy]:
    """POs with a large share of the control-tower lines or of the PO lines.

    Their stripes follow from the rows that the rollups leave of them: ``left``
    for line groups, ``right`` for shipments.  Two counts of narrow columns; the
    rollups are counted for the POs found only."""
    lines, per_group = heavy_keys(b.purchase_order_line, "PO_NO", min_rows, shares)
    shipped, per_shipment = heavy_keys(b.ct_shipment, "TSC_PO_NO", min_rows, shares)
    found = [Heavy(po) for po in sorted({*lines, *shipped})]
    if not found:
        return []

    def rows(df: DataFrame, key: str) -> dict:
        return {r[key]: r["n"] for r in df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).collect()}
    groups = rows(po_line_rollup(b.purchase_order_line.where(is_heavy("PO_NO", found))), "PO_NO")
    shipments = rows(b.ct_shipment.where(is_heavy("TSC_PO_NO", found)).select("TSC_PO_NO", "SC_CT_SHIPMENT_ID").distinct(),
                     "TSC_PO_NO")
    return [Heavy(h.key, stripes(groups.get(h.key, 0), per_group), stripes(shipments.get(h.key, 0), per_shipment)) for h in found]


def _fan_out(po: DataFrame, b, used_only: bool, heavy: Sequence[Heavy] = ()) -> DataFrame:
    """PO rows times their line groups and control-tower shipments.  With
    ``heavy`` all of it is limited to those POs, and their rows are split."""
    lines, exports, shipments = b.purchase_order_line, b.export_order, b.ct_shipment
    if heavy:
        po = po.where(is_heavy("TC_PURCHASE_ORDERS_ID", heavy))
        lines = lines.where(is_heavy("PO_NO", heavy))
        exports = exports.where(is_heavy("SC_EXP_PO_NO", heavy))
        shipments = shipments.where(is_heavy("TSC_PO_NO", heavy))
    # a heavy PO's lines are combined before they are exchanged
    pol = (po_line_rollup if heavy else po_line_groups)(lines).select(
        "PO_NO", "DELIV_DATE", "SHIP_START_DATE", "SHIP_END_DATE", "DELIV_START_DATE",
        "DELIV_END_DATE", "PO_RCVD_DATE", "PO_FULL_RCVD_DATE")
    cts = ct_shipment_rollup(shipments, exports, keep_unmatched=False, heavy=heavy)
    cts = left_join(cts, ct_event_times(b.ct_shipment_event, only_used_codes=True),
                    [("SC_CT_SHIPMENT_ID", "CT_SHIPMENT_ID")], spread_null_keys=False)
    t = F.col("PO_TYPE")
    if heavy:
        x = split_left_join(po, pol, [("TC_PURCHASE_ORDERS_ID", "PO_NO")], [Heavy(h.key, 1, h.left) for h in heavy],
                            drop_right_keys=False)
        # prepaid and collect POs need no shipments
        key = F.when(t.isNull() | (t == INTERNATIONAL), F.col("TC_PURCHASE_ORDERS_ID")) if used_only else F.col("TC_PURCHASE_ORDERS_ID")
        return split_left_join(x.withColumn("__CT_PO", key), cts, [("__CT_PO", "PO")], heavy).drop("__CT_PO")
    x = left_join(po, pol, [("TC_PURCHASE_ORDERS_ID", "PO_NO")], drop_right_keys=False, spread_null_keys=False)
    if used_only:
        return x.join(cts, (F.col("TC_PURCHASE_ORDERS_ID") == F.col("PO")) & (t.isNull() | (t == INTERNATIONAL)), "left")
    return left_join(x, cts, [("TC_PURCHASE_ORDERS_ID", "PO")], spread_null_keys=False)


def milestone_input(b, used_only: bool = False, heavy: Sequence[Heavy] = ()) -> DataFrame:
    """Milestone input (M0j, relation M): one row per PO x line group x
    control-tower shipment x ASN, international POs without a control-tower
    shipment removed (P6).

    Plan shape: the PO-grain frame (types + order facts) is joined to the
    shipment facts first (exchanges of narrow, one-row-per-PO data), then to
    the ASNs, and last -- all keyed by PO number -- to the pending flag, the
    line groups and the control-tower shipments with their events.  The PO
    keyed rollups share one hash partitioning, so the wide fan-out rows are
    produced in place and not exchanged again before the milestone rules.

    Only prepaid POs use the ASN time and only international ones the
    control-tower columns.  With ``used_only`` the other types don't meet those
    rows (a PO without a type still does: P6 asks whether it has a shipment), so
    a PO's line groups, shipments and ASNs aren't multiplied with each other;
    the de-duplicated milestones are the same.

    ``heavy`` POs (``heavy_pos``) leave that path: the PO frame is written to the
    shared folder, and their fan-out is split over many tasks (``skew``).
    """
    po = with_shipment_facts(po_orders(b, pickups=True), b)
    po = po.withColumn("SHIPMENT_ID_O", F.col("SHIPMENT_ID"))
    asn = b.asn.select("TC_SHIPMENT_ID", "ACTUAL_SHIPPED_DTTM")
    if used_only:
        key = F.when(F.col("PO_TYPE") == PREPAID, F.col("TC_SHIPMENT_ID"))
        asn = asn.distinct().withColumnRenamed("TC_SHIPMENT_ID", "__ASN_SHIPMENT")
        po = left_join(po.withColumn("__ASN_KEY", key), asn, [("__ASN_KEY", "__ASN_SHIPMENT")])
    else:
        po = left_join(po, asn, [("TC_SHIPMENT_ID", "TC_SHIPMENT_ID")])
    ppol = pending_pos(b.pending_po_line).select(F.col("PO_NO").alias("P_PO_NO"))
    po = left_join(po, ppol, [("TC_PURCHASE_ORDERS_ID", "P_PO_NO")], drop_right_keys=False, spread_null_keys=False)
    if heavy:
        po = staged(po, "po-frame")
        rest = type(b)(b | {"purchase_order_line": b.purchase_order_line.where(~is_heavy("PO_NO", heavy)),
                            "export_order": b.export_order.where(~is_heavy("SC_EXP_PO_NO", heavy)),
                            "ct_shipment": b.ct_shipment.where(~is_heavy("TSC_PO_NO", heavy))})
        x = _fan_out(po.where(~is_heavy("TC_PURCHASE_ORDERS_ID", heavy)), rest, used_only) \
            .select(*MILESTONE_INPUT_COLUMNS) \
            .unionByName(_fan_out(po, b, used_only, heavy).select(*MILESTONE_INPUT_COLUMNS))
    else:
        x = _fan_out(po, b, used_only)
    return x.where(drop_unshipped_international("PO_TYPE", "SC_CT_SHIPMENT_ID")).select(*MILESTONE_INPUT_COLUMNS)
