"""Milestone rules (M1 - M7), one-pass generation (K1), first/active (K2, K3)
and the silver table (M8).

Each milestone is a ``Rule`` record: per PO type, when it is reached, the
expected / actual / next-expected times, and the adherence cases tried top
down (no match gives NULL, also across a threshold gap).  Types are
C = COLLECT, P = PREPAID, I = INTERNATIONAL; ``ANY`` applies to every type,
NULL included.  Thresholds read in hours or days per rule, as written.

``milestones`` evaluates all seven rules on each input row in one pass: it
builds an array of seven structs, keeps the reached ones, and ``inline``s
them -- one scan of the milestone input instead of seven, then one
de-duplication.  This equals the seven-way UNION (DISTINCT) because the rank
differs per branch, so equal rows can only come from the same branch.
``milestones_by_union`` is the literal seven-branch form, kept for tests and
the benchmark comparison.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import add_days, add_hours, days_between, hours_between, keep_timestamp, non_blank
from ..schemas import SILVER_SCHEMA
from .facts import COLLECT as C, INTERNATIONAL as I, PREPAID as P
from .joins import broadcast_if_small, left_join
from .skew import Heavy, is_heavy, split_left_join

ANY = "*"

# Milestone names in rank order (rank = position + 1).
MILESTONE_NAMES = ("CREATED", "VENDOR_BOOKED", "MARKED_AS_READY", "PLANNED",
                   "IN_TRANSIT", "ON_YARD", "RECEIVED")

# Threshold columns of the status table.
THRESHOLD_COLUMNS = (
    "VENDOR_BOOKED_G", "VENDOR_BOOKED_A", "VENDOR_BOOKED_R",
    "MARKED_AS_READY_G", "MARKED_AS_READY_A", "MARKED_AS_READY_R",
    "PLANNED_G", "PLANNED_A", "PLANNED_R",
    "IN_TRANSIT_G", "IN_TRANSIT_A", "IN_TRANSIT_R",
    "ON_YARD_G", "ON_YARD_A", "ON_YARD_R",
    "RECEIVED_G", "RECEIVED_R",
)

# PO statuses that count as planned for a collect PO.
PLANNED_SHIPMENT_STATUSES = (60, 70, 80, 90)

# Fixed value: a PO older than this many hours and not pending is received.
RECEIVED_AGE_HOURS = 26

GREEN, AMBER, RED = "GREEN", "AMBER", "RED"

MILESTONE_COLUMNS = ("TC_PURCHASE_ORDERS_ID", "TC_SHIPMENT_ID", "PO_TYPE",
                     "EXPECTED_ETA_FOR_MILESTONE", "ACTUAL_ETA_FOR_MILESTONE",
                     "NEXT_MILESTONE_EXPECTED_ETA", "CURRENT_DELAY_IN_DAYS",
                     "REVISED_ETA_FOR_PO", "MILESTONE_RANK", "MILESTONE", "ADHERENCE_STATUS")


@dataclass
class Rule:
    name: str
    reached: list            # [(type or ANY, condition)]
    expected: dict           # type or ANY -> Column
    actual: dict
    next: dict
    status: list             # [(type, condition, colour)]
    has_delay: bool = True
    rank: int = field(init=False)

    def __post_init__(self):
        self.rank = MILESTONE_NAMES.index(self.name) + 1


def _po_type() -> Column:
    return F.col("PO_TYPE")


def _by_type(values: dict) -> Column:
    """CASE on PO type; types not listed give NULL."""
    if ANY in values:
        return values[ANY]
    expr = None
    for t, v in values.items():
        cond = _po_type() == F.lit(t)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr if expr is not None else F.lit(None)


def _first_match(cases: list, value_of) -> Column:
    """CASE WHEN (type, cond) ... THEN value_of(...) in order; else NULL."""
    expr = None
    for case in cases:
        t, cond = case[0], case[1]
        full = cond if t == ANY else (_po_type() == F.lit(t)) & cond
        v = F.lit(value_of(case))
        expr = F.when(full, v) if expr is None else expr.when(full, v)
    return expr


def rules(as_of: Column) -> list[Rule]:
    """The seven milestone rules over milestone input joined to thresholds."""
    m = F.col
    sna = m("SHIP_NOT_AFTER")
    transit_hours = hours_between(m("ORIGIN_DEPARTURE_DTTM"), m("DESTINATION_ARRIVAL_DTTM"))
    out = []

    out.append(Rule(
        "CREATED",
        reached=[(t, m("TC_PURCHASE_ORDERS_ID").isNotNull()) for t in (C, P, I)],
        expected={},
        actual={ANY: m("PO_DATE")},
        next={I: add_days(-m("VENDOR_BOOKED_G"), sna),
              C: add_hours(-m("MARKED_AS_READY_G"), m("SHIP_END_DATE")),
              P: add_days(-m("IN_TRANSIT_G"), m("DELIV_START_DATE"))},
        status=[(t, F.lit(True), GREEN) for t in (C, P, I)],
        has_delay=False))

    d_vb = days_between(m("VENDOR_BOOKED_DATE"), sna)
    out.append(Rule(
        "VENDOR_BOOKED",
        reached=[(I, m("VENDOR_BOOKED_DATE").isNotNull())],
        expected={ANY: add_days(-m("VENDOR_BOOKED_G"), sna)},
        actual={ANY: m("VENDOR_BOOKED_DATE")},
        next={ANY: add_days(-m("MARKED_AS_READY_G"), sna)},
        status=[(I, d_vb >= m("VENDOR_BOOKED_G"), GREEN),
                (I, d_vb >= m("VENDOR_BOOKED_A"), AMBER),
                (I, d_vb < m("VENDOR_BOOKED_R"), RED)]))

    h_mr = hours_between(m("CREATED_DTTM"), m("SHIP_END_DATE"))
    d_mr = days_between(m("CARGO_READY_DATE"), sna)
    out.append(Rule(
        "MARKED_AS_READY",
        reached=[(C, m("ORDER_ID").isNotNull()), (I, m("CARGO_READY_DATE").isNotNull())],
        expected={C: add_hours(-m("MARKED_AS_READY_G"), m("SHIP_END_DATE")),
                  I: add_days(-m("MARKED_AS_READY_G"), sna)},
        actual={C: m("CREATED_DTTM"), I: m("CARGO_READY_DATE")},
        next={C: add_hours(-m("PLANNED_G"), m("PICKUP_END_DTTM")),
              I: add_days(-m("PLANNED_G"), sna)},
        status=[(C, h_mr > m("MARKED_AS_READY_G"), GREEN),
                (C, h_mr >= m("MARKED_AS_READY_A"), AMBER),
                (C, h_mr < m("MARKED_AS_READY_R"), RED),
                (I, d_mr >= m("MARKED_AS_READY_G"), GREEN),
                (I, d_mr < m("MARKED_AS_READY_R"), RED)]))

    exp_pl_c = add_hours(-m("PLANNED_G"), m("PICKUP_END_DTTM"))
    act_pl_c = m("PLANNED_TIME")
    d_pl = days_between(m("SC_CT_SHIPMENT_START_DATE"), sna)
    out.append(Rule(
        "PLANNED",
        reached=[(C, m("SHIPMENT_ID_O").isNotNull() & m("SHIPMENT_STATUS").isin(*PLANNED_SHIPMENT_STATUSES)),
                 (I, m("SC_CT_SHIPMENT_START_DATE").isNotNull())],
        expected={C: exp_pl_c, I: add_days(-m("PLANNED_G"), sna)},
        actual={C: act_pl_c, I: m("SC_CT_SHIPMENT_START_DATE")},
        next={C: add_hours(-(transit_hours + m("IN_TRANSIT_G")), m("DELIV_DATE")),
              I: add_days(-m("IN_TRANSIT_G"), sna)},
        status=[(C, act_pl_c < exp_pl_c, GREEN),
                (C, act_pl_c <= add_hours(m("PLANNED_A"), m("PICKUP_END_DTTM")), AMBER),
                (C, act_pl_c > m("PICKUP_END_DTTM"), RED),
                (I, d_pl > m("PLANNED_G"), GREEN),
                (I, d_pl >= m("PLANNED_A"), AMBER),
                (I, d_pl < m("PLANNED_R"), RED)]))

    exp_it_c = add_hours(-(transit_hours + m("IN_TRANSIT_G")), m("DELIV_DATE"))
    act_it_c = m("ACTUAL_ORIGIN_DEPARTURE_DTTM")
    d_it_p = days_between(m("ACTUAL_SHIPPED_DTTM"), m("DELIV_START_DATE"))
    d_it_i = days_between(m("COB_TS"), sna)
    out.append(Rule(
        "IN_TRANSIT",
        reached=[(C, act_it_c.isNotNull()), (P, m("ACTUAL_SHIPPED_DTTM").isNotNull()),
                 (I, m("COB_TS").isNotNull())],
        expected={P: add_days(-m("IN_TRANSIT_G"), m("DELIV_START_DATE")),
                  I: add_days(-m("IN_TRANSIT_G"), sna),
                  C: exp_it_c},
        actual={P: m("ACTUAL_SHIPPED_DTTM"), I: m("COB_TS"), C: act_it_c},
        next={C: add_hours(-m("ON_YARD_G"), m("DELIV_DATE")),
              I: add_hours(-m("ON_YARD_G"), m("DELIV_DATE")),
              P: add_days(-m("ON_YARD_G"), m("DELIV_END_DATE"))},
        status=[(C, act_it_c < exp_it_c, GREEN),
                (C, act_it_c == exp_it_c, AMBER),
                (C, act_it_c > exp_it_c, RED),
                (P, d_it_p > m("IN_TRANSIT_G"), GREEN),
                (P, d_it_p == m("IN_TRANSIT_A"), AMBER),
                (P, d_it_p < m("IN_TRANSIT_R"), RED),
                (I, d_it_i > m("IN_TRANSIT_G"), GREEN),
                (I, d_it_i >= m("IN_TRANSIT_A"), AMBER),
                (I, d_it_i < m("IN_TRANSIT_R"), RED)]))

    h_oy_c = hours_between(keep_timestamp(m("ACTUAL_ON_YARD_DTTM")), keep_timestamp(m("DELIV_DATE")))
    d_oy_p = days_between(m("ACTUAL_ON_YARD_DTTM"), m("DELIV_END_DATE"))
    h_oy_i = hours_between(m("CARRIER_DROP_TS"), m("DELIV_DATE"))
    out.append(Rule(
        "ON_YARD",
        reached=[(C, m("ACTUAL_ON_YARD_DTTM").isNotNull()), (P, m("ACTUAL_ON_YARD_DTTM").isNotNull()),
                 (I, m("CARRIER_DROP_TS").isNotNull())],
        expected={C: add_hours(-m("ON_YARD_G"), m("DELIV_DATE")),
                  I: add_hours(-m("ON_YARD_G"), m("DELIV_DATE")),
                  P: add_days(-m("ON_YARD_G"), m("DELIV_END_DATE"))},
        actual={C: m("ACTUAL_ON_YARD_DTTM"), P: m("ACTUAL_ON_YARD_DTTM"), I: m("CARRIER_DROP_TS")},
        next={C: m("DELIV_DATE"), I: m("DELIV_DATE"), P: m("DELIV_END_DATE")},
        status=[(C, h_oy_c >= m("ON_YARD_G"), GREEN),
                (C, h_oy_c >= m("ON_YARD_A"), AMBER),
                (C, h_oy_c < m("ON_YARD_R"), RED),
                (P, d_oy_p >= m("ON_YARD_G"), GREEN),
                (P, d_oy_p < m("ON_YARD_R"), RED),
                (I, h_oy_i >= m("ON_YARD_G"), GREEN),
                (I, h_oy_i > m("ON_YARD_A"), AMBER),
                (I, h_oy_i < m("ON_YARD_R"), RED)]))

    d_rc = days_between(m("PO_RCVD_DATE"), m("DELIV_DATE"))
    received_status = []
    for t in (C, P, I):
        received_status += [(t, d_rc >= m("RECEIVED_G"), GREEN), (t, d_rc < m("RECEIVED_R"), RED)]
    out.append(Rule(
        "RECEIVED",
        reached=[(ANY, m("PO_FULL_RCVD_DATE").isNotNull()),
                 (ANY, (m("PO_DATE") < add_hours(-RECEIVED_AGE_HOURS, as_of)) & m("P_PO_NO").isNull())],
        expected={C: m("DELIV_DATE"), I: m("DELIV_DATE"), P: m("DELIV_END_DATE")},
        actual={ANY: m("PO_RCVD_DATE")},
        next={},
        status=received_status))
    return out


def shipment_key() -> Column:
    """Control-tower shipment for international POs, else TMS shipment, as text."""
    return F.when(_po_type() == F.lit(I), F.col("SC_CT_SHIPMENT_ID").cast("string")) \
        .otherwise(F.col("TC_SHIPMENT_ID").cast("string"))


def _rule_values(rule: Rule, ts_type: T.DataType) -> dict[str, Column]:
    """The eight per-milestone values of ``rule`` for the current row."""
    def ts(c):
        return c.cast(ts_type)

    expected = ts(_by_type(rule.expected))
    actual = ts(_by_type(rule.actual))
    if rule.has_delay:
        d = days_between(expected, actual)
        delay = F.when(d > 0, d).when(d <= 0, F.lit(0).cast("bigint"))
        revised = (F.when(_po_type().isin(C, I), add_days(delay, F.col("DELIV_DATE")))
                   .when(_po_type() == F.lit(P), add_days(delay, F.col("DELIV_END_DATE"))))
    else:
        delay = F.lit(None)
        revised = (F.when(_po_type().isin(C, I), F.col("DELIV_DATE"))
                   .when(_po_type() == F.lit(P), F.col("DELIV_END_DATE")))
    return {
        "EXPECTED_ETA_FOR_MILESTONE": expected,
        "ACTUAL_ETA_FOR_MILESTONE": actual,
        "NEXT_MILESTONE_EXPECTED_ETA": ts(_by_type(rule.next)),
        "CURRENT_DELAY_IN_DAYS": delay.cast("bigint"),
        "REVISED_ETA_FOR_PO": ts(revised),
        "MILESTONE_RANK": F.lit(rule.rank).cast("int"),
        "MILESTONE": _first_match(rule.reached, lambda _c: rule.name).cast("string"),
        "ADHERENCE_STATUS": _first_match(rule.status, lambda c: c[2]).cast("string"),
    }


def _clock(as_of, ts_type: T.DataType) -> Column:
    if as_of is None:
        return F.current_timestamp().cast(ts_type)
    if isinstance(as_of, Column):
        return as_of.cast(ts_type)
    # from text, so that the driver's zone does not matter
    return F.lit(str(as_of)).cast("timestamp_ntz").cast(ts_type)


def with_thresholds(m: DataFrame, thresholds: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """LEFT JOIN the per-type thresholds (J7), broadcast after a size check.

    One join for all seven rules instead of one per rule.
    """
    th = thresholds.select("PO_TYPE", *[F.col(c).alias(c) for c in THRESHOLD_COLUMNS])
    return m.join(broadcast_if_small(th, max_rows), "PO_TYPE", "left")


#: All times are zone-less, whatever the input has.
_TS = T.TimestampNTZType()


def milestones(m: DataFrame, thresholds: DataFrame, as_of=None,
               only: tuple[str, ...] | None = None) -> DataFrame:
    """All reached milestones of every input row, de-duplicated (K1).

    Output columns: ``MILESTONE_COLUMNS``.  ``only`` limits the rules (used
    to show a single milestone branch).

    The per-rule values are computed in stacked projections -- expected and
    actual first, then the day difference, then delay, then revised ETA --
    so each is evaluated once per row (a generator gets no common
    subexpression elimination, and the delay repeats the expected/actual
    expressions several times).  The ``inline`` then only references
    columns, and the Generate/Filter pair stays in whole-stage codegen.
    """
    ts_type = _TS
    clock = _clock(as_of, ts_type)
    x = with_thresholds(m, thresholds)
    chosen = [r for r in rules(clock) if only is None or r.name in only]
    base = [F.col("TC_PURCHASE_ORDERS_ID"), shipment_key().alias("TC_SHIPMENT_ID"), F.col("PO_TYPE"),
            F.col("DELIV_DATE"), F.col("DELIV_END_DATE")]
    step1 = []
    for r in chosen:
        k = r.rank
        step1 += [_by_type(r.expected).cast(ts_type).alias(f"__e{k}"),
                  _by_type(r.actual).cast(ts_type).alias(f"__a{k}"),
                  _by_type(r.next).cast(ts_type).alias(f"__n{k}"),
                  _first_match(r.reached, lambda _c, n=r.name: n).cast("string").alias(f"__m{k}"),
                  _first_match(r.status, lambda c: c[2]).cast("string").alias(f"__s{k}")]
    x = x.select(*base, *step1)
    x = x.withColumns({f"__d{r.rank}": days_between(F.col(f"__e{r.rank}"), F.col(f"__a{r.rank}"))
                       for r in chosen if r.has_delay})
    delay = {}
    for r in chosen:
        d = F.col(f"__d{r.rank}")
        delay[f"__l{r.rank}"] = (F.when(d > 0, d).when(d <= 0, F.lit(0).cast("bigint"))
                                 if r.has_delay else F.lit(None).cast("bigint"))
    x = x.withColumns(delay)
    t = _po_type()
    revised = {}
    for r in chosen:
        k = r.rank
        if r.has_delay:
            rv = (F.when(t.isin(C, I), add_days(F.col(f"__l{k}"), F.col("DELIV_DATE")))
                  .when(t == F.lit(P), add_days(F.col(f"__l{k}"), F.col("DELIV_END_DATE"))))
        else:
            rv = F.when(t.isin(C, I), F.col("DELIV_DATE")).when(t == F.lit(P), F.col("DELIV_END_DATE"))
        revised[f"__r{k}"] = rv.cast(ts_type)
    x = x.withColumns(revised)
    structs = [F.struct(F.col(f"__e{r.rank}").alias("EXPECTED_ETA_FOR_MILESTONE"),
                        F.col(f"__a{r.rank}").alias("ACTUAL_ETA_FOR_MILESTONE"),
                        F.col(f"__n{r.rank}").alias("NEXT_MILESTONE_EXPECTED_ETA"),
                        F.col(f"__l{r.rank}").alias("CURRENT_DELAY_IN_DAYS"),
                        F.col(f"__r{r.rank}").alias("REVISED_ETA_FOR_PO"),
                        F.lit(r.rank).cast("int").alias("MILESTONE_RANK"),
                        F.col(f"__m{r.rank}").alias("MILESTONE"),
                        F.col(f"__s{r.rank}").alias("ADHERENCE_STATUS")) for r in chosen]
    x = x.select("TC_PURCHASE_ORDERS_ID", "TC_SHIPMENT_ID", "PO_TYPE", F.inline(F.array(*structs)))
    return x.where(non_blank("MILESTONE")).select(*MILESTONE_COLUMNS).dropDuplicates()


def milestone_branch(m: DataFrame, thresholds: DataFrame, name: str, as_of=None) -> DataFrame:
    """One branch of the reference: the rows of one milestone (M1 - M7)."""
    ts_type = _TS
    clock = _clock(as_of, ts_type)
    rule = next(r for r in rules(clock) if r.name == name)
    x = with_thresholds(m, thresholds)
    vals = _rule_values(rule, ts_type)
    x = x.select(F.col("TC_PURCHASE_ORDERS_ID"), shipment_key().alias("TC_SHIPMENT_ID"),
                 F.col("PO_TYPE"), *[v.alias(k) for k, v in vals.items()])
    return x.where(non_blank("MILESTONE")).select(*MILESTONE_COLUMNS)


def milestones_by_union(m: DataFrame, thresholds: DataFrame, as_of=None) -> DataFrame:
    """The literal seven-branch UNION (DISTINCT), for tests and comparison."""
    out = None
    for name in MILESTONE_NAMES:
        b = milestone_branch(m, thresholds, name, as_of)
        out = b if out is None else out.union(b)
    return out.distinct()


def rank_name(rank: Column) -> Column:
    """Milestone name of a rank 1..7; NULL otherwise."""
    expr = None
    for i, n in enumerate(MILESTONE_NAMES, start=1):
        expr = F.when(rank == i, F.lit(n)) if expr is None else expr.when(rank == i, F.lit(n))
    return expr


def po_summary(ms: DataFrame, first_red_status: str = "RED") -> DataFrame:
    """Per PO: lowest AMBER rank, lowest ``first_red_status`` rank, top rank (K2, K3).

    A plain aggregate: each map task sends one partial row per PO, however many
    rows the PO has there, and the partial rows are merged after the exchange.
    """
    r, st = F.col("MILESTONE_RANK"), F.col("ADHERENCE_STATUS")
    return (ms.groupBy("TC_PURCHASE_ORDERS_ID")
            .agg(F.min(F.when(st == F.lit(AMBER), r)).alias("FIRST_AMBER"),
                 F.min(F.when(st == F.lit(first_red_status), r)).alias("FIRST_RED"),
                 F.max(r).alias("TOP_RANK")))


def first_status_by_po(ms: DataFrame, status: str, alias: str) -> DataFrame:
    """Per PO: name of the lowest-rank milestone with ``status`` (K2 report)."""
    return po_summary(ms, status).select(F.col("TC_PURCHASE_ORDERS_ID").alias("ORDER_NO"),
                                         rank_name(F.col("FIRST_RED")).alias(alias))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``, in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def silver(ms: DataFrame, as_of=None, first_red_status: str = "RED", heavy: Sequence[Heavy] = ()) -> DataFrame:
    """The silver milestone table (M8, ``SILVER_SCHEMA``) from de-duplicated milestones.

    The per-PO values (K2, K3) come from ``po_summary`` joined back on PO, so no
    task buffers a PO as a window would; ``ms`` is read twice and should be a
    written table (``plans.silver_job``).  Rows of ``heavy`` POs are dealt over the
    tasks and meet their one summary row there.  A NULL PO has no summary, as in
    the original equi-joins.  ``first_red_status`` names the status
    FIRST_MILESTONE_TO_RED looks for; the original job looks for 'AMBER' there,
    pass that to reproduce its table.
    """
    summary = po_summary(ms, first_red_status)
    on = [("TC_PURCHASE_ORDERS_ID", "TC_PURCHASE_ORDERS_ID")]
    if heavy:
        hot = is_heavy("TC_PURCHASE_ORDERS_ID", heavy)
        one = [Heavy(h.key, h.left * h.right) for h in heavy]  # as many stripes as the PO has cells
        x = left_join(ms.where(~hot), summary.where(~hot), on, spread_by="TC_SHIPMENT_ID") \
            .unionByName(split_left_join(ms.where(hot), summary.where(hot), on, one))
    else:
        # on the bare key, which a table in buckets of it meets without an exchange
        x = left_join(ms, summary, on, spread_null_keys=False)
    t, rank = F.col("PO_TYPE"), F.col("MILESTONE_RANK")
    out = x.withColumns({
        "ORDER_NO": F.col("TC_PURCHASE_ORDERS_ID"),
        "ACTIVE_STATUS": F.when(rank == F.col("TOP_RANK"), "ACTIVE").otherwise("INACTIVE"),
        "FIRST_MILESTONE_TO_AMBER": rank_name(F.col("FIRST_AMBER")),
        "FIRST_MILESTONE_TO_RED": rank_name(F.col("FIRST_RED")),
        "CDC_TIMESTAMP": _clock(as_of, _TS),
        "RECORD_TYPE": F.when(t.isin(C, P), F.lit("PO")).when(t == F.lit(I), F.lit("SHIPMENT")),
        "isCanceled": F.lit(None), "ETL_CREATED_DTTM": F.lit(None), "ETL_UPDATED_DTTM": F.lit(None)})
    return conform(out, SILVER_SCHEMA)
