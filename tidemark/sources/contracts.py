"""Column contracts of the bronze sources.

A contract lists, per source, the columns the milestone job reads: the name the
operators use, the names the column may be delivered under, and its kind.
``resolve`` matches the contracts against schemas alone and reports every fault of
every source at once, before anything is scanned; ``bind`` applies the result as one
projection per source, which the optimizer folds into the scans.

Names match whatever their case.  Casts are made only where they lose nothing:

``key:<domain>``  columns that are joined with each other and so need one type:
                  text on all sides, or whole numbers (integers and decimals of
                  scale 0), which are widened to the largest of the domain
``time``          ``timestamp_ntz``; dates become midnight; zoned timestamps their
                  wall clock, in a UTC session only (elsewhere an hour repeats)
``code``          whole numbers, as they are
``amount``        whole numbers and decimals, as they are (sums stay exact)
``text``          strings
``any``           carried through, never computed with

Other columns of a table are left out.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.milestones import THRESHOLD_COLUMNS


@dataclass(frozen=True)
class Field:
    name: str                    # as the operators know it
    kind: str
    accepted: tuple[str, ...]    # names it may be delivered under, the usual one first


def _fields(*specs: tuple[str, ...]) -> tuple[Field, ...]:
    """(kind, name) or (kind, name, delivered name)."""
    return tuple(Field(s[1], s[0], (*s[2:], s[1])) for s in specs)


# The columns read of each source and the names they are delivered under.
CONTRACTS: dict[str, tuple[Field, ...]] = {
    "purchase_orders": _fields(
        ("key:po", "TC_PURCHASE_ORDERS_ID"), ("key:order", "PURCHASE_ORDERS_ID"), ("text", "CREATED_SOURCE"),
        ("any", "O_FACILITY_ALIAS_ID"), ("key:facility", "D_FACILITY_ALIAS_ID"), ("any", "BUSINESS_PARTNER_ID"),
        ("any", "O_CITY"), ("any", "O_STATE_PROV"), ("text", "O_COUNTRY_CODE"), ("any", "D_CITY"),
        ("text", "D_COUNTRY_CODE"), ("code", "BILLING_METHOD"), ("time", "CREATED_DTTM"), ("time", "LAST_UPDATED_DTTM")),
    "purchase_order_line": _fields(
        ("key:po", "PO_NO"), ("any", "PO_TRACKING_NO"), ("time", "DELIV_DATE"), ("time", "SHIP_START_DATE"),
        ("time", "SHIP_END_DATE"), ("time", "DELIV_START_DATE"), ("time", "DELIV_END_DATE"),
        ("amount", "PO_LINE_UNIT_PRICE"), ("amount", "PO_LINE_ORDER_QTY"), ("amount", "PO_LINE_RCVD_QTY"),
        ("amount", "PO_TOTAL_WEIGHT"), ("amount", "PO_TOTAL_VOLUME"), ("any", "FREIGHT_TYPE_CODE"),
        ("any", "PO_LINE_MOVE_TYPE_CODE"), ("time", "PO_LINE_MAX_RCVD_DATE")),
    "pending_po_line": _fields(("key:po", "PO_NO")),
    "export_order": _fields(
        ("key:po", "SC_EXP_PO_NO"), ("key:article", "ARTICLE_NO"),
        ("time", "SHIP_NOT_AFTER", "SC_EXP_SHIP_NOT_AFTER_DATE"), ("time", "SHIP_NOT_BEFORE", "SC_EXP_SHIP_NOT_BEFORE_DATE"),
        ("time", "VENDOR_BOOKED_DATE", "SC_EXP_VENDOR_BOOKED_DATE"), ("time", "CARGO_READY_DATE", "SC_EXP_CARGO_READY_DATE")),
    "ct_shipment": _fields(
        ("key:ct_shipment", "SC_CT_SHIPMENT_ID"), ("key:po", "TSC_PO_NO"), ("key:article", "ARTICLE_NO"),
        ("time", "SHIPMENT_START_DATE", "SC_CT_SHIPMENT_START_DATE")),
    "ct_shipment_event": _fields(
        ("key:ct_shipment", "SC_CT_SHIPMENT_ID"), ("text", "EVENT_CODE", "SC_CT_SHIPMENT_EVENT_CODE"),
        ("time", "EVENT_TS", "SC_CT_SHIPMENT_EVENT_TS")),
    "order_master_order": _fields(("key:po", "TC_MASTER_ORDER_ID"), ("key:order", "ORDER_ID")),
    "tlm_orders": _fields(
        ("key:order", "ORDER_ID"), ("key:facility", "O_FACILITY_ALIAS_ID"), ("key:shipment", "SHIPMENT_ID"),
        ("key:tc_shipment", "TC_SHIPMENT_ID"), ("time", "CREATED_DTTM")),
    "tlm_shipment": _fields(
        ("key:shipment", "SHIPMENT_ID"), ("code", "SHIPMENT_STATUS"), ("time", "STATUS_CHANGE_DTTM"), ("any", "TRAILER_NUMBER")),
    "rts_line_item": _fields(("key:order", "ORDER_ID"), ("time", "PICKUP_END_DTTM")),
    "stop": _fields(
        ("key:shipment", "SHIPMENT_ID"), ("key:facility", "FACILITY_ALIAS_ID"), ("key:stop", "STOP_SEQ"),
        ("time", "DEPARTURE_START_DTTM"), ("time", "ARRIVAL_START_DTTM")),
    "tracking_message": _fields(
        ("key:shipment", "SHIPMENT_ID"), ("key:stop", "STOP_SEQ"), ("code", "MESSAGE_TYPE"), ("code", "MESSAGE_STATUS"),
        ("time", "EVENT_DTTM")),
    "shipment_event": _fields(
        ("key:shipment", "SHIPMENT_ID"), ("text", "FIELD_NAME"), ("text", "NEW_VALUE"), ("time", "CREATED_DTTM")),
    "asn": _fields(("key:tc_shipment", "TC_SHIPMENT_ID"), ("time", "ACTUAL_SHIPPED_DTTM")),
    "config_milestone_status": _fields(("text", "PO_TYPE"), *(("code", c) for c in THRESHOLD_COLUMNS)),
}


@dataclass(frozen=True)
class Pick:
    """One column of the projection: where it comes from, what it becomes."""
    source: str          # name in the table
    name: str            # name in the contract
    cast: str | None     # type to cast to, None to leave it


class ContractError(ValueError):
    """The schemas do not meet the contracts; ``faults`` lists all there are."""

    def __init__(self, faults: list[str]):
        self.faults = faults
        super().__init__("\n".join([f"{len(faults)} faults in the bronze sources:", *faults]))


def _digits(t: T.DataType) -> int | None:
    """Decimal digits a whole-number type may need; None for other types."""
    if isinstance(t, T.DecimalType):
        return t.precision if t.scale == 0 else None
    return {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}.get(type(t))


def _cast(kind: str, t: T.DataType, zone: str) -> tuple[str | None, str | None]:
    """(type to cast to, fault) of a column that is no key."""
    if kind == "time":
        if isinstance(t, T.TimestampNTZType):
            return None, None
        if isinstance(t, T.DateType):
            return "timestamp_ntz", None
        if isinstance(t, T.TimestampType):
            if zone in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
                return "timestamp_ntz", None
            return None, f"is a zoned timestamp, whose wall clock is not unique in session zone {zone}; set it to UTC"
        return None, f"is {t.simpleString()}, not a time"
    if kind == "code" and _digits(t) is None:
        return None, f"is {t.simpleString()}, not a whole number"
    if kind == "amount" and _digits(t) is None and not isinstance(t, T.DecimalType):
        return None, f"is {t.simpleString()}, not an exact number"
    if kind == "text" and not isinstance(t, T.StringType):
        return None, f"is {t.simpleString()}, not text"
    return None, None


def _domain_type(members: list[tuple[str, T.DataType]]) -> tuple[str | None, str | None]:
    """(common type or None to leave all as they are, fault) of joined keys."""
    if all(isinstance(t, T.StringType) for _, t in members):
        return None, None
    digits = [_digits(t) for _, t in members]
    if None in digits:
        found = ", ".join(f"{where} {t.simpleString()}" for where, t in members)
        return None, f"joined keys must all be text or all be whole numbers: {found}"
    kinds = {t.simpleString() for _, t in members}
    if len(kinds) == 1:
        return None, None
    if any(isinstance(t, T.DecimalType) for _, t in members):
        return f"decimal({max(digits)},0)", None
    return "bigint", None


def resolve(schemas: Mapping[str, T.StructType], zone: str = "UTC",
            columns: Mapping[str, Mapping[str, str]] | None = None) -> dict[str, list[Pick]]:
    """Projection per source that meets its contract.

    ``columns`` names delivered columns where the accepted names do not do:
    ``{"asn": {"ACTUAL_SHIPPED_DTTM": "SHIPPED_AT"}}``.  Raises ContractError with
    all faults: sources and columns missing, names that fit twice, types that
    cannot be cast without loss, joined keys of different kinds.
    """
    faults, found, domains = [], [], defaultdict(list)
    for source, fields in CONTRACTS.items():
        if source not in schemas:
            faults.append(f"{source}: no such source given")
            continue
        by_name = defaultdict(list)
        for f in schemas[source].fields:
            by_name[f.name.upper()].append(f)
        chosen = {k.upper(): v for k, v in ((columns or {}).get(source) or {}).items()}
        for wrong in sorted(set(chosen) - {f.name for f in fields}):
            faults.append(f"{source}: the contract has no column {wrong}")
        for field in fields:
            names = (chosen[field.name],) if field.name in chosen else field.accepted
            hits = [f for n in names for f in by_name[n.upper()]]
            if len(hits) != 1:
                what = "missing" if not hits else f"ambiguous ({', '.join(h.name for h in hits)})"
                faults.append(f"{source}.{' or '.join(names)}: {what}")
                continue
            if field.kind.startswith("key:"):
                domains[field.kind[4:]].append((f"{source}.{hits[0].name}", hits[0].dataType))
            found.append((source, field, hits[0]))
    common = {}
    for domain, members in domains.items():
        common[domain], fault = _domain_type(members)
        if fault:
            faults.append(fault)
    out: dict[str, list[Pick]] = {source: [] for source in CONTRACTS}
    for source, field, hit in found:
        if field.kind.startswith("key:"):
            cast = common[field.kind[4:]]
        else:
            cast, fault = _cast(field.kind, hit.dataType, zone)
            if fault:
                faults.append(f"{source}.{hit.name}: {fault}")
        out[source].append(Pick(hit.name, field.name, None if cast == hit.dataType.simpleString() else cast))
    if faults:
        raise ContractError(faults)
    return out


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bind(frames: Mapping[str, DataFrame], columns: Mapping[str, Mapping[str, str]] | None = None) -> dict[str, DataFrame]:
    """The frames with the columns of their contracts, in contract order."""
    zone = next(iter(frames.values())).sparkSession.conf.get("spark.sql.session.timeZone") if frames else "UTC"
    picks = resolve({n: df.schema for n, df in frames.items()}, zone, columns)

    def column(p: Pick):
        c = F.col(_quoted(p.source))
        return (c.cast(p.cast) if p.cast else c).alias(p.name)
    return {source: frames[source].select(*[column(p) for p in ps]) for source, ps in picks.items()}


def as_delivered(source: str, df: DataFrame) -> DataFrame:
    """``df`` with contract names under the names columns are usually delivered."""
    return df.withColumnsRenamed({c: f.accepted[0] for f in CONTRACTS[source]
                                  for c in df.columns if c.upper() == f.name})
