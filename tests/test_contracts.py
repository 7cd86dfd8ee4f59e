"""Column contracts of the bronze sources."""
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.plans.silver_job import silver_milestones
from tidemark.sources import bronze as br
from tidemark.sources import contracts as ct
from tidemark.sources.sinks import replace_table

AS_OF = "2000-01-01 00:00:00"
_KIND = {"time": T.TimestampNTZType(), "code": T.IntegerType(), "amount": T.DecimalType(18, 2), "text": T.StringType(),
         "any": T.BooleanType()}


def schemas(delivered=True, **types):
    """Schemas that meet the contracts; ``source__COLUMN=type`` changes or, with None, removes a column."""
    out = {}
    for source, fields in ct.CONTRACTS.items():
        cols = []
        for f in fields:
            t = types.get(f"{source}__{f.name}", _KIND.get(f.kind, T.StringType()))
            if t is not None:
                cols.append(T.StructField(f.accepted[0] if delivered else f.name.lower(), t))
        out[source] = T.StructType(cols + [T.StructField("EXTRA", T.BinaryType())])
    return out


def faults(s, **kw):
    with pytest.raises(ct.ContractError) as e:
        ct.resolve(s, **kw)
    return e.value.faults


def test_delivered_and_plain_names_in_any_case():
    for delivered in (True, False):
        picks = ct.resolve(schemas(delivered))
        assert {n: tuple(p.name for p in ps) for n, ps in picks.items()} == br.SOURCES
        assert all(p.cast is None for ps in picks.values() for p in ps)
    by_name = {p.name: p.source for p in ct.resolve(schemas())["export_order"]}
    assert by_name["SHIP_NOT_AFTER"] == "SC_EXP_SHIP_NOT_AFTER_DATE" and by_name["ARTICLE_NO"] == "ARTICLE_NO"


def test_all_faults_of_all_sources_at_once():
    s = schemas(asn__ACTUAL_SHIPPED_DTTM=None, stop__ARRIVAL_START_DTTM=T.StringType(), tlm_shipment__SHIPMENT_STATUS=T.DoubleType(),
                purchase_order_line__PO_LINE_UNIT_PRICE=T.DoubleType(), shipment_event__NEW_VALUE=T.LongType(),
                tlm_orders__SHIPMENT_ID=T.LongType())
    del s["pending_po_line"]
    s["ct_shipment_event"] = s["ct_shipment_event"].add("event_code", T.StringType())
    got = faults(s)
    assert len(got) == 8
    for part in ("pending_po_line: no such source", "asn.ACTUAL_SHIPPED_DTTM: missing", "stop.ARRIVAL_START_DTTM: is string",
                 "SHIPMENT_STATUS: is double", "PO_LINE_UNIT_PRICE: is double", "NEW_VALUE: is bigint",
                 "ambiguous (SC_CT_SHIPMENT_EVENT_CODE, event_code)",
                 "joined keys must all be text or all be whole numbers: tlm_orders.SHIPMENT_ID bigint, tlm_shipment.SHIPMENT_ID string"):
        assert any(part in f for f in got), part


def test_keys_of_a_domain_get_one_type():
    ids = {f"{s}__SHIPMENT_ID": T.IntegerType() for s in ("tlm_orders", "tlm_shipment", "stop", "tracking_message", "shipment_event")}
    assert all(p.cast is None for ps in ct.resolve(schemas(**ids)).values() for p in ps)
    picks = ct.resolve(schemas(**ids | {"stop__SHIPMENT_ID": T.LongType()}))
    casts = {s: p.cast for s, ps in picks.items() for p in ps if p.name == "SHIPMENT_ID"}
    assert casts == {s: None if s == "stop" else "bigint" for s in casts}
    picks = ct.resolve(schemas(**ids | {"stop__SHIPMENT_ID": T.DecimalType(38, 0)}))
    assert {p.cast for ps in picks.values() for p in ps if p.name == "SHIPMENT_ID"} == {None, "decimal(38,0)"}
    assert "joined keys" in faults(schemas(**ids | {"stop__SHIPMENT_ID": T.DecimalType(38, 2)}))[0]
    assert "joined keys" in faults(schemas(**ids | {"stop__SHIPMENT_ID": T.DoubleType()}))[0]


def test_times():
    picks = ct.resolve(schemas(asn__ACTUAL_SHIPPED_DTTM=T.DateType(), stop__ARRIVAL_START_DTTM=T.TimestampType()))
    assert [p.cast for p in picks["asn"]] == [None, "timestamp_ntz"]
    got = faults(schemas(asn__ACTUAL_SHIPPED_DTTM=T.DateType(), stop__ARRIVAL_START_DTTM=T.TimestampType()), zone="America/Chicago")
    assert len(got) == 1 and "not unique in session zone America/Chicago" in got[0]


def test_names_chosen_by_the_caller():
    s = schemas(asn__ACTUAL_SHIPPED_DTTM=None)
    s["asn"] = s["asn"].add("Shipped.At", T.TimestampNTZType())
    picks = ct.resolve(s, columns={"asn": {"actual_shipped_dttm": "shipped.at"}})
    assert [(p.source, p.name) for p in picks["asn"]] == [("TC_SHIPMENT_ID", "TC_SHIPMENT_ID"), ("Shipped.At", "ACTUAL_SHIPPED_DTTM")]
    assert faults(s, columns={"asn": {"SHIPPED": "x", "ACTUAL_SHIPPED_DTTM": "nope"}}) == [
        "asn: the contract has no column SHIPPED", "asn.nope: missing"]
    assert len(faults({})) == len(ct.CONTRACTS)


def test_bind_quotes_names_and_drops_other_columns(spark):
    frames = {n: spark.createDataFrame([], s) for n, s in schemas().items()}
    frames["asn"] = spark.createDataFrame([("a", "2024-01-02", 1)], "tc_shipment_id string, `odd ``name.x` string, n int") \
        .withColumn("odd `name.x", F.col("`odd ``name.x`").cast("date"))
    b = br.from_frames(frames, {"asn": {"ACTUAL_SHIPPED_DTTM": "odd `name.x"}})
    row = b.asn.first()
    assert b.asn.columns == ["TC_SHIPMENT_ID", "ACTUAL_SHIPPED_DTTM"] and str(row.ACTUAL_SHIPPED_DTTM) == "2024-01-02 00:00:00"


def test_tables_with_delivered_names_and_types_run_the_job(spark, bronze):
    """The 14 sources as delivered: real names, decimal ids, dates; nothing renamed by the user."""
    want = silver_milestones(bronze, AS_OF, "AMBER")
    names = {}
    for source, df in bronze.items():
        df = ct.as_delivered(source, df)
        for f in ct.CONTRACTS[source]:
            if isinstance(df.schema[f.accepted[0]].dataType, (T.IntegerType, T.LongType)):
                df = df.withColumn(f.accepted[0], F.col(f.accepted[0]).cast("decimal(38,0)"))
        names[source] = f"delivered_{source}_{uuid.uuid4().hex[:6]}"
        replace_table(spark, df.withColumn("ETL_CREATED_DTTM", F.current_timestamp()), names[source])
    assert "SC_EXP_SHIP_NOT_AFTER_DATE" in spark.table(names["export_order"]).columns
    got = silver_milestones(br.from_tables(spark, names), AS_OF, "AMBER")
    assert got.schema == want.schema
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
