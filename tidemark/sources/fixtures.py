"""Source views over the TPC-H-style test tables.

Each recipe derives one bronze source of the milestone job from the
read-only test tables (``orders``, ``lineitem``).  The text runs unchanged in
Spark SQL and DuckDB, so the Spark queries and the SQL oracle read equal rows.
These are fixed values (test-data recipes); keep them exactly as written.
"""

from __future__ import annotations

from ..session import staged_by

# One SQL recipe per source view, in build order.
RECIPES: dict[str, str] = {
    "purchase_orders": (
        "select concat('PO',cast(o_orderkey as string)) tc_purchase_orders_id, o_orderkey purchase_orders_id, case when o_orderkey%20=7 then 'EDI' else 'SAP' end created_source, concat(case when o_orderkey%9=4 then '57' else '10' end, cast(o_orderkey%10 as string)) o_facility_alias_id, concat('20',cast(o_custkey%10 as string)) d_facility_alias_id, o_custkey business_partner_id, case when o_orderkey%97=0 then null when o_orderkey%5=0 then 'CN' when o_orderkey%5=1 then 'CA' else 'US' end o_country_code, 'US' d_country_code, case when o_orderkey%11=10 then null else cast(o_orderkey%2 as int) end billing_method, o_orderdate created_dttm, (o_orderdate + INTERVAL '1' DAY * (1)) last_updated_dttm, concat('CITY',cast(o_custkey%10 as string)) d_city, concat('CITY',cast(o_orderkey%10 as string)) o_city, concat('ST',cast(o_orderkey%4 as string)) o_state_prov from orders"
    ),
    "purchase_order_line": (
        "select concat('PO',cast(o_orderkey as string)) po_no, concat('T',cast(l_linenumber%2 as string)) po_tracking_no, (o_orderdate + INTERVAL '1' DAY * (cast(30 + o_orderkey % 20 as int))) deliv_date, (o_orderdate + INTERVAL '1' DAY * (cast(10+o_orderkey%5 as int))) ship_start_date, (o_orderdate + INTERVAL '1' DAY * (cast(15 + o_orderkey % 5 as int))) ship_end_date, ((o_orderdate + INTERVAL '1' DAY * (cast(30 + o_orderkey % 20 as int))) + INTERVAL '1' DAY * (-2)) deliv_start_date, ((o_orderdate + INTERVAL '1' DAY * (cast(30 + o_orderkey % 20 as int))) + INTERVAL '1' DAY * (1)) deliv_end_date, cast(l_extendedprice as decimal(18,2)) po_line_unit_price, cast(l_quantity as decimal(18,2)) po_line_order_qty, cast(case when l_returnflag = 'R' then 0 else l_quantity end as decimal(18,2)) po_line_rcvd_qty, cast(l_quantity * 2 as decimal(18,2)) po_total_weight, cast(l_tax as decimal(18,2)) po_total_volume, case when o_orderkey%4=3 or (o_orderkey%3=0 and l_linenumber=3) then null else ((o_orderdate + INTERVAL '1' DAY * (cast(30 + o_orderkey % 20 as int))) + INTERVAL '1' DAY * (cast(o_orderkey%9-4 as int))) end po_line_max_rcvd_date, case when o_orderkey%2=0 then 'L' else 'T' end freight_type_code, l_linestatus po_line_move_type_code from lineitem join orders on l_orderkey = o_orderkey"
    ),
    "pending_po_line": (
        "select concat('PO',cast(o_orderkey as string)) po_no, l_linenumber line from lineitem join orders on l_orderkey = o_orderkey where o_orderkey%6<>5"
    ),
    "export_order": (
        "select concat('PO',cast(o_orderkey as string)) sc_exp_po_no, l_partkey article_no, (o_orderdate + INTERVAL '1' DAY * (25)) ship_not_after, (o_orderdate + INTERVAL '1' DAY * (15)) ship_not_before, case when o_orderkey%7=3 then null else ((o_orderdate + INTERVAL '1' DAY * (25)) + INTERVAL '1' DAY * (cast(-(o_orderkey%30) as int))) end vendor_booked_date, ((o_orderdate + INTERVAL '1' DAY * (25)) + INTERVAL '1' DAY * (cast(-(o_orderkey%20) as int))) cargo_ready_date from lineitem join orders on l_orderkey = o_orderkey where o_orderkey%5=0 or o_orderkey%9=4"
    ),
    "ct_shipment": (
        "select concat('S',cast(o_orderkey as string),'-',cast(l_linenumber%2 as string)) sc_ct_shipment_id, concat('PO',cast(o_orderkey as string)) tsc_po_no, l_partkey article_no, case when o_orderkey%13=5 then null else ((o_orderdate + INTERVAL '1' DAY * (25)) + INTERVAL '1' DAY * (cast(-(o_orderkey%12) as int))) end shipment_start_date from lineitem join orders on l_orderkey = o_orderkey where o_orderkey%5=0 and l_linenumber%3<>2"
    ),
    "ct_shipment_event": (
        "select distinct concat('S',cast(o_orderkey as string),'-',cast(l_linenumber%2 as string)) sc_ct_shipment_id, code event_code, case when code='COB' then ((o_orderdate + INTERVAL '1' DAY * (25)) + INTERVAL '1' DAY * (cast(-(o_orderkey%6) as int))) else ((o_orderdate + INTERVAL '1' DAY * (cast(30 + o_orderkey % 20 as int))) + INTERVAL '1' HOUR * (cast(10 - o_orderkey%60 as int))) end event_ts from lineitem join orders on l_orderkey = o_orderkey cross join (values ('COB'),('DROP'),('CARRDROP'),('OTHER')) c(code) where o_orderkey%5=0 and o_orderkey%17<>2"
    ),
    "order_master_order": (
        "select concat('PO',cast(o_orderkey as string)) tc_master_order_id, o_orderkey order_id from orders where o_orderkey%8<>3"
    ),
    "tlm_orders": (
        "select o_orderkey order_id, concat('10',cast(o_orderkey%10 as string)) o_facility_alias_id, o_orderkey+500000 shipment_id, concat('TS',cast(o_orderkey as string)) tc_shipment_id, ((o_orderdate + INTERVAL '1' DAY * (cast(15 + o_orderkey % 5 as int))) + INTERVAL '1' HOUR * (cast(-(o_orderkey%100) as int))) created_dttm from orders where o_orderkey%16<>5"
    ),
    "tlm_shipment": (
        "select o_orderkey+500000 shipment_id, cast(50 + 10*(o_orderkey%5) as int) shipment_status, (o_orderdate + INTERVAL '1' DAY * (12)) status_change_dttm, concat('TR',cast(o_orderkey%50 as string)) trailer_number from orders"
    ),
    "rts_line_item": (
        "select o_orderkey order_id, ((o_orderdate + INTERVAL '1' DAY * (cast(15 + o_orderkey % 5 as int))) + INTERVAL '1' DAY * (1)) pickup_end_dttm from orders where o_orderkey%14<>6"
    ),
    "stop": (
        "select o_orderkey+500000 shipment_id, f facility_alias_id, s stop_seq, ((o_orderdate + INTERVAL '1' DAY * (cast(15 + o_orderkey % 5 as int))) + INTERVAL '1' DAY * (1)) departure_start_dttm, ((o_orderdate + INTERVAL '1' DAY * (cast(30 + o_orderkey % 20 as int))) + INTERVAL '1' HOUR * (-6)) arrival_start_dttm from (select *, 1 s, concat('10',cast(o_orderkey%10 as string)) f from orders union all select *, 2 s, concat('20',cast(o_custkey%10 as string)) f from orders) x"
    ),
    "tracking_message": (
        "select o_orderkey+500000 shipment_id, s stop_seq, 10 message_status, t message_type, case when t=50 then ((o_orderdate + INTERVAL '1' DAY * (cast(15 + o_orderkey % 5 as int))) + INTERVAL '1' HOUR * (cast(4 + o_orderkey%47 as int))) else ((o_orderdate + INTERVAL '1' DAY * (cast(30 + o_orderkey % 20 as int))) + INTERVAL '1' HOUR * (cast(-(o_orderkey%72)+20 as int))) end event_dttm from orders cross join (values (1,50),(2,45),(2,50)) m(s,t) where o_orderkey%7<>t%7"
    ),
    "shipment_event": (
        "select o_orderkey+500000 shipment_id, 'STATUS' field_name, v new_value, ((o_orderdate + INTERVAL '1' DAY * (cast(15 + o_orderkey % 5 as int))) + INTERVAL '1' HOUR * (cast(o_orderkey%60 - 30 as int))) created_dttm from orders cross join (values ('Assigned'),('Accepted')) e(v) where o_orderkey%10<>9"
    ),
    "asn": (
        "select concat('TS',cast(o_orderkey as string)) tc_shipment_id, ((o_orderdate + INTERVAL '1' DAY * (cast(30 + o_orderkey % 20 as int))) + INTERVAL '1' DAY * (cast(-(o_orderkey%9) as int))) actual_shipped_dttm from orders cross join (values (1),(2)) n(i) where o_orderkey%12<>1"
    ),
    "config_milestone_status": (
        "select * from (values ('COLLECT',0,0,0,72,48,48,24,0,0,4,0,0,24,0,0,0,0),('PREPAID',0,0,0,0,0,0,0,0,0,3,3,3,1,1,1,0,0),('INTERNATIONAL',20,10,10,10,10,10,7,3,3,4,2,2,24,0,0,0,0)) c(po_type,vendor_booked_g,vendor_booked_a,vendor_booked_r,marked_as_ready_g,marked_as_ready_a,marked_as_ready_r,planned_g,planned_a,planned_r,in_transit_g,in_transit_a,in_transit_r,on_yard_g,on_yard_a,on_yard_r,received_g,received_r)"
    ),
}

# Raw test tables the recipes read.
RAW_TABLES = ("orders", "lineitem")
# The columns of them that the recipes read, the order key first.
RAW_COLUMNS = {"orders": ("o_orderkey", "o_custkey", "o_orderdate"),
               "lineitem": ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax",
                            "l_returnflag", "l_linestatus")}


def register_raw(spark, sf_dir: str, by_order: bool = False) -> None:
    """Register the raw parquet tables the recipes read as temp views.

    With ``by_order`` their rows are first written in buckets of the order key, so
    that recipes that join the two need no exchange: for jobs that read many of them.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in RAW_TABLES:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if by_order:
            key = RAW_COLUMNS[name][0]
            df = staged_by(df.select(*RAW_COLUMNS[name]).repartition(n, key), name, key)
        df.createOrReplaceTempView(name)


def register_views(spark, sf_dir: str, by_order: bool = False) -> dict:
    """Register every source view in ``spark`` and return name -> DataFrame.

    The views are lazy: each query plans only the sources it touches, and
    Catalyst prunes the columns a query does not read.
    """
    register_raw(spark, sf_dir, by_order)
    frames = {}
    for name, sql in RECIPES.items():
        df = spark.sql(sql)
        df.createOrReplaceTempView(name)
        frames[name] = df
    return frames


def with_views(names, body: str) -> str:
    """Prefix ``body`` with a WITH clause holding the named source views.

    Used for the DuckDB oracle, where only the raw tables are registered.
    """
    ctes = ",\n".join(f"{n} AS ({RECIPES[n]})" for n in names)
    body = body.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
