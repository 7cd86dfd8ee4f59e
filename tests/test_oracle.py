"""Registered queries against their DuckDB SQL on the smallest tables."""
import math
import numbers

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tidemark.plans import catalog

SF = "/root/testdata/sf0.001"
FAST = ["m8_silver", "m8_silver_red", "k1_union_distinct", "m0_po_type", "m0b_po_lines", "m0c_ct_shipments",
        "m0f_po_context", "m0j_milestone_input", "a7_stop_times", "j5_double_join", "j6_exists_flag",
        "p6_not_and_null", "f7_datediff_day", "f8_datediff_hour", "s3_incremental_extract", "s12_batch_id",
        "s13_ingest_all", "s9_compact", "s2_partitioned_extract", "s3_upsert_history", "j2_heavy_split", "a6_merged_state",
        "a8_merged_state", "m8_silver_hot_po", "m8_refresh"]


def _norm(df):
    out = []
    for row in df[sorted(df.columns)].itertuples(index=False):
        vals = []
        for v in row:
            if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
                vals.append(None)
            elif isinstance(v, bool) or type(v).__name__ == "bool_":
                vals.append(bool(v))
            elif isinstance(v, numbers.Number):
                vals.append(round(float(v), 6))
            elif hasattr(v, "isoformat"):
                vals.append(pd.Timestamp(v).isoformat())
            else:
                vals.append(str(v))
        out.append(tuple(vals))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("orders", "lineitem", "events", "customer", "supplier"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    """Queries of the optional subpackage have SQL or a brute-force test (tests/llm/test_queries.py)."""
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(E.queries()) >= set(E.oracle_sql()) >= set(catalog.QUERIES)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    assert _norm(sp) == _norm(dk)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 18
