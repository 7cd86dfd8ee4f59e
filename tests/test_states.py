"""Aggregate states: base plus increments equals all rows at once."""
import random
from decimal import Decimal

import pytest

from tidemark.operators import facts as fx
from tidemark.operators.states import Agg, finish, merge, partial, rollup

AGGS = (Agg("TOP", "max", "v"), Agg("LOW", "min", "v"), Agg("TOTAL", "sum", "v * 2"), Agg("N", "count", "v"),
        Agg("FULL", "max_if_complete", "v"), Agg("EVEN", "max", "CASE WHEN v % 2 = 0 THEN v END"))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(1)
    out = [(rng.choice(["a", "b", "c", None]), rng.choice([1, None]), rng.choice([None, *range(9)]), k % 3) for k in range(200)]
    out += [("all-null", 1, None, 0), ("late-null", 1, 5, 0), ("late-null", 1, None, 1), ("new", 1, 7, 2)]
    return spark.createDataFrame([(k, j, None if v is None else Decimal(v), p) for k, j, v, p in out],
                                 "k string, j long, v decimal(18,2), part int").repartition(3)


def brute(data):
    groups = {}
    for r in data.collect():
        groups.setdefault((r.k, r.j), []).append(r.v)
    out = []
    for (k, j), vs in groups.items():
        known = [v for v in vs if v is not None]
        even = [v for v in known if v % 2 == 0]
        out.append((k, j, max(known, default=None), min(known, default=None), sum(known) * 2 if known else None, len(known),
                    max(known, default=None) if len(known) == len(vs) else None, max(even, default=None)))
    return out


def test_merged_states_equal_brute_force_and_the_whole(data):
    keys = ("k", "j")
    parts = [partial(data.where(f"part = {p}"), keys, AGGS) for p in range(3)]
    for order in ((0, 1, 2), (2, 0, 1)):
        got = finish(merge([parts[p] for p in order], keys, AGGS), keys, AGGS)
        step = merge([merge([parts[order[0]], parts[order[1]]], keys, AGGS), parts[order[2]]], keys, AGGS)
        assert rows(got) == rows(finish(step, keys, AGGS)) == rows(rollup(data, keys, AGGS))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, brute(data)))
    full = {r.k: r.FULL for r in got.where("k like '%null' or k = 'new'").collect()}
    assert full["all-null"] is None and full["late-null"] is None and full["new"] == 7


def test_types_do_not_grow_and_empty_increments(data):
    keys = ("k",)
    state = partial(data, keys, AGGS)
    again = merge([state, partial(data.limit(0), keys, AGGS)], keys, AGGS)
    assert again.dtypes == state.dtypes and rows(again) == rows(state)
    assert rows(merge([again, partial(data.limit(0), keys, AGGS)], keys, AGGS)) == rows(state)


def test_unknown_kinds_are_refused():
    with pytest.raises(ValueError, match="median"):
        Agg("X", "median", "v")


@pytest.mark.parametrize("source, keys, aggs, cut", [
    ("purchase_order_line", fx.PO_LINE_KEYS, fx.PO_LINE_AGGS, "DELIV_DATE < '1995-06-01'"),
    ("tlm_shipment", ("SHIPMENT_ID",), fx.SHIPMENT_AGGS, "SHIPMENT_STATUS < 70"),
    ("ct_shipment_event", ("SC_CT_SHIPMENT_ID",), fx.CT_EVENT_AGGS, "EVENT_CODE = 'DROP'")])
def test_rollups_of_the_job(bronze, source, keys, aggs, cut):
    df = bronze[source]
    parts = [partial(df.where(c), keys, aggs) for c in (cut, f"not ({cut})")]
    want = rollup(df, keys, aggs)
    got = finish(merge(parts, keys, aggs), keys, aggs)
    assert got.dtypes == want.dtypes and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
