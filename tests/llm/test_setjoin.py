"""Value groups of the set join: keys that linked sets share, small groups and parts."""
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import line_dedup, setjoin

from test_operators import test_op5_removed_lines as removed_lines


def sets_of(lists):
    offsets = np.r_[0, np.cumsum([len(x) for x in lists])]
    values = np.array([v for x in lists for v in sorted(x)], np.uint64)
    number = np.arange(len(lists))
    return setjoin.Sets(number, np.zeros(len(lists), np.int32), offsets, values, number.astype(np.uint64),
                        number.astype(np.uint64), np.zeros(len(lists), bool))


@pytest.mark.parametrize("percent", [40, 80, 90])
@pytest.mark.parametrize("split", [False, True])
def test_linked_sets_meet_where_the_bounds_let_them_pass(percent, split):
    rng = np.random.default_rng(7)
    lists = []
    for _ in range(150):
        base = set(rng.choice(60, rng.integers(1, 40), replace=False).tolist())
        lists.append(base)
        for _ in range(3):
            near = {v for v in base if rng.random() > 0.12} | {int(v) for v in rng.choice(60, rng.integers(0, 3))}
            lists.append(near or base)
    s = sets_of(lists)
    n = np.diff(s.offsets)
    bits = np.zeros(setjoin.LEAST_BITS // 64, np.uint64)
    for v in range(0, 60, 2):  # even values are in many units
        at = int(setjoin._bit(np.array([v], np.uint64), setjoin.LEAST_BITS)[0])
        bits[at >> 6] |= np.uint64(1 << (at & 63))
    units = line_dedup.Lines(percent, 1)
    units.split_below = 25
    known = setjoin.Survey(setjoin.NONE_HEAVY, None, bits if split else None, bits, {})
    owner, pos, key = setjoin.dealt_values(s, setjoin.prefix_size(percent, n), units, known)
    at = {}
    for o, p, k in zip(owner.tolist(), pos.tolist(), key.tolist(), strict=True):
        at.setdefault(o, {}).setdefault(k, p)
    linked = 0
    for i, x in enumerate(lists):
        for j, y in enumerate(lists[:i]):
            if 100 * len(x & y) >= percent * len(x | y):
                linked += 1
                least = setjoin.need(percent, len(x) + len(y))
                first = min((len(x), i), (len(y), j))[1]
                shared = [k for k in at[i].keys() & at[j].keys()
                          if min(len(x) - at[i][k], len(y) - at[j][k]) >= least]
                assert any(setjoin.need(percent, 2 * n[first]) <= n[first] - at[first][k] for k in shared), (x, y)
    assert linked > 100


@pytest.mark.parametrize("reach, nominations, split_from", [(1, 1, 1), (3, 2, 20)])
def test_op5_small_groups(docs, edge, rows, monkeypatch, reach, nominations, split_from):
    for name, value in (("reach", reach), ("nominations", nominations), ("split_from", split_from)):
        monkeypatch.setattr(line_dedup.Lines, name, value)
    removed_lines(docs, edge, rows)


def test_stream_gives_whole_groups_in_order():
    rng = np.random.default_rng(3)
    m, low = 4000, (1 << setjoin.SIZE_BITS) - 1
    key = rng.integers(-3, 3, m) * (low + 1) + rng.integers(0, 3, m)
    n = rng.integers(1, 50, m)
    order = np.argsort((key & ~low) | n, kind="stable")
    cols = {"key": key[order], "doc": np.arange(m), "line": np.zeros(m, np.int32), "n": n[order].astype(np.int32),
            "pos": np.zeros(m, np.int32), "sig": np.zeros(m, np.int64), "sig2": np.zeros(m, np.int64),
            "digest": np.zeros(m, np.int32)}
    batch = pa.record_batch(list(map(pa.array, cols.values())), list(cols))
    batches = [batch.slice(i, 100) for i in range(0, m, 100)]
    for held in (10**6, 150):
        seen = []
        for c, new, split in setjoin._streamed(iter(batches), held, ["key", "n", "doc", "line"], 5):
            assert (np.lexsort([c["doc"], c["n"], c["key"]]) == np.arange(len(new))).all()
            assert split.any() == (held == 150) or not new.any()
            seen.append(np.c_[c["key"], c["doc"]][new])
        got = np.concatenate(seen)
        assert len(got) == m and len(np.unique(got[:, 1])) == m


def test_dealt_rows_hold_every_field_and_bitmap():
    s = sets_of([range(1, 200), [5, 6], range(3, 400)])
    n, at = np.diff(s.offsets), np.array([0, 2])
    sig = [np.array([1, -2, 3]), np.array([-4, 5, 6])]
    short = np.array([7, -8, 9], np.int32)
    key = np.array([1 << 63, 3, 77], np.uint64)
    dealt = list(setjoin._dealt(key, s, np.arange(3), n, np.array([0, 1, 2]), sig, short))
    dealt += setjoin._dealt(key[at], s, at, n, np.full(2, setjoin.BITMAP), sig, short, setjoin.bitmaps(s, at))
    low = (1 << setjoin.SIZE_BITS) - 1
    for b in dealt:
        assert b.schema.names == ["at", "row"]
    assert dealt[0].column("at").to_pylist() == [-(1 << 63) | 199, 2, 397]
    c = setjoin._columns(dealt[0].slice(1).select(["row"]))
    assert {k: v.tolist() for k, v in c.items()} == {
        "key": [3, 77], "doc": [1, 2], "line": [0, 0], "n": [2, 397], "pos": [1, 2], "sig": [(1 << 64) - 2, 3], "sig2": [5, 6],
        "digest": [-8, 9]}
    tiles = list(setjoin._settled(iter([b.select(["row"]) for b in dealt]), 80, False, 31, 1))
    whole = [r for b in tiles for r in b.to_pylist() if r["pos"] == setjoin.BITMAP]
    assert [r["bitmap"] for r in whole] == setjoin.bitmaps(s, at).to_pylist() and [r["doc"] for r in whole] == [0, 2]
    assert [r["key"] & low for r in whole] == [0, 77] and [r["n"] for r in whole] == [199, 397]


def test_words_are_counted_once_over_the_chunks_of_a_task():
    class Docs:
        def mapInArrow(self, run, schema):  # noqa: N802
            raise Stop(run)

    class Stop(Exception):
        pass

    with pytest.raises(Stop) as stop:
        setjoin.survey(Docs(), line_dedup.Lines(80, 1))
    batch = pa.record_batch([pa.array([0, 1]), pa.array(["one two", "two\n\ntwo three"])], ["doc", "text"])
    later = pa.record_batch([pa.array([2]), pa.array(["Two one"])], ["doc", "text"])
    rows = [r for b in stop.value.args[0](iter([batch, later])) for r in b.to_pylist()]
    assert sorted(r["n"] for r in rows if r["doc"] is None) == [1, 2, 4]
    assert sorted(r["doc"] for r in rows if r["doc"] is not None) == [0, 1, 1, 2]
