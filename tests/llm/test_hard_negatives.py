"""Hard-negative mining against brute force."""
import math
import random

import numpy as np
import pytest

from tidemark.llm import hard_negatives as H


def brute(data, every=100):
    rows = []
    for vec_id, label, vec in data:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        rows.append((vec_id, label, [math.floor(256 * x) for x in vec]))
    out = []
    for a, (anchor, label, vec) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(vec, v)), math.inf if i is None else i, i, k, lab)
                  for k, (i, lab, v) in enumerate(rows) if k != a]
        scored.sort(key=lambda s: s[:2])
        for p in [s for s in scored if s[4] == label][:5]:
            negatives = [n for n in scored if n[4] != label and -80 * p[0] <= -100 * n[0] <= -100 * p[0]]
            out += [(anchor, p[2], r + 1, n[2], -p[0], -n[0]) for r, n in enumerate(negatives[:5])]
    return sorted(out, key=repr)


def mined(df, **kw):
    return sorted((tuple(r) for r in H.hard_negatives(df, **kw).collect()), key=repr)


def frame(spark, data, kind="float"):
    return spark.createDataFrame([(i, l, v, "x", 1) for i, l, v in data],
                                 f"vec_id long, label int, embedding array<{kind}>, row string, q int").repartition(3)


def test_op13_small_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    data = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    want = brute(data)
    assert mined(df) == want and len(want) > 50


@pytest.mark.parametrize("focus, dense", [(1, 1.0), (3, 0.0), (4, 1.0)])
def test_op13_lists_of_all_kinds(spark, monkeypatch, focus, dense):
    """Vectors of very different lengths in many blocks, pruned by lists or scored whole; ties."""
    for name, value in (("ROWS", 60), ("ANCHORS", 4), ("BUCKET", 16), ("FOCUS", focus), ("DENSE", dense)):
        monkeypatch.setattr(H, name, value)
    rng = random.Random(focus)
    data = []
    for i in range(240):
        centre = rng.randrange(6)
        data.append((i, rng.choice([centre, rng.randrange(3)]),
                     [round(rng.gauss(3 * (k == centre), 0.4), 1) * rng.choice([0.2, 1, 5]) for k in range(6)]))
    want = brute(data, every=20)
    # executors see the module's own constants, so the tile functions run here
    assert mined(frame(spark, data, "double"), every=20) == want and want
    import pyarrow as pa
    rows = [(k, i, (l + 1) % 10 if i % 7 == 0 else l, [float(math.floor(256 * x)) for x in v]) for k, (i, l, v) in enumerate(data)]
    table = pa.table(list(map(list, zip(*rows))), ["row", "vec_id", "label", "vec"])
    anchors = table.filter([i % 20 == 0 for i in table["vec_id"].to_pylist()])
    got = []
    for a in range(anchors.num_rows):
        one = anchors.slice(a, 1)
        same = table.filter([l == one["label"][0].as_py() for l in table["label"].to_pylist()])
        pos = H._positives(5)(same, one)
        one = one.append_column("positives", pa.array([[{"rank": k + 1, "score": s} for k, s in enumerate(pos["score"].to_pylist())]]))
        neg = H._negatives(5, 80)(table, one).to_pylist()
        rank = {}
        for n in neg:
            rank[n["positive_rank"]] = rank.get(n["positive_rank"], 0) + 1
            got.append((one["vec_id"][0].as_py(), pos["vec_id"][n["positive_rank"] - 1].as_py(), rank[n["positive_rank"]],
                        n["vec_id"], pos["score"][n["positive_rank"] - 1].as_py(), n["score"]))
    assert sorted(got, key=repr) == want


def test_op13_edge_rows(spark):
    nan, inf = math.nan, math.inf
    data = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (100, 1, [1.0, 0.5, 2.0]), (3, None, [9.0]), (4, 2, None), (5, 2, [1.0, None]),
            (6, 2, [nan, 1.0]), (8, 2, [inf, 1.0]), (9, 2, [0.95, 0.5]), (10, 2, [0.95, 0.5]), (None, 2, [0.96, 0.5]),
            (11, 3, []), (200, 4, [-1.0, 0.0]), (201, 4, [1.0, 0.0]), (300, 5, [0.0]), (301, 5, [0.0]), (14, 0, [1.0, 0.4])]
    assert mined(frame(spark, data, "double")) == brute(data)
    assert mined(frame(spark, data, "double").where("1 = 0")) == []


def test_op13_scores_beyond_the_exact_range_of_doubles(spark):
    rng = random.Random(3)
    data = [(i, i % 2 + 1, [float(rng.randrange(2**20, 2**21)) + rng.random() for _ in range(3)]) for i in range(1, 60)]
    data = [(100 * i if i < 4 else i, l, v) for i, l, v in data]
    want = brute(data)
    assert max(r[4] for r in want) > 2**53
    assert mined(frame(spark, data, "double")) == want


def test_op13_pruning_keeps_every_row_that_may_reach():
    rng = np.random.default_rng(0)
    rows = np.floor(rng.normal(size=(400, 8)) * 100)
    size = np.sqrt((rows ** 2).sum(1))
    bucket = H.Bucket(rows, size)
    for anchor in np.floor(rng.normal(size=(30, 8)) * 100):
        unit = anchor / np.sqrt((anchor ** 2).sum())
        focus = np.argsort(-np.abs(unit))[None, :3]
        for need in (0.3, 0.6, 0.9):
            least = need * np.sqrt((anchor ** 2).sum()) * bucket.longest
            low, high, enter, leave = bucket.ranges(unit[None], focus, np.array([need]))
            found = set(bucket.candidates(focus[0], low[0], high[0], enter[0], leave[0]).tolist())
            assert set(np.flatnonzero(rows @ anchor >= least).tolist()) <= found
            assert need < 0.9 or len(found) < 400
