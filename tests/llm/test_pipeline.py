"""Packing against a plain best fit, and the pipeline against brute force, stage by stage."""
import collections

import pytest
from pyspark.sql import functions as F
from test_operators import fill, later, linked

import corpus_pipeline
from conftest import EDGE, SMALL, words
from tidemark.llm import packing, quality
from tidemark.llm.common import documents, one_space


def best_fit(pieces, capacity):
    """(bin, start) per piece by looking at every bin: the least room that fits and has
    neither the source nor the cluster; of equal ones the bin that got that room first."""
    bins, out = [], []
    for step, (size, source, cluster) in enumerate(pieces):
        fits = [b for b in bins if b["room"] >= size and source not in b["sources"] and cluster not in b["clusters"]]
        if fits:
            b = min(fits, key=lambda b: (b["room"], b["since"]))
        else:
            b = {"number": len(bins), "room": capacity, "sources": set(), "clusters": set()}
            bins.append(b)
        out.append((b["number"], capacity - b["room"]))
        b["room"] -= size
        b["since"] = step
        b["sources"].add(source)
        b["clusters"].add(cluster)
    return out


@pytest.mark.parametrize("capacity, group_rows", [(512, 4000), (300, 40)])
def test_op7_brute_force(docs, edge, rows, capacity, group_rows):
    for table, data in ((docs, [(r["doc_id"], r["text"], r["source"]) for r in rows]), (edge, EDGE)):
        cluster = {r.doc_id: r.c for r in table.select("doc_id", F.xxhash64(one_space(F.col("text"))).alias("c")).collect()}
        groups, want_full = collections.defaultdict(list), 0
        for r in packing.pack(table, capacity, group_rows).collect():
            groups[r.pack_group].append(r)
        for i, t, _ in data:
            want_full += len(words(t)) // capacity
        full = groups.pop(-1, [])
        assert len(full) == want_full == len({r.bin for r in full}) and all(r.n_words == capacity for r in full)
        assert sum(map(len, groups.values())) == sum(1 for _, t, _ in data if len(words(t)) % capacity or not words(t))
        for group in groups.values():
            group.sort(key=lambda r: (-r.n_words, cluster[r.doc_id], r.doc_id is None, r.doc_id or 0))
            want = best_fit([(r.n_words, r.source, cluster[r.doc_id]) for r in group], capacity)
            key = lambda r: (r.n_words, r.source or "", cluster[r.doc_id], r.doc_id or 0)
            # rows that repeat whole change places freely
            assert collections.Counter((key(r), r.bin, r.bin_start) for r in group) == \
                collections.Counter((key(r), *w) for r, w in zip(group, want, strict=True))


def table_rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_stages_follow_each_other(spark):
    """Every stage of the pipeline, on what the one before it kept, against brute force."""
    docs = documents(spark, SMALL)
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram jaccard join", "source mixing", "best-fit packing"]
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SMALL).cache()
        out.append(docs)
        assert k == 4 or docs.columns == columns
    start = table_rows(documents(spark, SMALL))
    cleaned, lines, groups, mixed = (table_rows(d) for d in out[:4])

    want = {}
    for i, text, _ in start:
        parts, w = (text or "").split("\n"), words(text)
        faults = quality.faulty_lines(parts)
        lost = sum(len(words(x)) for x, bad in zip(parts, faults) if bad)
        grams = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {a + d for a, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for d in range(3)}
        if len(w) >= 50 and 2 * len(hit) <= len(w) and 100 * lost <= 40 * len(w):
            want[i] = "\n".join(x for x, bad in zip(parts, faults) if not bad)
    assert {i: t for i, t, _ in cleaned} == want and 0 < len(cleaned) < len(start)

    gone = later(cleaned)
    want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(i, [])) for i, t, _ in cleaned}
    want = {i: t for i, t in want.items() if i not in gone or words(t)}
    assert {i: t for i, t, _ in lines} == want

    root, _ = linked(lines, 5, 80)
    assert sorted(i for i, _, _ in groups) == sorted(set(root)) and set(groups) <= set(lines)

    sizes, taken, texts = collections.Counter(), collections.Counter(), {i: (words(t), s) for i, t, s in groups}
    for w, s in texts.values():
        sizes[s] += len(w)
    per_doc = collections.Counter()
    for i, t, s in mixed:
        w = words(t)
        rest = iter(texts[i][0])  # whole, or picked blocks of it in order
        assert texts[i][1] == s and all(x in rest for x in w)
        taken[s] += len(w)
        per_doc[i] += len(w)
    assert all(n <= 2 * len(texts[i][0]) for i, n in per_doc.items())
    order = sorted(sizes, key=lambda s: (s is None, s))
    target = fill(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    assert all(abs(taken[s] - target[s]) <= max(0.02 * target[s], 200) for s in sizes)

    packed = collections.Counter()
    bins = collections.defaultdict(list)
    for r in out[4].collect():
        packed[r.doc_id] += r.n_words
        bins[r.pack_group, r.bin].append(r)
    assert packed == +per_doc or packed == per_doc
    assert all(sum(r.n_words for r in b) <= packing.CAPACITY and len({r.source for r in b}) == len(b) for b in bins.values())

    # run() does the same, through written tables
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == out[4].columns
    names = ["doc_id", "source", "piece", "first_word", "n_words"]
    assert sorted(map(str, got.select(*names).collect())) == sorted(map(str, out[4].select(*names).collect()))
