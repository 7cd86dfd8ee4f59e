"""Source divergence audit against brute force."""
import collections
import random
import re

import numpy as np
import pytest

from tidemark.llm import divergence as V


def brute(data, min_docs, top=50):
    """Rows (lang, source, part, item, value, rank) from (lang, source, text)."""
    docs = [(l or "", s or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t)
                                for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for l, s, text in data]
    out = set()
    for lang in {d[0] for d in docs}:
        seen = collections.Counter(t for l, _, ts in docs if l == lang for t in set(ts))
        kept = [t for t, n in seen.items() if n >= min_docs]
        counts = {s: collections.Counter(t for l, x, ts in docs if l == lang and x == s for t in ts)
                  for s in {d[1] for d in docs if d[0] == lang}}

        def shares(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}
        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), collections.Counter()))
        for s in counts:
            for part, rows in (("pair", [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o != s]),
                               ("term", [(p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]])):
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(rows)
                        if part == "pair" or k < top}
    return out


def rows_of(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_op11_small_table(docs, rows):
    want = brute([(r["lang"], r["source"], r["text"]) for r in rows], 30)
    assert rows_of(V.divergence(docs)) == want and {r[2] for r in want} == {"pair", "term"}


def test_op11_edge_rows(edge, none):
    data = [(r.lang, r.source, r.text) for r in edge.collect()]
    assert rows_of(V.divergence(edge, min_docs=2)) == brute(data, 2)
    assert none.select("*").transform(V.divergence).count() == 0


def test_op11_many_terms_groups_and_blocks(spark, monkeypatch):
    """Several blocks a language and several bands of groups; ties, other scripts, a group without terms."""
    monkeypatch.setattr(V, "WIDTH", 16)
    monkeypatch.setattr(V, "BAND", 4)
    rng = random.Random(5)
    terms = [f"t{a}" for a in "abcdefghijklmnopqrstuvwxyz"] + ["Été", "ÉTÉ", "日本", "İx", "ẞ"] + \
        [a + b for a in "abcdefg" for b in "hijklmn"]
    data = [(rng.choice(["xx", "xx", "yy", None]), f"s{rng.randrange(9)}",
             "1 ".join(rng.choices(terms, k=rng.randrange(30)))) for _ in range(200)]
    data += [("xx", "none", "12 34"), ("xx", "", None), ("zz", "alone", "word"), ("yy", "twin1", "ta tb"), ("yy", "twin2", "ta tb")]
    df = spark.createDataFrame(data, "lang string, source string, text string").repartition(5)
    assert rows_of(V.divergence(df, min_docs=3, top=7)) == brute(data, 3, 7)


def test_op11_trees_share_equal_subtrees():
    counts = np.zeros((3, 64), np.int64)
    counts[1, 5] = counts[2, 37] = 2
    leaves, levels, roots = V.build_trees(counts)
    assert leaves.tolist() == [0, 2]
    # columns 0-31 of row 1 and 32-63 of row 2 are one node, all zeros another
    assert [len(left) for left, _ in levels] == [2, 2, 2, 2, 2, 3]
    assert len(set(roots)) == 3
    totals = np.array([320, 322, 322])
    got = V.price_pairs(counts, totals, np.array([0, 0, 1]), np.array([1, 2, 2]))
    share = [[1 + 10**9 * (int(c) + 5) // int(t) for c in row] for row, t in zip(counts, totals)]
    assert got.tolist() == [sum(abs(x - y) for x, y in zip(share[a], share[b])) for a, b in ((0, 1), (0, 2), (1, 2))]


@pytest.mark.parametrize("count, total", [(0, 5), (3, 7), (10**12, 3 * 10**12 + 5), (2**52, 2**53 - 1)])
def test_op11_share_is_exact(spark, count, total):
    want = 1 + 10**9 * (count + 5) // total
    assert V._share(np.array([count]), np.array([total]))[0] == want
    got = spark.createDataFrame([(count, total)], "c long, t long").select(V.share("c", "t").alias("p")).first().p
    assert got == want
