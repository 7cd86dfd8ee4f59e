"""Rows without a doc_id, and rows of one doc_id with different texts."""
import collections

import pytest
from test_operators import shingles

from tidemark.llm import line_dedup, ngram_join, substring_dedup


def prose(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n)) + "."


A, B, C, D, E = map(prose, "abcde")
# known first: A and B; then rows without a doc_id, and doc_id 7 with several texts
ROWS = [(1, A), (2, B), (7, C), (7, D), (7, D), (None, A + "\n" + prose("x")), (None, prose("y") + "\n" + B), (None, E), (None, E),
        (None, prose("z")), (None, None)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)


def test_op5_rows_are_told_apart(table):
    got = collections.Counter((r.doc_id, r.text) for r in line_dedup.drop_lines(table).collect())
    assert got == collections.Counter([(1, A), (2, B), (7, C), (7, D), (None, prose("x")), (None, prose("y")), (None, E),
                                       (None, prose("z")), (None, None)])
    hits = collections.Counter((r.doc_id, tuple(r.removed), tuple(r.matched)) for r in line_dedup.removed_lines(table).collect())
    assert hits == collections.Counter({(1, (), ()): 1, (2, (), ()): 1, (7, (), ()): 2, (7, (0,), (7,)): 1, (None, (0,), (1,)): 1,
                                        (None, (1,), (2,)): 1, (None, (0,), (None,)): 1, (None, (), ()): 3})


def test_op8_rows_are_told_apart(table):
    got = substring_dedup.without_spans(table, substring_dedup.repeated_runs(table))
    assert collections.Counter((r.doc_id, (r.text or "").strip()) for r in got.collect()) == collections.Counter(
        [(1, A), (2, B), (7, C), (7, D), (7, ""), (None, prose("x")), (None, prose("y")), (None, E), (None, ""),
         (None, prose("z")), (None, "")])
    spans = collections.Counter((r.doc_id, len(r.spans), r.n_removed_words) for r in substring_dedup.repeats(table).collect())
    assert spans == collections.Counter({(1, 0, 0): 1, (2, 0, 0): 1, (7, 0, 0): 2, (7, 1, 60): 1, (None, 1, 60): 3, (None, 0, 0): 3})


def test_op9_rows_are_told_apart(spark):
    near = lambda text: text + " one more."
    # two rows without a doc_id near 1 and 2, which have nothing in common
    rows = [(1, A), (2, B), (7, C), (7, D), (None, near(A)), (None, near(B)), (None, E), (None, near(E)), (None, "few words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(1, A, 1), (2, B, 2), (7, C, 7), (7, D, 7), (None, near(A), 1), (None, near(B), 2), (None, E, None),
            (None, near(E), None), (None, "few words", None)]
    got = ngram_join.similar_groups(df, 3, 90).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == collections.Counter(
        (i, len(shingles(t, 3)), c) for i, t, c in want)
    kept = [(r.doc_id, r.text) for r in ngram_join.one_per_group(df, 3, 90).collect()]
    assert len(kept) == 6 and set(rows[:4]) | {rows[-1]} < set(kept) and sum(t in (E, near(E)) for _, t in kept) == 1


def test_op1_repeated_rows_take_their_quota_once(spark):
    from tidemark.llm import mixing
    # rows that repeat whole, and rows without a doc_id of one source and word count
    data = [(i % 5, prose(f"r{i % 5}x", 300), f"s{i % 2}") for i in range(40)] + \
        [(None, prose(f"n{i}x", 200), "s0") for i in range(30)] + [(100 + i, prose(f"u{i}x", 250), "s2") for i in range(20)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
    taken = collections.Counter()
    for r in mixing.mix(df).collect():
        taken[r.doc_id, r.source] += r.taken
    found, per_text = collections.Counter(), collections.Counter()
    for r in mixing.mixed_documents(df).collect():
        found[r.doc_id, r.source] += len(r.text.split())
        per_text[r.text.split()[0].split("x")[0], r.source] += len(r.text.split())
    assert found == taken
    size = collections.Counter()
    for _, t, s in data:
        size[t.split("x")[0], s] += len(t.split())
    assert all(n <= 2 * size[k] for k, n in per_text.items())


def test_op7_full_pieces_of_repeated_rows(spark):
    from tidemark.llm import packing
    data = [(1, prose("a", 700), "s0")] * 3 + [(None, prose("b", 600), "s1")] * 2 + [(None, prose("c", 512), "s1"), (2, prose("d", 40), "s2")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(2)
    got = packing.pack(df, capacity=256).collect()
    assert sum(r.n_words for r in got) == sum(len(t.split()) for _, t, _ in data)
    words, rows = collections.Counter(), collections.defaultdict(list)
    for r in got:
        words[r.pack_group, r.bin] += r.n_words
        rows[r.pack_group, r.bin].append((r.doc_id, r.source))
    assert max(words.values()) <= 256 and all(len(set(v)) == len(v) for v in rows.values())
    assert sum(n == 256 for n in words.values()) == 12


def test_op5_short_lines(spark):
    notice = "Licensed under CC BY 4.0."
    data = [(1, f"{prose('a')}\n{notice}\nNext"), (2, f"{notice}\n{prose('b')}\nby 4.0. CC under licensed"),
            (3, f"one two three four\nNext\n\nNext page"), (4, "one two three four five\none two three\n  Next")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: (list(r.removed), list(r.matched)) for r in line_dedup.removed_lines(df).collect()}
    assert got == {1: ([], []), 2: ([0, 2], [1, 1]), 3: ([1], [1]), 4: ([0, 2], [3, 1])}


def test_op4_full_licences(spark):
    import textwrap

    from tidemark.llm import licenses
    known = {r.license: r.known for r in licenses.known_texts(spark).collect() if len(r.known) > 300}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "CC0-1.0", "Unlicense"} < set(known)
    names = sorted(known)
    data = [(k, known[n]) for k, n in enumerate(names)]
    # in a longer text, its lines broken elsewhere
    data += [(100 + k, "About this tool.\n\n" + "\n\n".join(textwrap.fill(x, 50) for x in known[n].split("\n\n")) + "\n\nThat was all.")
             for k, n in enumerate(names) if n in ("MIT", "ISC", "Unlicense", "0BSD")]
    data += [(200, "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + known["MIT"]), (201, "ISC License (ISC)\n\n" + known["ISC"]),
             (202, known["GPL-2.0"].split("END OF TERMS AND CONDITIONS")[0]), (203, known["Apache-2.0"][:4000]), (204, "MIT License")]
    got = {r.doc_id: (list(r.licenses), r.whole_license, r.n_notices) for r in
           licenses.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    for k, n in enumerate(names):
        assert n in got[k][0] and got[k][1] == n, (n, got[k])
        if 100 + k in got:
            assert got[100 + k][:2] == ([n], None), n
    assert [got[k] for k in (200, 201, 202, 203, 204)] == [
        (["MIT"], "MIT", 1), (["ISC"], "ISC", 1), (["GPL-2.0"], "GPL-2.0", 1), ([], None, 0), ([], None, 0)]
