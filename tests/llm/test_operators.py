"""Every operator against a brute-force version, on a small table and on edge cases."""
import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import EDGE, words

from tidemark.llm import (exact_dedup, licenses, line_dedup, mixing, ngram_join, packing, quality, sharding,
                          substring_dedup, token_output)


def both(docs, edge, rows):
    yield docs, [(r["doc_id"], r["text"], r["source"]) for r in rows]
    yield edge, EDGE


# -- 1 ------------------------------------------------------------------
def fill(sizes, weights, total):
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    left = total
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] >= 2 * sizes[s]}
        if not full:
            target |= {s: level * weights[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


def test_op1_targets_and_taken(docs, edge, rows):
    for table, data in both(docs, edge, rows):
        sizes = collections.Counter()
        for _, t, s in data:
            sizes[s] += len(words(t))
        order = sorted(sizes, key=lambda s: (s is None, s))
        weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
        target = fill(sizes, weights, 1.5 * sum(sizes.values()))
        got = mixing.mix(table).collect()
        assert sorted((r.doc_id or 0, r.size) for r in got) == sorted((i or 0, len(words(t))) for i, t, _ in data)
        taken = collections.Counter()
        for r in got:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
            assert 0 <= r.taken <= 2 * r.size
            taken[r.source] += r.taken
        for s in sizes:
            assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 200), s
        again = mixing.mix(table).collect()
        assert sorted(map(str, got)) == sorted(map(str, again))


def test_op1_mixed_documents_hold_what_is_taken(docs):
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    found = collections.Counter()
    texts = {r.doc_id: words(r.text) for r in docs.collect()}
    for r in mixing.mixed_documents(docs).collect():
        w = words(r.text)
        found[r.doc_id] += len(w)
        assert set(w) <= set(texts[r.doc_id])
    assert {k: v for k, v in taken.items() if v} == dict(found)


def test_op1_apportion_gives_highest_quotients(spark):
    import heapq
    w = [53, 24, 23, 7, 1, 900, 2]
    df = spark.createDataFrame([(1, i, x, 10**6) for i, x in enumerate(w)], "g int, i int, w long, most long")
    from pyspark.sql import functions as F
    for seats in (1, 7, 50, 1013):
        got = {r.i: r.quota for r in mixing.apportion(df, ["g"], ["i"], "w", F.lit(seats), "most").collect()}
        want, heap = [0] * len(w), [(-x, i) for i, x in enumerate(w)]
        heapq.heapify(heap)
        for _ in range(seats):
            _, i = heapq.heappop(heap)
            want[i] += 1
            heapq.heappush(heap, (-w[i] / (2 * want[i] + 1), i))
        assert got == dict(enumerate(want)), seats


# -- 2 ------------------------------------------------------------------
def test_op2_counts_and_verdict(docs, edge, rows):
    for table, data in both(docs, edge, rows):
        want = []
        for i, t, _ in data:
            t, w = t or "", words(t)
            grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
            hit = {k + d for k, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if grams[g] > 1 for d in range(3)}
            lines = [x for x in t.split("\n") if words(x)]
            bad, run = set(), []
            for k, x in enumerate([*lines, None]):  # short lines count in runs of three
                if x is not None and len(x.split()) < 3 and quality.line_fault(x) == "punctuation":
                    run.append(k)
                    continue
                bad |= set(run) if len(run) > 2 else set()
                run = []
                if x is not None and quality.line_fault(x):
                    bad.add(k)
            lost = sum(len(words(lines[k])) for k in bad)
            failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
            want.append((i or 0, len(w), len(b"".join(w).decode()), len(re.findall(r"[#*$%&|<>]", t)),
                         len(lines) - len(set(lines)), len(hit), failed, not failed and 100 * lost <= 40 * len(w)))
        got = [(r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
               for r in quality.quality(table).collect()]
        assert sorted(got) == sorted(want)


def test_op2_agrees_with_labels(spark):
    base = "/root/testdata/sf0.01"
    q = quality.quality(spark.read.parquet(f"{base}/documents.parquet"))
    labels = spark.read.parquet(f"{base}/labels.parquet")
    got = q.join(labels, "doc_id").where("n_words >= 50").select("kept", "quality").collect()
    good, bad = [r.kept for r in got if r.quality], [r.kept for r in got if not r.quality]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_op2_line_rules():
    fault = quality.line_fault
    assert fault("Please read our Privacy Policy and Terms of Use.") == "boilerplate"
    assert fault("Home | News | Sport | Weather") == "navigation"
    assert fault("buy### now$$$ cheap%%% pills&&&") == "punctuation"
    assert fault("THIS IS ALL SHOUTED AND VERY LOUD INDEED") == "punctuation"
    assert fault("Next") == "punctuation"
    assert fault("An ordinary sentence, that ends as it should.") is None
    assert fault("Licensed under CC BY-NC 4.0.") is None


def test_op2_rules_do_not_look_at_length():
    fault = quality.line_fault
    notice = "We use cookies to tell our readers apart"
    for n in range(1, 60, 7):
        assert fault(notice + " and to count them" * n + ".") == "boilerplate", n
        assert fault(" ".join(["SHOUTED WORDS GO ON"] * n * 20)) == "punctuation"
        prose = "An ordinary sentence says what it has to say and ends. " * (5 + n)
        assert fault(prose + "See the terms of service. " + prose) is None
    assert fault("We use cookies to see how you read. They help us to see how the site is used. Thank you.") == "boilerplate"


def test_op2_scripts_headings_and_code():
    assert quality.line_fault("昨日は天気が良かったので公園を散歩しました") is None
    assert quality.line_fault("if (a[i] == b) { x = y; }") is None
    faults = quality.faulty_lines
    prose = "An ordinary sentence, that ends as it should."
    assert faults(["Second Chapter", "", prose, "Notes", prose]) == [False] * 5
    assert faults(["Home", "Next page", "", "Contact", prose]) == [True, True, False, True, False]
    assert faults(["Home", "News"]) == [False, False] and faults(["a", "b", "c"]) == [True] * 3
    assert faults([]) == [] and faults([""]) == [False]


def test_clean_documents_keeps_columns(edge):
    got = quality.clean_documents(edge)
    assert got.columns == edge.columns
    assert {r.doc_id for r in got.collect()} == {1, 5, 9, 13}


# -- 3 ------------------------------------------------------------------
def test_op3_shards(docs, edge, rows):
    for table, data in both(docs, edge, rows):
        got = sharding.shard_rows(table).collect()
        want = sorted((i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in data)
        assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got) == want
        slots = collections.defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
            assert r.law == "key" and 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        assert len({(r.doc_id, r.shard, r.grown_shard) for r in got}) == len({r.doc_id for r in got})


def test_op3_jump_hash_is_even_and_moves_only_forward():
    keys = np.random.default_rng(1).integers(0, 2**64, 100_000, np.uint64)
    a, b = sharding.jump_hash(keys, 40), sharding.jump_hash(keys, 41)
    assert ((a == b) | (b == 40)).all()
    assert abs((b == 40).mean() - 1 / 41) < 0.003
    assert np.bincount(a, minlength=40).min() > 2200
    one = int(keys[0])
    k, j, shard = one, 0, -1
    while j < 40:
        shard = j
        k = (k * sharding.JUMP + 1) % 2**64
        j = int((shard + 1) * (2.0**31 / ((k >> 33) + 1)))
    assert a[0] == shard


# -- 4 ------------------------------------------------------------------
def test_op4_finds_notices_and_texts(spark, edge):
    mit = next(t for k, t in licenses.KNOWN if k == "MIT" and len(t) > 300)
    own = "Copyright (c) 2019 Some Body\n\n" + mit.replace("\n", " \r\n  ").replace("license", "licence")
    data = [(1, "Some text.\nreleased under the MIT LICENCE\nmore"), (2, own), (3, None), (4, ""), (5, "Released under the MIT License. And more."),
            (6, "All rights reserved."), (6, "All rights reserved."), (None, "Licensed under CC BY-NC 4.0")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.licenses, r.whole_license) for r in licenses.scan(df).collect())
    assert [(a, b, c) for a, b, c in got if a in (0, 1, 2, 3, 4, 5)] == [
        (0, ["CC-BY-NC-4.0"], "CC-BY-NC-4.0"), (1, ["MIT"], None), (2, ["MIT"], "MIT"), (3, [], None), (4, [], None), (5, [], None)]
    assert [x for x in got if x[0] == 6] == [(6, ["proprietary"], "proprietary")] * 2
    assert licenses.scan(edge).count() == len(EDGE)


def brute_scan(data):
    """(doc_id, licenses, n_notices, whole) by the definitions, without digests or joins."""
    import regex

    def canon(text):
        x = regex.sub("|".join((licenses.COPYRIGHT_LINE, licenses.TITLE_LINE, licenses.ITEM)).replace("(?m)", ""), "",
                      text.lower(), flags=regex.M)
        for a, b in licenses.SPELLINGS:
            x = x.replace(a, b)
        return regex.sub(r"[^\p{L}\p{N}]+", " ", x).strip(" ")
    known = [*licenses.KNOWN, *((f.stem, f.read_text(encoding="utf-8")) for f in licenses.FOLDER.glob("*.txt"))]
    same, full = collections.defaultdict(set), set()
    for name, text in known:
        c = canon(text)
        body = c.split(" end of terms and conditions")[0]
        for form in {c, body}:
            same[form].add(name)
        if "\n" in text:
            full.add((name, body))
    out = []
    for i, text, _ in data:
        c = canon(text or "")
        of_text = set(same.get(c, ())) | {n for n, f in full if f" {f} " in f" {c} "} if c else set()
        lines = [canon(x) for x in (text or "").split("\n")] if "\n" in (text or "") else []
        by_line = [n for x in lines if x for n in same.get(x, ())]
        out.append((i or 0, sorted(of_text | set(by_line)), len(by_line) + len(of_text), min(same.get(c, ()), default=None) if c else None))
    return sorted(out, key=str)


def scanned(df):
    return sorted(((r.doc_id or 0, r.licenses, r.n_notices, r.whole_license) for r in licenses.scan(df).collect()), key=str)


def test_op4_brute_force(spark, docs, edge, rows, none):
    for table, data in both(docs, edge, rows):
        assert scanned(table) == brute_scan(data)
    assert any(r[1] for r in brute_scan([(r["doc_id"], r["text"], None) for r in rows])) and scanned(none) == []
    full = {f.stem: f.read_text(encoding="utf-8") for f in licenses.FOLDER.glob("*.txt")}
    data = [(k, t, None) for k, t in enumerate(full.values())]
    data += [(100, "Before.\n" + full["GPL-2.0"].upper() + "\nafter " + full["Zlib"], None),
             (101, "x".join(full["BSD-2-Clause"].split("\n")), None), (102, full["MPL-2.0"][: len(full["MPL-2.0"]) // 2], None),
             (None, "plain prose", None), (None, "Released under the MIT License.", None), (None, "All rights reserved.\nAll rights reserved.", None),
             (7, "prose", None), (7, "Licensed under CC BY 4.0.", None)]
    assert scanned(spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string").repartition(5)) == brute_scan(data)


def test_op4_plan_and_bounds(spark, docs, monkeypatch):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    want = scanned(docs)
    monkeypatch.setattr(licenses, "MOST_DIGESTS", 3)  # beyond the bound the digests are joined as Spark sees fit
    assert scanned(docs) == want
    monkeypatch.setattr(licenses, "MOST_FULL", 3)
    with pytest.raises(ValueError, match="full licence texts"):
        licenses.scan(docs)
    few = spark.createDataFrame([("X", "one notice"), ("Y", "One, notice!")], "license string, known string")
    got = licenses.scan(spark.createDataFrame([(1, "a\nONE notice.")], "doc_id long, text string"), few).first()
    assert (got.licenses, got.n_notices) == (["X", "Y"], 2)


# -- 5 ------------------------------------------------------------------
def later(data, percent=80, min_words=line_dedup.MIN_WORDS):
    rank = lambda i: (1 << 63) if i is None else i
    data = sorted(data, key=lambda r: rank(r[0]))
    lines = [(rank(i), k, frozenset(words(x.lower()))) for i, t, _ in data for k, x in enumerate((t or "").split("\n"))
             if len(words(x)) >= min_words]
    out, seen = collections.defaultdict(set), collections.defaultdict(list)
    for at, (i, k, s) in enumerate(lines):
        common = collections.Counter(j for w in s for j in seen[w])
        if any(100 * n >= percent * (len(s) + len(lines[j][2]) - n) and lines[j][:2] < (i, k) for j, n in common.items()):
            out[i].add(k)
        for w in s:
            seen[w].append(at)
    return {i: sorted(v) for i, v in out.items()}


def test_op5_removed_lines(docs, edge, rows):
    for table, data in both(docs, edge, rows):
        want = later([x for x in data])
        got = line_dedup.removed_lines(table).collect()
        assert len(got) == len(data)
        for r in got:
            assert list(r.removed) == want.get((1 << 63) if r.doc_id is None else r.doc_id, []), r.doc_id
            assert len(r.matched) == r.n_removed == len(r.removed)


def test_op5_drop_lines(edge):
    got = {r.doc_id: r.text for r in line_dedup.drop_lines(edge).collect()}
    assert line_dedup.drop_lines(edge).columns == edge.columns
    assert 5 not in got and 13 not in got and got[1] == EDGE[0][1]  # copies lose all they have
    assert 2 in got and 3 in got  # had no words to lose


# -- 6 ------------------------------------------------------------------
def test_op6_groups(docs, edge, rows):
    for table, data in both(docs, edge, rows):
        groups = collections.defaultdict(list)
        norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        for i, t, _ in data:
            groups[norm(t)].append(i)
        want = []
        for i, t, _ in data:
            g = groups[norm(t)]
            keep = min((x for x in g if x is not None), default=None)
            want.append((i or 0, keep or 0, len(g), hashlib.sha256(norm(t).encode()).hexdigest()))
        got = exact_dedup.exact_groups(table).collect()
        assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.text_sha256) for r in got) == sorted(want)
        kept = collections.Counter(r.text_sha256 for r in got if r.kept)
        assert set(kept.values()) == {1} and len(kept) == len(groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_op6_hot_text(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same  text', concat('t', id div 2)) as text")
    got = exact_dedup.exact_groups(df).collect()
    hot = [r for r in got if r.doc_id % 3 == 0]
    assert {(r.keep_id, r.group_size) for r in hot} == {(0, len(hot))} and sum(r.kept for r in hot) == 1


# -- 7 ------------------------------------------------------------------
def test_op7_bins(docs, edge, rows):
    for table, data in both(docs, edge, rows):
        got = packing.pack(table, capacity=512).collect()
        text = collections.Counter()
        for r in got:
            text[r.doc_id] += r.n_words
        sizes = collections.Counter()
        for i, t, _ in data:
            sizes[i] += len(words(t))
        assert text == sizes
        norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t, _ in data}
        bins = collections.defaultdict(list)
        for r in got:
            bins[r.pack_group, r.bin].append(r)
        for v in bins.values():
            v = sorted(v, key=lambda r: (r.bin_start, r.n_words))
            assert sum(r.n_words for r in v) <= 512
            assert [r.bin_start for r in v] == list(np.cumsum([0] + [r.n_words for r in v[:-1]]))
            assert len({r.source for r in v}) == len(v)
            assert len({norm[r.doc_id] for r in v}) == len(v)


def test_op7_takes_the_tightest_compatible_bin():
    b = packing.Bins(100)
    assert b.put(60, 1, 1) == (0, 0)
    assert b.put(50, 1, 2) == (1, 0)       # same source as bin 0
    assert b.put(40, 2, 4) == (0, 60)      # fits bin 0 exactly
    assert b.put(30, 4, 2) == (2, 0)       # bin 1 has its cluster
    assert b.put(30, 2, 8) == (1, 50)      # tighter than bin 2


# -- 8 ------------------------------------------------------------------
def test_op8_spans(docs, rows, edge):
    def check(table, data):
        first, per = {}, {}
        for i, t, _ in sorted(data, key=lambda r: (1 << 63) if r[0] is None else r[0]):
            per.setdefault(i, [])
            mine = set()
            for k, (a, b) in enumerate(substring_dedup.units(t or "")):
                u = " ".join(t[a:b].lower().split())
                per[i].append((k, a, b, u, u in mine or first.setdefault(u, i) != i))
                mine.add(u)
        want = {}
        for i, us in per.items():
            run, spans = [], []
            for k, a, b, u, hit in [*us, (None, 0, 0, "", False)]:
                if hit and (not run or k == run[-1][0] + 1):
                    run.append((k, a, b, len(u.split())))
                    continue
                if sum(x[3] for x in run) >= substring_dedup.MIN_WORDS:
                    spans.append((run[0][1], run[-1][2]))
                run = [(k, a, b, len(u.split()))] if hit else []
            want[i] = spans
        got = {r.doc_id: [tuple(s) for s in r.spans] for r in substring_dedup.repeats(table).collect()}
        assert got == want

    check(docs, [(r["doc_id"], r["text"], None) for r in rows])
    check(edge.dropDuplicates(["doc_id"]), [x for k, x in enumerate(EDGE) if x[0] not in {y[0] for y in EDGE[:k]}])


def test_op8_passage_inside_a_line(spark):
    passage = " ".join(f"Sentence number {i} of the passage tells its own story." for i in range(8))
    data = [(i, f"own words {i} before it {passage} and own words {i} after it") for i in range(1, 4)] + [(9, "clean " * 60)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup.repeats(df).collect()}
    assert not got[1].spans and not got[9].spans
    for i in (2, 3):
        (a, b), = [tuple(s) for s in got[i].spans]
        assert data[i - 1][1][a:b] == passage
    cut = {r.doc_id: r.text for r in substring_dedup.without_spans(df, substring_dedup.repeated_runs(df)).collect()}
    assert cut[1] == data[0][1] and passage not in cut[2] and cut[2].startswith("own words 2 before it ")


# -- 9 ------------------------------------------------------------------
def shingles(text, k):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return set(zip(*[w[i:] for i in range(k)], strict=False)) if len(w) >= k else ({tuple(w)} if w else set())


def linked(data, k, percent):
    ids = [(1 << 63) if i is None else i for i, _, _ in data]
    sets = [shingles(t, k) for _, t, _ in data]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * len(sets[a] | sets[b]):
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return [find(i) for i in ids], sets


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_op9_components(docs, edge, rows, k, percent):
    for table, data in both(docs, edge, rows):
        root, sets = linked(data, k, percent)
        want = sorted((i or 0, len(s), 0 if c == 1 << 63 else c) for (i, _, _), s, c in zip(data, sets, root, strict=True))
        got = ngram_join.similar_groups(table, k, percent).collect()
        assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == want


def test_op9_one_group_keeps_the_smallest(docs, rows):
    data = [(r["doc_id"], r["text"], None) for r in rows]
    root, _ = linked(data, 5, 80)
    got = ngram_join.one_per_group(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == set(root)


def test_op9_near_copies_in_a_chain(spark):
    base = [f"w{i}" for i in range(400)]
    data = []
    for i in range(60):  # each differs a little from the one before, far ends differ a lot
        base[(i * 6) % 400] = f"new{i}"
        data.append((i, " ".join(base), None))
    df = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    root, _ = linked(data, 3, 90)
    assert {r.doc_id: r.component_id for r in ngram_join.similar_groups(df, 3, 90).collect()} == dict(enumerate(root))


# -- 10 -----------------------------------------------------------------
def test_op10_round_trip(docs, edge, rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    for table, data in both(docs, edge, rows):
        data = sorted(data, key=lambda r: (-1 if r[0] is None else r[0], r[1] or ""))
        want, start = [], 0
        for i, text, _ in data:
            ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
            want.append((i or 0, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        got = token_output.token_output(table, path).collect()
        assert sorted((r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)


def test_op10_code_of_all_lengths():
    x = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1] * 7, np.uint32)
    for n in range(len(x)):
        assert (token_output.unpack_ids(*token_output.pack_ids(x[:n]), n) == x[:n]).all()


# -- empty tables -------------------------------------------------------
def test_empty_tables(none):
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    for f in (mixing.mix, quality.quality, sharding.shard_rows, licenses.scan, line_dedup.removed_lines,
              exact_dedup.exact_groups, packing.pack, substring_dedup.repeats, ngram_join.similar_groups,
              lambda d: token_output.token_output(d, path), mixing.mixed_documents, line_dedup.drop_lines,
              ngram_join.one_per_group, quality.clean_documents):
        assert f(none).count() == 0


def test_op10_new_words_share_texts():
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    t, asked = Tokenizer.from_file(path), []
    encoder = token_output.Encoder(path, "<u2")

    class Counting:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return t.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counting()
    texts = [" ".join(f"w{'xyz'[i % 3]}{i}, end{i}." for i in range(k, k + 700)) for k in range(0, 1400, 100)]
    texts += ["a <|endoftext|> b<|endoftext|>", "", " lead", "trail \u00a0", "two  spaces", "\u0120 \u00e4\n\u0120x .", ". a. 7.", None]
    for again in range(2):
        out = encoder.encode(pa.array(texts, pa.string()), 0).to_pylist()
        for text, x in zip(texts, out, strict=True):
            want = [*t.encode(text or "", add_special_tokens=False).ids, 0]
            assert np.frombuffer(x, "<u2").tolist() == want, (again, text)
    assert len(asked) < 200
    # where a text's tokens do not show its words, they are encoded one by one
    encoder.opens[:] = False
    assert encoder._spaced(["one", "two"]) == [np.array(t.encode(x, add_special_tokens=False).ids, "<u2").tobytes()
                                               for x in (" one", " two")]
