"""Exact set-similarity join by prefix, length, positional and bitmap filters.

Both users, line dedup and the shingle join, have units (a document, or a line
of one) with a set of 64-bit hashes each.  Documents are input rows, known by the
number that ``common.keyed`` gives them.  Two sets link when
``100 * |x & y| >= percent * |x | y|``.

1. ``survey`` reads the texts once and counts values and unit digests over all
   of them.  A value or digest is heavy if its count is at least 1/2**20 of the
   total, so at most 2**20 are, whatever the input: small enough to send to
   every task.  Hashed bitmaps, sized by what they hold up to 16 MB, mark what
   occurs twice or more, and values in more units than ``split_from``.
   Sets are ordered by (heavy count, hash): rare values first, common ones last.
2. ``tiles``: two linked sets share a value among their first
   ``n - ceil(percent * n / 100) + 1``, so these are dealt out by value; a value
   in very many units is dealt out together with each value that may be the next
   shared one, so its group falls into small ones (``dealt_values``).  Each
   value group, sorted by size, is read as a stream; each set is compared with the
   ``reach`` anchors before it, sets in which the value comes early enough to link
   with one of their size or larger, and the first of its size, under
   three exact bounds: sizes, positions of the first shared value, and the bit count
   of the XOR of parity bitmaps (each set bit needs a value that only one set has).
   Of the pairs that pass, the later unit nominates the closest, or all up to
   ``nominations``.  Equal units meet
   by digest in the same shuffle; those of a heavy digest are settled where they
   lie, so no task gathers them.
3. ``verify`` first holds the nominated pairs against whole bitmaps, about one
   bit per value of a set (the 128 bits of a posting say little about sets of
   hundreds of values; smaller sets need no more), then joins the pairs left with
   the units' texts and counts the intersection of the sorted arrays.
4. ``more_pairs`` lists what passes the bounds, those of the whole bitmaps among
   them, and was not nominated, only for sets whose outcome is still open.  A group of n near copies so costs about n
   comparisons, not n squared, and no link is lost.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import mix, signed, stage, text_chunks

#: At most this many heavy values, and heavy digests, exist by their definition.
HEAVY_SLOTS = 1 << 20
#: Rows of one value group held at once by the streaming stage.
HELD_ROWS = 500_000
#: Least and most bits of a hashed bitmap; between them, 16 a value.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
#: Order in ``_streamed``: the low bits of a key make room for the size.
SIZE_BITS = 12
#: Values of sets turned into bitmaps at once; postings in one batch.
SLICE = 1 << 17
#: Values of several chunks whose counts a task adds up before it passes them on.
MERGED = 1 << 20
#: Larger than the number of any row.
NO_ID = (1 << 63) - 1
#: ``pos`` of rows that are no set members: a unit among equals, a settled unit,
#: a unit's whole bitmap.
EQUALS, SETTLED, BITMAP = -1, -2, -3

POSTING = "key long, doc long, line int, n int, pos int, sig long, sig2 long, digest int"
#: What a posting is dealt out and sorted by, and its fields in one value (a whole
#: bitmap follows them): a shuffle handles two columns a posting, not nine.
DEALT = "at long, row binary"
FIELDS = np.dtype([("key", "<i8"), ("doc", "<i8"), ("sig", "<i8"), ("sig2", "<i8"),
                   ("line", "<i4"), ("n", "<i4"), ("pos", "<i4"), ("digest", "<i4")])
TILE = POSTING + ", x_doc long, x_line int, dist int, lead_doc long, lead_line int, more boolean, open boolean, bitmap binary"
PAIR = ["doc", "line", "x_doc", "x_line"]
PAIR_TYPE = "doc long, line int, x_doc long, x_line int"


class Sets(NamedTuple):
    """Units of a chunk: set ``i`` is ``values[offsets[i]:offsets[i + 1]]`` in the
    global order, ``id1`` and ``id2`` the digest of what makes units equal;
    ``again`` marks units equal to an earlier one of their document."""
    doc: np.ndarray
    line: np.ndarray
    offsets: np.ndarray
    values: np.ndarray
    id1: np.ndarray
    id2: np.ndarray
    again: np.ndarray


class Heavy(NamedTuple):
    values: np.ndarray  # ascending
    counts: np.ndarray

    def count(self, values: np.ndarray) -> np.ndarray:
        """Count of each value, 0 where it is not heavy."""
        if not len(self.values):
            return np.zeros(len(values), np.int64)
        at = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        return np.where(self.values[at] == values, self.counts[at], 0)


NONE_HEAVY = Heavy(np.empty(0, np.uint64), np.empty(0, np.int64))


class Units:
    """What a user of the join provides."""

    percent = 80
    #: Anchors before it with which a set is compared in the first round.
    reach = 31
    #: Pairs a set nominates in one value group before the group counts as open.
    nominations = 1
    #: A value that is counted more often is dealt out with the next shared one.
    split_from: int | None = None
    #: From this size on, sets have too many pairs of values for that.
    split_below = 512
    #: Least size of the sets that have a whole bitmap.
    bitmap_from = 1
    #: Are all values counted, so that a value counted once can't be shared?
    counts_all = False
    #: Is every unit reported, or only those with an earlier equal?
    reports_all = False

    def counted(self, chunk: pa.RecordBatch) -> tuple:
        """(values, counts, id1, id2, doc), the last three for units that are not
        ``again``."""
        raise NotImplementedError

    def sets(self, chunk: pa.RecordBatch, heavy: Heavy) -> Sets:
        raise NotImplementedError

    def texts(self, chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(doc, line, text) of each unit."""
        raise NotImplementedError


class Survey(NamedTuple):
    heavy: Heavy
    shared_values: np.ndarray | None
    split_values: np.ndarray | None
    shared_ids: np.ndarray
    hot_ids: dict[tuple[int, int], int]  # digest -> smallest document


def need(percent: int, n):
    """Smallest intersection of two linked sets of sizes adding up to ``n``."""
    return -(-percent * n // (100 + percent))


def prefix_size(percent: int, n):
    return n - -(-percent * n // 100) + 1


def leading(offsets: np.ndarray, values: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set index, position, value) of the first ``size`` values of each set."""
    owner = np.repeat(np.arange(len(size)), size)
    pos = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    return owner, pos, values[offsets[:-1][owner] + pos]


def dealt_values(s: Sets, size: np.ndarray, units: Units, known: Survey) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set index, position, key) of what a set is dealt out by.

    Two linked sets meet at least at their first shared value, whose position in
    either is then a bound: no value before it is shared.  Is it one of many units
    (``split_values``), they meet at its key combined with the second shared value,
    which is among the first ``size + 1``; the position before that one is the same bound.
    Sets of ``split_below`` values or more have too many such pairs: they, and all
    that may link with them, are dealt out by the single value also.  So are sets
    for which one shared value is enough.
    """
    owner, pos, value = leading(s.offsets, s.values, size)
    if known.shared_values is not None:
        some = _marked(known.shared_values, value)
        owner, pos, value = owner[some], pos[some], value[some]
    if known.split_values is None:
        return owner, pos, value
    n, percent = np.diff(s.offsets), units.percent
    hot = _marked(known.split_values, value)
    single = (100 * n >= percent * units.split_below) | (-(-percent * n // 100) < 2)
    at = np.flatnonzero(hot & (n < units.split_below)[owner])
    many = np.minimum(size + 1, n)[owner[at]] - pos[at] - 1
    first = np.repeat(at, many)
    after = pos[first] + 1 + np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)
    second = s.values[s.offsets[:-1][owner[first]] + after]
    if known.shared_values is not None:
        some = _marked(known.shared_values, second)
        first, after, second = first[some], after[some], second[some]
    alone = ~hot | single[owner]
    return (np.r_[owner[alone], owner[first]], np.r_[pos[alone], after - 1],
            np.r_[value[alone], mix(combined(value[first], second))])


def _bit(x: np.ndarray, bits: int) -> np.ndarray:
    return (mix(x) & np.uint64(bits - 1)).astype(np.int64)


def _marked(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = _bit(x, len(bits) * 64)
    return ((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def hashed_bits(df: DataFrame, *columns: str) -> np.ndarray:
    """Bitmap of the rows' hashes, at most 16 MB whatever their number; ``df`` is a
    staged table, which is counted first."""
    size = min(max(LEAST_BITS, 1 << (16 * df.count()).bit_length()), MOST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _bit(combined(*(c.to_numpy() for c in b.columns)), size)
            yield pa.record_batch([at >> 6, np.int64(1) << (at & 63)], ["word", "bits"])

    got = df.select(*columns).mapInArrow(run, "word long, bits long") \
        .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return out


def combined(first: np.ndarray, *more: np.ndarray) -> np.ndarray:
    out = first.astype(np.uint64)
    for x in more:
        out = mix(out) + x.astype(np.uint64)
    return out


def survey(docs: DataFrame, units: Units) -> Survey:
    """Exact counts over all texts, kept where they exceed one."""
    names = ["k1", "k2", "doc", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for chunk in text_chunks(batches, "text"):
            values, counts, id1, id2, doc = units.counted(chunk)
            yield pa.record_batch([signed(id1), signed(id2), doc, np.ones(len(doc), np.int64)], names)
            held.append((values, counts))
            rows += len(values)
            # words recur from chunk to chunk; values of which a few are counted seldom do
            if rows > MERGED or not units.counts_all:
                yield added_up(held)
                held, rows = [], 0
        if held:
            yield added_up(held)

    def added_up(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        values, counts = (np.concatenate(part) for part in zip(*held, strict=True))
        if len(held) > 1:
            order = np.argsort(values)
            values, counts = values[order], counts[order]
            first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else order
            values, counts = values[first], np.add.reduceat(counts, first) if len(first) else counts
        return pa.record_batch([signed(values), np.zeros(len(values), np.int64), pa.nulls(len(values), pa.int64()),
                                counts.astype(np.int64)], names)

    grouped = docs.mapInArrow(run, "k1 long, k2 long, doc long, n long").groupBy("k1", "k2", F.isnull("doc").alias("value")) \
        .agg(F.min("doc").alias("first"), F.sum("n").alias("n")).where("n > 1")
    counts = stage(grouped, "counts")
    totals = {r.value: r.n for r in counts.groupBy("value").agg(F.sum("n").alias("n")).collect()}
    least = lambda value: max(16, totals.get(value, 0) // HEAVY_SLOTS + 1)
    values, ids = counts.where("value"), counts.where("not value")
    got = values.where(F.col("n") >= least(True)).select("k1", "n").toArrow()
    v = got["k1"].to_numpy().view(np.uint64)
    order = np.argsort(v)
    hot = ids.where(F.col("n") >= max(64, least(False))).select("k1", "k2", "first").toArrow().to_pylist()
    return Survey(Heavy(v[order], got["n"].to_numpy()[order]),
                  hashed_bits(values, "k1") if units.counts_all else None,
                  hashed_bits(values.where(F.col("n") > units.split_from), "k1") if units.split_from else None,
                  hashed_bits(ids, "k1", "k2"),
                  {(r["k1"], r["k2"]): r["first"] for r in hot})


def _reduce(op, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return op.reduceat(values, offsets[:-1]) if len(offsets) > 1 else np.empty(0, np.uint64)


def digests(offsets: np.ndarray, values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Order-free hash of each set."""
    return _reduce(np.add, mix(values + np.uint64(salt)), offsets)


def bitmaps(s: Sets, at: np.ndarray) -> pa.Array:
    """Parity bitmap of each set of ``at`` (ascending), of the least power of two
    of bits that reaches its size, 64 at least.  XOR of its two halves gives the
    bitmap of half the bits."""
    n = np.diff(s.offsets)
    bits = np.zeros(len(n), np.int64)
    bits[at] = np.int64(1) << np.maximum(6, np.ceil(np.log2(np.maximum(n[at], 1))).astype(np.int64))
    base = np.r_[0, np.cumsum(bits)]
    odd = np.zeros(base[-1], np.uint8)
    # a long text's set is large: its temporaries are held for a slice at a time
    for lo in range(0, int(s.offsets[-1]), SLICE):
        values = s.values[lo:lo + SLICE]
        owner = np.searchsorted(s.offsets, np.arange(lo, lo + len(values)), "right") - 1
        some = bits[owner] > 0
        owner, values = owner[some], values[some]
        place = base[owner] + (values & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
        np.add.at(odd, place, np.uint8(1))
    odd &= 1
    starts = (base[np.r_[at, len(n)]] // 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(starts), pa.py_buffer(np.packbits(odd))])


def tiles(docs: DataFrame, units: Units, known: Survey) -> DataFrame:
    """Nominations and open members of the value groups (pos >= 0), the units
    with an equal one (``equal_units``) and the whole bitmaps of those dealt out."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    percent = units.percent

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        hot = np.array(sorted({k for k, _ in known.hot_ids}), np.int64)
        for chunk in text_chunks(batches, "text", 3 << 20):
            s = units.sets(chunk, known.heavy)
            n, id1, id2 = np.diff(s.offsets), signed(s.id1), signed(s.id2)
            bit, upper = np.uint64(1) << (s.values >> np.uint64(58)), (s.values >> np.uint64(57) & np.uint64(1)).astype(bool)
            sig = [signed(_reduce(np.bitwise_xor, np.where(half, bit, np.uint64(0)), s.offsets)) for half in (upper, ~upper)]
            short = (id1 ^ id2).astype(np.int32)
            first = np.full(len(n), NO_ID)  # smallest document of a heavy digest
            for k in np.flatnonzero(np.isin(id1, hot)):
                first[k] = known.hot_ids.get((int(id1[k]), int(id2[k])), NO_ID)
            is_hot = first < NO_ID
            copy = s.again | (is_hot & (s.doc > first))
            # of equal units in this chunk the first is enough
            keep = np.lexsort((s.line, s.doc))
            keep = keep[~copy[keep]]
            keep = keep[np.unique(id1[keep], return_index=True)[1]]
            size = np.zeros(len(n), np.int64)
            size[keep] = prefix_size(percent, n[keep])
            owner, pos, value = dealt_values(s, size, units, known)
            yield from _dealt(value, s, owner, n, pos, sig, short)
            at = np.unique(owner)
            at = at[n[at] >= units.bitmap_from]
            yield from _dealt(combined(s.doc[at], s.line[at]), s, at, n, np.full(len(at), BITMAP), sig, short, bitmaps(s, at))
            equals = ~is_hot & ~s.again & _marked(known.shared_ids, combined(id1, id2))
            at = np.flatnonzero(equals)
            yield from _dealt(id1[at], s, at, n, np.full(len(at), EQUALS), (id2, sig[1]), short)
            at = np.flatnonzero(~equals if units.reports_all else copy)
            rep = np.where(is_hot, np.minimum(first, s.doc), s.doc)
            yield from _dealt(id1[at], s, at, n, np.full(len(at), SETTLED), (rep, sig[1]), short)

    # one long to sort by, which Spark sorts by radix; ``_streamed`` does the rest
    dealt = docs.mapInArrow(post, DEALT).repartition(F.shiftright("at", SIZE_BITS)).sortWithinPartitions("at").select("row")
    reach, reports_all, nominations = units.reach, units.reports_all, units.nominations
    return stage(dealt.mapInArrow(lambda batches: _settled(batches, percent, reports_all, reach, nominations), TILE), "tiles")


def equal_units(t: DataFrame) -> DataFrame:
    """Units with an equal one, the smallest document in x_doc."""
    return t.where(F.col("pos").isin(EQUALS, SETTLED))


def _dealt(key, s: Sets, at, n, pos, sig, short, bitmap=None) -> Iterator[pa.RecordBatch]:
    key, low = signed(key) if key.dtype == np.uint64 else key, (1 << SIZE_BITS) - 1
    for lo in range(0, len(at), SLICE):
        part = slice(lo, lo + SLICE)
        which = at[part]
        rows = np.empty(len(which), FIELDS)
        for name, value in (("key", key[part]), ("doc", s.doc[which]), ("sig", sig[0][which]), ("sig2", sig[1][which]),
                            ("line", s.line[which]), ("n", n[which]), ("pos", pos[part]), ("digest", short[which])):
            rows[name] = value
        ends = np.arange(len(rows) + 1, dtype=np.int32) * FIELDS.itemsize
        row = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])
        if bitmap is not None:
            row = pc.binary_join_element_wise(row, bitmap.slice(lo, len(rows)), b"")
        yield pa.record_batch([key[part] & ~low | np.minimum(n[which], low), row], ["at", "row"])


def _rows(row: pa.Array) -> np.ndarray:
    """The fields of dealt rows without bitmaps."""
    if not len(row):
        return np.empty(0, FIELDS)
    ends = np.frombuffer(row.buffers()[1], np.int32)
    return np.frombuffer(row.buffers()[2], FIELDS, len(row), int(ends[row.offset]))


def passes(percent: int, a: dict, i, b: dict, j):
    """(may the sets link with this as their first shared value, bits that differ)
    for members i of a and j of b of one value group."""
    ni, nj, pi, pj = a["n"][i], b["n"][j], a["pos"][i], b["pos"][j]
    least = need(percent, ni + nj)
    dist = np.bitwise_count(a["sig"][i] ^ b["sig"][j]) + np.bitwise_count(a["sig2"][i] ^ b["sig2"][j])
    ok = (100 * np.minimum(ni, nj) >= percent * np.maximum(ni, nj)) & (dist <= ni + nj - 2 * least) \
        & (np.minimum(ni - pi, nj - pj) >= least)
    return ok, dist


def _columns(batch) -> dict[str, np.ndarray]:
    if batch.schema.names == ["row"]:
        rows = _rows(batch.column("row"))
        out = {name: np.ascontiguousarray(rows[name]) for name in FIELDS.names}
    else:
        out = {name: col.to_numpy(zero_copy_only=False) for name, col in zip(batch.schema.names, batch.columns, strict=True)}
    for name in ("n", "pos"):
        out[name] = out[name].astype(np.int64)
    for name in ("sig", "sig2"):
        out[name] = np.ascontiguousarray(out[name]).view(np.uint64)
    out["digest"] = np.ascontiguousarray(out["digest"])
    return out


def _take(cols: dict, at) -> dict:
    return {k: v[at] for k, v in cols.items()}


def _streamed(batches: Iterator[pa.RecordBatch], held: int, order: list[str],
              reach: int = 0) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """Whole value groups, each sorted by ``order``, of a stream sorted by all but the
    low ``SIZE_BITS`` bits of the key, as (columns, is new, is split).

    More than ``held`` rows that agree in these bits come in parts; each part repeats,
    as not new, their first row and the last ``reach``.
    """
    def out(cols: dict, old: int, whole: bool) -> tuple[dict, np.ndarray, np.ndarray]:
        group = cols["key"] >> SIZE_BITS
        split = (group == group[0]) & (old > 0 or not whole)
        at = np.lexsort([cols[x] for x in reversed(order)])
        return _take(cols, at), (np.arange(len(at)) >= old)[at], split[at]

    rest, old = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = _columns(batch)
        if rest is not None:
            cols = {k: np.concatenate([rest[k], v]) for k, v in cols.items()}
        group = cols["key"] >> SIZE_BITS
        cut = int(np.searchsorted(group, group[-1], "left"))
        if cut:
            yield out(_take(cols, slice(0, cut)), old, True)
            old = 0
        rest = _take(cols, slice(cut, None))
        if (n := len(rest["key"])) > held:
            yield out(rest, old, False)
            at = np.r_[0, max(1, n - reach):n]
            rest, old = _take(rest, at), len(at)
    if rest is not None:
        yield out(rest, old, True)


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of the group of each row, size of the group of each row)."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[starts, len(key)])
    return np.repeat(starts, size), np.repeat(size, size)


def _equals(c: dict, reports_all: bool) -> pa.RecordBatch:
    """Units among equals (key and sig are their digest) and settled ones."""
    order = np.lexsort((c["line"], c["doc"], c["pos"], c["sig"], c["key"]))
    c = _take(c, order)
    same = np.r_[True, (c["key"][1:] != c["key"][:-1]) | (c["sig"][1:] != c["sig"][:-1]) | (c["pos"][1:] != c["pos"][:-1])]
    start = np.maximum.accumulate(np.where(same, np.arange(len(same)), 0))
    settled = c["pos"] == SETTLED
    first = np.where(settled, c["sig"].view(np.int64), c["doc"][start])
    return _tile(_take(c, settled | reports_all | (c["doc"] != first)), first[settled | reports_all | (c["doc"] != first)])


def _tile(c: dict, x_doc, x_line=None, dist=None, lead=None, more=None, is_open=None, bitmap=None) -> pa.RecordBatch:
    m = len(c["key"])
    nothing = pa.nulls(m, pa.int64())
    no_line, no = pa.nulls(m, pa.int32()), np.zeros(m, bool)
    return pa.record_batch(
        [c["key"], c["doc"], c["line"], c["n"].astype(np.int32), c["pos"].astype(np.int32), c["sig"].view(np.int64),
         c["sig2"].view(np.int64), c["digest"], x_doc, no_line if x_line is None else x_line,
         no_line if dist is None else dist, nothing if lead is None else lead[0], no_line if lead is None else lead[1],
         no if more is None else more, no if is_open is None else is_open,
         pa.nulls(m, pa.binary()) if bitmap is None else bitmap],
        ["key", "doc", "line", "n", "pos", "sig", "sig2", "digest", "x_doc", "x_line", "dist", "lead_doc", "lead_line", "more", "open", "bitmap"])


def _settled(batches: Iterator[pa.RecordBatch], percent: int, reports_all: bool, reach: int,
             nominations: int) -> Iterator[pa.RecordBatch]:
    """Bitmaps as they come, apart from the value groups."""
    aside = []

    def others() -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, size = b.column("row"), FIELDS.itemsize
            whole = pc.greater(pc.binary_length(rows), size)
            if pc.any(whole).as_py():
                at = rows.filter(whole).to_numpy(zero_copy_only=False).tolist()
                fields = pa.record_batch([pa.array([x[:size] for x in at], pa.binary())], ["row"])
                aside.append(_tile(_columns(fields), pa.nulls(len(at), pa.int64()),
                                   bitmap=pa.array([x[size:] for x in at], pa.binary())))
                rows = rows.filter(pc.invert(whole))
            yield pa.record_batch([rows], ["row"])

    for out in _nominate(others(), percent, reports_all, reach, nominations):
        while aside:
            yield aside.pop()
        yield out
    yield from aside


def _nominate(batches: Iterator[pa.RecordBatch], percent: int, reports_all: bool, reach: int,
              nominations: int) -> Iterator[pa.RecordBatch]:
    for c, new, split in _streamed(batches, HELD_ROWS, ["key", "n", "doc", "line"], reach):
        c["split"] = split
        member = c["pos"] >= 0
        if (~member & new).any():
            yield _equals(_take(c, ~member & new), reports_all)
        c, new = _take(c, member), new[member]
        if not len(new):
            continue
        many = (_groups(c["key"])[1] > 1) | c["split"]
        c, new = _take(c, many), new[many]
        if not len(new):
            continue
        # equal sets (digest, signature and size) of a group count once
        order = np.lexsort((c["line"], c["doc"], c["n"], c["sig"], c["digest"], c["key"]))
        k = [c[x][order] for x in ("key", "digest", "sig", "n")]
        first = np.sort(order[np.r_[True, np.logical_or.reduce([x[1:] != x[:-1] for x in k])]])
        c, new = _take(c, first), new[first]
        many = (_groups(c["key"])[1] > 1) | c["split"]
        c, new = _take(c, many), new[many]
        m = len(new)
        if not m:
            continue
        key, n, doc, line = c["key"], c["n"], c["doc"], c["line"]
        best, at, seen = np.full(m, 999), np.full(m, -1), np.zeros(m, np.int64)
        live, others = np.arange(m), []
        # of two linked sets the one that comes first by size is an anchor
        left = n - c["pos"]
        anchor = need(percent, 2 * n) <= left
        anchors, before = np.flatnonzero(anchor), np.cumsum(anchor) - anchor
        for step in range(1, min(reach, len(anchors)) + 1):
            # by size: an anchor too small for a set is followed by smaller ones
            live = live[before[live] >= step]
            a = anchors[before[live] - step]
            fits = (key[a] == key[live]) & (percent * n[live] <= 100 * n[a])
            live, a = live[fits], a[fits]
            if not len(live):
                break
            ok, dist = passes(percent, c, live, c, a)
            a, b, dist = a[ok], live[ok], dist[ok].astype(np.int64)
            after = (doc[b] > doc[a]) | ((doc[b] == doc[a]) & (line[b] >= line[a]))
            for y, x, d in ((b[after], a[after], dist[after]), (a[~after], b[~after], dist[~after])):
                seen[y] += 1
                if nominations > 1 and (few := seen[y] <= nominations).any():
                    others.append((y[few], x[few], d[few]))
                closer = d < best[y]
                best[y[closer]], at[y[closer]] = d[closer], x[closer]
        # the sets of its group whose size allows a link, and the first of its own size
        start = _groups(key)[0]
        width = int(n.max()) + 1
        place, i = start * width + n, np.arange(m)
        most = np.minimum(100 * n // percent, (100 + percent) * left // percent - n)
        low = np.searchsorted(place, start * width + -(-percent * n // 100))
        high = np.searchsorted(place, start * width + np.minimum(most, width - 1), "right")
        lead = np.searchsorted(place, place)
        far = np.flatnonzero(before - before[lead] > reach)
        lead, of_size = np.full(m, -1), lead
        lead[far] = np.where(passes(percent, c, far, c, of_size[far])[0], of_size[far], -1)
        missed = (before - before[low] > reach) | (anchor & (before[np.maximum(high - 1, i)] - before > reach))
        more = (seen > nominations) | missed | c["split"]
        is_open = np.logical_or.reduceat(more, np.unique(start))[np.unique(start, return_inverse=True)[1]]
        keep = new & (is_open | (at >= 0) | (lead >= 0))
        col = lambda name, i: pa.array(c[name][i[keep]], mask=i[keep] < 0)
        yield _tile(_take(c, keep), col("doc", at), col("line", at), best[keep].astype(np.int32),
                    (col("doc", lead), col("line", lead)), more[keep], is_open[keep])
        if others:
            y, x, d = (np.concatenate(part) for part in zip(*others, strict=True))
            second = new[y] & (x != at[y]) & (seen[y] <= nominations)
            y, x, d = y[second], x[second], d[second]
            if len(y):
                yield _tile(_take(c, y), c["doc"][x], c["line"][x], d.astype(np.int32))


def nominated(t: DataFrame) -> DataFrame:
    """The nominations of each unit, the closest first by ``place`` from 1."""
    t = t.where("pos >= 0")
    first = t.where("x_doc is not null").select(*PAIR, "dist")
    lead = t.where("lead_doc is not null").select(
        "doc", "line", F.col("lead_doc").alias("x_doc"), F.col("lead_line").alias("x_line"), F.lit(128).alias("dist"))
    pairs = first.unionByName(lead).groupBy(*PAIR).agg(F.min("dist").alias("dist"), F.count("*").alias("votes"))
    w = Window.partitionBy("doc", "line").orderBy("dist", F.desc("votes"), "x_doc", "x_line")
    return pairs.withColumn("place", F.row_number().over(w))


def more_pairs(t: DataFrame, percent: int, open_units: DataFrame, per_unit: int | None = None) -> DataFrame:
    """Pairs of one value group that pass the bounds, for open units.

    ``open_units`` has doc, line, part, a row a unit: an open unit meets all
    units before it but those open in the same part.  ``per_unit`` keeps the
    closest so many of each unit and value.  Groups where all was nominated, that
    have no open unit, or only open units of one part go before anything is
    gathered by value.  With the columns key and n, a unit is open in these groups
    only, and of a group only what is of a size to link with its open units is read.
    """
    members = t.where("pos >= 0 and open").select("key", "doc", "line", "n", "pos", "sig", "sig2", "digest")
    whole = t.where(F.col("pos") == BITMAP).select("doc", "line", "bitmap")
    keyed = "key" in open_units.columns
    if keyed:
        open_units = stage(open_units, "open-units")
        sizes = open_units.groupBy("key").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
        members = members.join(sizes, "key").where(f"100 * n >= {percent} * lo and {percent} * n <= 100 * hi").drop("lo", "hi")
    unit = ["key", "doc", "line"] if keyed else ["doc", "line"]
    side = stage(members.join(open_units.select(*unit, "part"), unit, "left").join(whole, ["doc", "line"], "left")
                 .withColumn("is_open", F.col("part").isNotNull()).withColumn("part", F.coalesce("part", F.lit(0))), "open-tiles")
    if not keyed:
        live = stage(side.groupBy("key").agg(F.max("is_open").alias("any"), F.min("is_open").alias("all"),
                                             F.min("part").alias("lo"), F.max("part").alias("hi"))
                     .where("any and not (all and lo = hi)").select("key"), "open-keys")
        side = side.join(live, "key")
    side = side.repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, _, _ in _streamed(batches, 1 << 62, ["key", "doc", "line"]):
            starts = np.unique(_groups(c["key"])[0])
            for a, b in zip(starts, np.r_[starts[1:], len(c["key"])], strict=True):
                g = _take(c, slice(a, b))
                bits = WholeBitmaps(g["bitmap"])
                for lo in range(0, b - a, 256):
                    i = lo + np.flatnonzero(g["is_open"][lo:lo + 256])[:, None]
                    j = np.arange(min(b - a, lo + 256))[None, :]
                    ok, dist = passes(percent, g, i, g, j)
                    ok &= (j < i) & ~(g["is_open"][j] & (g["part"][i] == g["part"][j]))
                    y, x = np.nonzero(ok)
                    n = g["n"][i[y, 0]] + g["n"][x]
                    far = bits.distance(i[y, 0], x) > n - 2 * need(percent, n)
                    ok[y[far], x[far]] = False
                    if per_unit is not None:
                        rank = np.argsort(np.argsort(np.where(ok, dist, 999), axis=1, kind="stable"), axis=1)
                        ok &= rank < per_unit
                    y, x = np.nonzero(ok)
                    if len(y):
                        y = i[y, 0]
                        yield pa.record_batch([g["doc"][y], g["line"][y], g["doc"][x], g["line"][x]], PAIR)

    return side.mapInArrow(run, PAIR_TYPE).distinct()


class WholeBitmaps:
    """Whole bitmaps of the members of a value group, None where there is none."""

    def __init__(self, bitmaps: np.ndarray):
        self.bitmaps = bitmaps
        self.size = np.fromiter((len(b) if b is not None else 0 for b in bitmaps), np.int64, len(bitmaps))
        self.place = np.zeros(len(bitmaps), np.int64)  # among the members of its size
        for size in np.unique(self.size):
            at = np.flatnonzero(self.size == size)
            self.place[at] = np.arange(len(at))
        self._folded: dict[tuple[int, int], np.ndarray] = {}

    def folded(self, size: int, to: int) -> np.ndarray:
        """The bitmaps of one size, a row each, halved to ``to`` bytes."""
        if (size, to) not in self._folded:
            self._folded[size, to] = _folded(pa.array(self.bitmaps[self.size == size], pa.binary()), to)
        return self._folded[size, to]

    def distance(self, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Bits in which members y and x differ, 0 where a bitmap is missing."""
        out = np.zeros(len(y), np.int64)
        if not len(y):
            return out
        both = np.stack([self.size[y], self.size[x]])
        for p, q in np.unique(both, axis=1).T:
            if not (p and q):
                continue
            at = np.flatnonzero((both[0] == p) & (both[1] == q))
            a, b = self.folded(p, min(p, q)), self.folded(q, min(p, q))
            for part in np.array_split(at, len(at) * a.shape[1] // SLICE + 1):  # bounded temporaries
                out[part] = np.bitwise_count(a[self.place[y[part]]] ^ b[self.place[x[part]]]).sum(axis=1)
        return out


def may_link(pairs: DataFrame, t: DataFrame, percent: int) -> DataFrame:
    """The pairs that the bit counts of their whole bitmaps leave, or that lack one."""
    whole = t.where(F.col("pos") == BITMAP)

    def side(doc: str, line: str, name: str) -> DataFrame:
        return whole.select(F.col("doc").alias(doc), F.col("line").alias(line), F.col("n").alias(f"n_{name}"),
                            F.col("bitmap").alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "a", 2 << 20):
            n = sum(pc.fill_null(chunk.column(c), 0).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            size = [pc.fill_null(pc.binary_length(chunk.column(c)), 0).to_numpy() for c in "ab"]
            dist = np.zeros(chunk.num_rows, np.int64)
            for both in np.unique(np.stack(size), axis=1).T:
                if not both.all():
                    continue
                at = np.flatnonzero((size[0] == both[0]) & (size[1] == both[1]))
                a, b = (_folded(chunk.column(c).take(pa.array(at)), both.min()) for c in "ab")
                dist[at] = np.bitwise_count(a ^ b).sum(axis=1)
            yield chunk.select(PAIR).filter(pa.array(dist <= n - 2 * need(percent, n)))

    both = pairs.select(*PAIR).join(side("doc", "line", "a"), ["doc", "line"], "left") \
        .join(side("x_doc", "x_line", "b"), ["x_doc", "x_line"], "left")
    return both.select(*PAIR, "n_a", "n_b", "a", "b").mapInArrow(run, PAIR_TYPE).distinct()


def _folded(bitmap: pa.Array, size: int) -> np.ndarray:
    """Bitmaps of one size, a row each, halved to ``size`` bytes."""
    out = np.frombuffer(b"".join(bitmap.to_pylist()), np.uint64).reshape(len(bitmap), -1)
    while out.shape[1] * 8 > size:
        half = out.shape[1] // 2
        out = out[:, :half] ^ out[:, half:]
    return out


def verify(pairs: DataFrame, t: DataFrame, docs: DataFrame, units: Units) -> DataFrame:
    """The pairs that link, by the exact count of common values."""
    percent = units.percent
    pairs = stage(may_link(pairs, t, percent), "bitmap-pairs")
    either = pairs.select("doc", "line").union(pairs.select("x_doc", "x_line"))
    wanted = docs.sparkSession.sparkContext.broadcast(hashed_bits(either, "doc", "line"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            doc, line, text = units.texts(chunk)
            at = np.flatnonzero(_marked(wanted.value, combined(doc, line)))
            yield pa.record_batch([doc[at], line[at], text.take(pa.array(at))], ["doc", "line", "text"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "a", 2 << 20):
            numbers = pa.array(np.arange(chunk.num_rows))
            a, b = (units.sets(pa.record_batch([numbers, chunk.column(c)], ["doc", "text"]), NONE_HEAVY) for c in "ab")
            keep = np.zeros(chunk.num_rows, bool)
            place = {d: k for k, d in enumerate(b.doc.tolist())}
            for i, d in enumerate(a.doc.tolist()):
                if (k := place.get(d)) is None:
                    continue
                x, y = a.values[a.offsets[i]:a.offsets[i + 1]], b.values[b.offsets[k]:b.offsets[k + 1]]
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                keep[d] = 100 * common >= percent * (len(both) - common)
            yield chunk.select(PAIR).filter(pa.array(keep))

    texts = stage(docs.mapInArrow(pick, "doc long, line int, text string"), "texts")
    both = pairs.select(*PAIR).join(texts.withColumnRenamed("text", "a"), ["doc", "line"]) \
        .join(texts.select(F.col("doc").alias("x_doc"), F.col("line").alias("x_line"), F.col("text").alias("b")),
              ["x_doc", "x_line"])
    return both.select(*PAIR, "a", "b").mapInArrow(count, PAIR_TYPE)
