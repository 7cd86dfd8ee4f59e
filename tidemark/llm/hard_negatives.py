"""Hard-negative mining: rows of another label that score just below an anchor's
positives.

A component x counts as ``floor(256 * x)`` (x as a double) and a score is the
integer inner product.  Of an anchor's other rows of its label the first
``per_anchor`` are its positives, higher scores first, ties by smaller vec_id.
For each positive the first ``per_pair`` rows of other labels with
``low * positive <= 100 * score <= 100 * positive`` are its negatives.

Method.  Rows are dealt out in blocks and anchors in blocks; a task holds one
block of each (a stated query set against all rows).  Inside it rows lie in
buckets of similar length, longest first, and a bucket sorts its normalised
vectors by coordinate when that coordinate is first asked for.  An anchor needs
a cosine of at least ``need / (|anchor| * longest of the bucket)``: above 1 the
bucket is left out; else each of the anchor's ``FOCUS`` largest coordinates
allows only a range of values, found in the sorted list by binary search.  The
shortest range, cut with the other ranges, holds the candidates, whose scores are
then computed exactly; where the ranges rule out little, the whole bucket is
scored in one product.  ``need`` starts at the window's lower end (positives:
none) and rises to the worst of the rows found once there are enough, bucket by
bucket.  Spark merges what the blocks found.

Cases: rows with a NULL label, a NULL vector or a NULL or non-finite component
take no part.  Rows are told apart by their place, so vec_ids may repeat; a row
without one is no anchor and comes last among ties; equal vec_ids with equal
scores come in order of place.  A shorter vector counts as filled up with zeros.
A positive with a negative score has no negatives, as its window is empty.
Scores are exact also beyond 2**53; one that does not fit a long is an error.  An
empty table gives no rows; extra columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import stage

ANCHOR_EVERY = 100
NOISY_EVERY = 7
LABELS = 10
SCALE = 256
PER_ANCHOR = 5
PER_PAIR = 5
LOW_PERCENT = 80

#: Rows and anchors in a block, rows in a bucket, coordinates looked at per anchor.
ROWS = 4096
ANCHORS = 2048
BUCKET = 1024
FOCUS = 4
#: A bucket is scored whole for an anchor whose shortest range holds more than this share of it.
DENSE = 0.25
#: Slack for cosines, which are floating point; scores are integers.
SLACK = 1e-9

_ROWS = "row long, vec_id long, label long, vec array<double>"
_FOUND = "anchor long, positive_rank int, score long, row long, vec_id long"


# --------------------------------------------------------------------------
# Rows
# --------------------------------------------------------------------------

def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that take part, their components as whole numbers."""
    for batch in batches:
        batch = batch.filter(pc.and_(pc.is_valid(batch["label"]), pc.is_valid(batch["embedding"])))
        lists = batch["embedding"]
        if not batch.num_rows:
            continue
        of = pc.list_parent_indices(lists).to_numpy()
        x = np.floor(SCALE * pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.float64))
        bad = np.zeros(batch.num_rows, bool)
        bad[of[~np.isfinite(x)]] = True  # a NULL component reads as NaN
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)[~bad]
        kept = batch.filter(pa.array(~bad))
        vec = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(x[~bad[of]]))
        yield pa.RecordBatch.from_arrays([kept["row"], kept["vec_id"], kept["label"], vec], ["row", "vec_id", "label", "vec"])


def vectors(df: DataFrame) -> DataFrame:
    """(row, vec_id, label, vec) of the rows that take part, written to the shared folder."""
    v = F.col("vec_id").cast("long")
    label = F.col("label").cast("long")
    noisy = F.when(v % NOISY_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    return stage(df.select(F.monotonically_increasing_id().alias("row"), v.alias("vec_id"), noisy.alias("label"),
                           F.col("embedding").cast("array<double>").alias("embedding"))
                 .mapInArrow(_whole, _ROWS), "vectors")


# --------------------------------------------------------------------------
# One block of rows
# --------------------------------------------------------------------------

def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(lists)), sizes)
    out[of, np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products, rows x anchors, as int64."""
    most = np.abs(rows).max(initial=0) * np.abs(anchors).max(initial=0) * max(rows.shape[-1], 1)
    if most < 2.0 ** 53:  # every partial sum is a whole number below 2**53
        return (rows @ anchors.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in rows], object) @ np.array([[int(x) for x in a] for a in anchors], object).T
    return exact.astype(np.int64)  # OverflowError beyond a long


class Bucket:
    """Rows of similar length with sorted lists of their coordinates."""

    def __init__(self, rows: np.ndarray, lengths: np.ndarray):
        self.rows, self.longest = rows, float(lengths.max(initial=0))
        self.unit = rows / np.where(lengths > 0, lengths, 1)[:, None]
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_by(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        if coordinate not in self._sorted:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            self._sorted[coordinate] = order, self.unit[order, coordinate]
        return self._sorted[coordinate]

    def ranges(self, unit: np.ndarray, focus: np.ndarray, cosine: np.ndarray):
        """Per anchor and focus coordinate: least and greatest value a row may
        have there, and where the sorted list enters and leaves that range."""
        q = np.take_along_axis(unit, focus, 1)
        t = np.clip(cosine, 0, 1)[:, None]
        spread = np.sqrt(np.maximum(1 - q * q, 0) * (1 - t * t))
        # the cosine may exceed t: the feasible values reach 1 (or -1) when the anchor's own value lies past t
        low = np.where(q <= -t, -1.0, q * t - spread) - SLACK
        high = np.where(q >= t, 1.0, q * t + spread) + SLACK
        enter, leave = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for c in np.unique(focus):
            values, here = self.sorted_by(int(c))[1], focus == c
            enter[here] = np.searchsorted(values, low[here], "left")
            leave[here] = np.searchsorted(values, high[here], "right")
        return low, high, enter, leave

    def candidates(self, focus, low, high, enter, leave) -> np.ndarray:
        """Rows inside all ranges of one anchor, from its shortest list."""
        best = int(np.argmin(leave - enter))
        found = self.sorted_by(int(focus[best]))[0][enter[best]:leave[best]]
        for k in range(len(focus)):
            if k != best:
                value = self.unit[found, focus[k]]
                found = found[(value >= low[k]) & (value <= high[k])]
        return found


class Best:
    """The first ``k`` rows per query by (score descending, vec_id, place)."""

    def __init__(self, queries: int, k: int):
        self.k, self.found = k, [[] for _ in range(queries)]

    def worst(self, query: int) -> float:
        """Score a further row must reach."""
        found = self.found[query]
        return -found[-1][0] if len(found) == self.k else -math.inf

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if len(scores) > self.k:  # ties of the k-th score stay until they are ordered
            floor = np.partition(scores, len(scores) - self.k)[-self.k]
            keep = scores >= floor
            scores, ids, rows = scores[keep], ids[keep], rows[keep]
            if len(scores) > 4 * self.k:
                first = np.lexsort((rows, ids, -scores))[:self.k]
                scores, ids, rows = scores[first], ids[first], rows[first]
        new = zip((-scores).tolist(), ids.tolist(), rows.tolist())
        self.found[query] = sorted([*self.found[query], *new])[:self.k]


_NO_ID = np.iinfo(np.int64).max


def search(rows: pa.Table, unit: np.ndarray, anchors: np.ndarray, lengths: np.ndarray,
           need: Callable[[int], float], take: Callable[[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray], None]) -> None:
    """Show ``take`` every row of the block whose score with an anchor may reach
    ``need`` of that anchor: (anchor, scores, vec_ids, row numbers, labels)."""
    matrix = _matrix(rows["vec"].combine_chunks(), anchors.shape[1])
    ids = pc.fill_null(rows["vec_id"], _NO_ID).to_numpy()
    numbers, labels = rows["row"].to_numpy(), rows["label"].to_numpy()
    size = np.sqrt(np.square(matrix).sum(axis=1))
    order = np.argsort(-size, kind="stable")
    focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
    for at in range(0, len(order), BUCKET):
        part = order[at:at + BUCKET]
        bucket = Bucket(matrix[part], size[part])
        needs = np.array([need(a) for a in range(len(anchors))])
        reach = lengths * bucket.longest
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(needs > 0, needs / reach, 0.0)  # no bound where any score will do
        open_ = np.flatnonzero((cosine <= 1 + SLACK) & (needs < math.inf))
        if not len(open_):
            continue
        low, high, enter, leave = bucket.ranges(unit[open_], focus[open_], cosine[open_])
        dense = (leave - enter).min(axis=1, initial=len(part)) > DENSE * len(part)
        whole = open_[dense]
        scores = _products(bucket.rows, anchors[whole]) if len(whole) else None
        for k, a in enumerate(whole):
            s = scores[:, k]
            near = np.flatnonzero(s >= needs[a]) if needs[a] > -math.inf else slice(None)
            take(a, s[near], ids[part][near], numbers[part][near], labels[part][near])
        for k in np.flatnonzero(~dense):
            a = open_[k]
            found = bucket.candidates(focus[a], low[k], high[k], enter[k], leave[k])
            if len(found):
                s = _products(bucket.rows[found], anchors[a:a + 1])[:, 0]
                take(a, s, ids[part[found]], numbers[part[found]], labels[part[found]])


def _prepared(rows: pa.Table, anchors: pa.Table):
    width = max((pc.max(pc.list_value_length(t["vec"])).as_py() or 0) for t in (rows, anchors))
    matrix = _matrix(anchors["vec"].combine_chunks(), width)
    lengths = np.sqrt(np.square(matrix).sum(axis=1))
    return matrix, lengths, matrix / np.where(lengths > 0, lengths, 1)[:, None]


def _result(anchor, rank, found) -> pa.Table:
    score, ids, rows = (np.array([f[k] for f in found], np.int64) for k in range(3))
    return pa.table([pa.array(np.array(anchor, np.int64)), pa.array(np.array(rank, np.int32)), pa.array(-score), pa.array(rows),
                     pa.array(ids, mask=ids == _NO_ID)], ["anchor", "positive_rank", "score", "row", "vec_id"])


def _positives(k: int):
    def tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not (rows.num_rows and anchors.num_rows):
            return _result([], [], [])
        matrix, lengths, unit = _prepared(rows, anchors)
        own, best = anchors["row"].to_numpy(), Best(len(matrix), k)

        def take(a, scores, ids, numbers, labels):
            other = numbers != own[a]
            best.add(a, scores[other], ids[other], numbers[other])
        search(rows, unit, matrix, lengths, best.worst, take)
        flat = [(own[a], f) for a, found in enumerate(best.found) for f in found]
        return _result([a for a, _ in flat], [0] * len(flat), [f for _, f in flat])
    return tile


def _negatives(k: int, percent: int):
    def tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not (rows.num_rows and anchors.num_rows):
            return _result([], [], [])
        matrix, lengths, unit = _prepared(rows, anchors)
        own, label = anchors["row"].to_numpy(), anchors["label"].to_numpy()
        windows, first = [], [0]  # (anchor, rank, least, most) of each positive
        for a, positives in enumerate(anchors["positives"].to_pylist()):
            windows += [(own[a], p["rank"], -(-percent * p["score"] // 100), p["score"]) for p in positives]
            first.append(len(windows))
        best = Best(len(windows), k)

        def need(a):
            return min((max(windows[w][2], best.worst(w)) for w in range(first[a], first[a + 1])
                        if windows[w][2] <= windows[w][3]), default=math.inf)

        def take(a, scores, ids, numbers, labels):
            other = labels != label[a]
            scores, ids, numbers = scores[other], ids[other], numbers[other]
            for w in range(first[a], first[a + 1]):
                inside = (scores >= max(windows[w][2], best.worst(w))) & (scores <= windows[w][3])
                if inside.any():
                    best.add(w, scores[inside], ids[inside], numbers[inside])
        search(rows, unit, matrix, lengths, need, take)
        flat = [(windows[w], f) for w, found in enumerate(best.found) for f in found]
        return _result([w[0] for w, _ in flat], [w[1] for w, _ in flat], [f for _, f in flat])
    return tile


# --------------------------------------------------------------------------
# All blocks
# --------------------------------------------------------------------------

def _blocks(df: DataFrame, n: int, copies: int, own: str, other: str) -> DataFrame:
    """Rows dealt to ``n`` blocks ``own``, once per block ``other``.

    The columns are aliased: a cogroup of two frames that share columns loses
    those of its right side when unread results are pruned."""
    return df.select(*[F.col(c).alias(c) for c in df.columns]) \
        .withColumn(own, F.pmod(F.xxhash64("row"), F.lit(n))) \
        .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, every: int = ANCHOR_EVERY, per_anchor: int = PER_ANCHOR, per_pair: int = PER_PAIR,
                   low_percent: int = LOW_PERCENT) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id is divisible by ``every``.  ``df`` has
    columns vec_id, label and embedding.
    """
    rows = vectors(df)
    anchors = rows.where(F.col("vec_id") % every == 0)
    # two counts; block numbers follow from them, so a block has about ROWS rows at any size
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("a")).first()
    n, m = max(1, -(-sizes.n // ROWS)), max(1, -(-sizes.a // ANCHORS))
    dealt = _blocks(rows, n, m, "r", "q")
    tile = ["r", "q"]

    of_label = ["label", *tile]
    found = dealt.groupBy(*of_label).cogroup(_blocks(anchors, m, n, "q", "r").groupBy(*of_label)) \
        .applyInArrow(_positives(per_anchor), _FOUND)
    positives = stage(_first(found, ["anchor"], per_anchor).select(
        "anchor", "rank", "score", F.col("vec_id").alias("positive_id")), "positives")
    # at most per_anchor of them for an anchor
    with_positives = stage(anchors.join(
        positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("rank", "score")).alias("positives")), "row"),
        "anchors")
    found = dealt.groupBy(*tile).cogroup(_blocks(with_positives, m, n, "q", "r").groupBy(*tile)) \
        .applyInArrow(_negatives(per_pair, low_percent), _FOUND)
    negatives = _first(found, ["anchor", "positive_rank"], per_pair).select(
        "anchor", "positive_rank", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = positives.select("anchor", F.col("rank").alias("positive_rank"), "positive_id", F.col("score").alias("positive_score"))
    return negatives.join(pairs, ["anchor", "positive_rank"]).join(ids, "anchor") \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
