"""Operator 5: line dedup by an exact set-similarity join.

Method: tokens of a line ordered by rarity, prefix, positional and length
filters, exact Jaccard, later matches removed.

Lines are split at ``\\n``; a line's set holds its distinct lower-cased words.
Lines rank by (doc_id, line number), rows without a doc_id last.  A line is
removed when its text equals that of an earlier line or its set links with that
of an earlier line (``percent``), whether or not the earlier one is itself
removed.  Every line with a word takes part; ``min_words`` is there for callers
that want to spare short ones.

Defined cases: NULL or empty text has no lines to remove; each row is a document
of its own, so rows without a doc_id, or of one doc_id, are told apart, and rank by
hash of text; other columns pass through ``drop_lines`` untouched.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import ROW, keyed, split_words, stage, text_chunks, with_ids
from .setjoin import PAIR, Heavy, Sets, Units, equal_units, more_pairs, nominated, survey, tiles, verify

MIN_WORDS = 1


class Lines(Units):
    """Distinct hashed words per line, in rarity order; equal text makes lines
    equal."""

    counts_all = True
    # lines have few enough words for the bits of a posting, and share frequent ones
    reach, bitmap_from = 1023, 129
    # few lines hold a frequent word among their rarest (about 1 of 100 at 1000 lines)
    nominations, split_from = 4, 1 << 16

    def __init__(self, percent: int, min_words: int):
        self.percent, self.min_words = percent, min_words

    def texts(self, chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        lines = pc.split_pattern(pc.fill_null(chunk.column("text"), ""), "\n")
        per_text = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(chunk.column("doc").to_numpy(), per_text).astype(np.int64)
        line = np.arange(len(doc)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        return doc, line.astype(np.int32), lines.flatten()

    def _split(self, chunk: pa.RecordBatch) -> tuple:
        """(doc, line, offsets, codes, hashes by code, id1, id2, again) of the lines
        with enough words."""
        doc, line, text = self.texts(chunk)
        offsets, codes, uniq = split_words(pc.utf8_lower(text))
        size = np.diff(offsets)
        keep = size >= self.min_words
        at = np.flatnonzero(keep)
        raw = text.take(pa.array(at)).cast(pa.binary()).to_numpy(zero_copy_only=False)
        both = b"".join(map(xxhash.xxh3_128_digest, raw))
        ids = np.frombuffer(both, ">u8").astype(np.uint64).reshape(-1, 2)
        codes = codes[np.repeat(keep, size)]
        doc, line = doc[at], line[at]
        order = np.lexsort((line, ids[:, 1], ids[:, 0], doc))
        again = np.zeros(len(at), bool)
        a, b = order[1:], order[:-1]
        again[a] = (doc[a] == doc[b]) & (ids[a] == ids[b]).all(axis=1) & (line[a] != line[b])
        return doc, line, np.r_[0, np.cumsum(size[keep])], codes, uniq, ids[:, 0], ids[:, 1], again

    def counted(self, chunk: pa.RecordBatch) -> tuple:
        doc, _, _, codes, uniq, id1, id2, again = self._split(chunk)
        count = np.bincount(codes, minlength=len(uniq))
        some = np.flatnonzero(count)
        return uniq[some], count[some], id1[~again], id2[~again], doc[~again]

    def sets(self, chunk: pa.RecordBatch, heavy: Heavy) -> Sets:
        doc, line, offsets, codes, uniq, id1, id2, again = self._split(chunk)
        # ascending hashes are looked up faster, and a stable sort keeps them so within a count
        order = np.argsort(uniq)
        order = order[np.argsort(heavy.count(uniq[order]), kind="stable")]
        rank = np.empty(len(uniq), np.int64)
        rank[order] = np.arange(len(uniq))
        width = max(1, len(uniq))
        key = np.sort(np.repeat(np.arange(len(doc)), np.diff(offsets)) * width + rank[codes])
        key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
        owner = key // width
        values = uniq[order][key - owner * width] if len(key) else np.empty(0, np.uint64)
        return Sets(doc, line, np.r_[0, np.cumsum(np.bincount(owner, minlength=len(doc)))], values, id1, id2, again)


def later_lines(rows: DataFrame, percent: int = 80, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, line, x_doc): lines to remove and the row of an earlier line that they
    match, by the numbers of ``keyed`` rows."""
    docs = rows.select(F.col(ROW).alias("doc"), F.col("text").cast("string"))
    units = Lines(percent, min_words)
    t = tiles(docs, units, survey(docs, units))
    equal = equal_units(t).select("doc", "line", "x_doc")
    near = stage(nominated(t), "nominated")
    tested = near.where("place <= 8").select(*PAIR)
    found = stage(verify(tested, t, docs, units), "near-lines")
    # still open: nominated but not tested, or not all nominated, and not removed yet
    gone = found.select("doc", "line").union(equal.select("doc", "line"))
    left = near.where("place > 8").select(*PAIR).join(gone, ["doc", "line"], "left_anti").select(*PAIR)
    # what a line saw in a value group where it is not ``more`` was all nominated
    rest = t.where("pos >= 0 and more").select("key", "doc", "line", "n") \
        .join(gone, ["doc", "line"], "left_anti").withColumn("part", F.xxhash64("doc", "line"))
    pairs = stage(left.union(more_pairs(t, percent, rest)).distinct().join(tested, PAIR, "left_anti"), "pairs")
    if not pairs.isEmpty():
        found = found.unionByName(verify(pairs, t, docs, units))
    return equal.unionByName(found.select("doc", "line", "x_doc")) \
        .groupBy("doc", "line").agg(F.min("x_doc").alias("x_doc"))


def removed_lines(docs: DataFrame, percent: int = 80, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document row: doc_id, n_lines (with a word), n_removed,
    removed (line numbers from 0, ascending), matched (doc_id of a row with an
    earlier match, per removed line; NULL if it has none)."""
    rows, own = keyed(docs)
    gone = with_ids(later_lines(rows, percent, min_words), "x_doc", rows, own).groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("line", "x_doc"))).alias("gone"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            lines = pc.split_pattern(pc.fill_null(chunk.column("text"), ""), "\n")
            some = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines.flatten())), 0).to_numpy(zero_copy_only=False)
            first = np.cumsum(pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64))
            before = np.r_[0, np.cumsum(some)][np.r_[0, first]]
            yield pa.record_batch([chunk.column("doc_id"), chunk.column("doc"), np.diff(before)], ["doc_id", "doc", "n_lines"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    sizes = rows.select("doc_id", F.col(ROW).alias("doc"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(count, f"doc_id {id_type}, doc long, n_lines long")
    return sizes.join(gone, "doc", "left").select(
        "doc_id", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
        F.coalesce(F.size("gone.line"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("gone.line", F.array().cast("array<int>")).alias("removed"),
        F.coalesce("gone.x_doc", F.array().cast("array<long>")).alias("matched"))


def drop_lines(docs: DataFrame, percent: int = 80, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without their removed lines; n_chars, where present,
    follows the text.  Documents that lose all their words go."""
    rows, _ = keyed(docs)
    gone = later_lines(rows, percent, min_words).groupBy(F.col("doc").alias(ROW)) \
        .agg(F.collect_set("line").alias("__gone"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("__gone", i)), "\n")
    out = rows.join(gone, ROW, "left") \
        .withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)) \
        .where(F.col("__gone").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out
