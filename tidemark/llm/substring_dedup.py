"""Operator 8: substring dedup by hashing units of text.

Method: normalise units, group their digests over the corpus, keep the
earliest ranked occurrence, remove the rest and retain original offsets.

Units: lines alone miss a passage set into the middle of a line, so lines are
cut further, after sentence ends and before words in upper case.  The cuts
depend on the text around them only, so a repeated passage is cut alike
wherever it stands.  Short units repeat by chance; an occurrence is removed
only within a run of repeated units of at least ``min_words`` words that
follow each other.

Occurrences rank by (doc_id, offset), rows without a doc_id last.  Two units
are equal if their normalised text (lower case, runs of space as one) has the
same digest and length.

Defined cases: NULL or empty text has no units; each row is a document of its
own, so rows without a doc_id, or of one doc_id, are told apart, and rank by hash of
text; other columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import ROW, keyed, stage, text_chunks

MIN_WORDS = 25
#: A unit: up to a sentence end or line end, or up to a word in upper case.
_UNIT = re.compile(r"[^\s](?:[^.!?\n ]|[.!?](?![\s])| (?![A-ZÀ-ÖØ-Þ]))*[.!?]*")


def units(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of each unit, in order."""
    for m in _UNIT.finditer(text):
        yield m.span()


def hashed_units(docs: DataFrame) -> DataFrame:
    """(doc, unit, start, stop, words, digest, again): again marks a unit equal to
    an earlier one of its document."""
    names = ["doc", "unit", "start", "stop", "words", "digest", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text", 2 << 20):
            doc, unit, start, stop, words, digest, again = ([] for _ in names)
            for d, text in zip(chunk.column("doc").to_pylist(), chunk.column("text").to_pylist(), strict=True):
                seen: set[int] = set()
                for k, (a, b) in enumerate(units(text or "")):
                    w = text[a:b].lower().split()
                    x = xxhash.xxh3_64_intdigest(" ".join(w))
                    doc.append(d)
                    unit.append(k)
                    start.append(a)
                    stop.append(b)
                    words.append(len(w))
                    digest.append(x)
                    again.append(x in seen)
                    seen.add(x)
            yield pa.record_batch(
                [pa.array(doc, pa.int64()), pa.array(unit, pa.int32()), pa.array(start, pa.int32()),
                 pa.array(stop, pa.int32()), pa.array(words, pa.int32()),
                 np.array(digest, np.uint64).view(np.int64), pa.array(again, pa.bool_())], names)

    return docs.mapInArrow(run, "doc long, unit int, start int, stop int, words int, digest long, again boolean")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, spans, n_words): per row with any, by its number from ``keyed``, the
    runs to remove as character offsets (start, stop) of the original text."""
    return _runs(keyed(docs)[0], min_words)


def _runs(rows: DataFrame, min_words: int) -> DataFrame:
    docs = rows.select(F.col(ROW).alias("doc"), F.col("text").cast("string"))
    u = stage(hashed_units(docs), "units")
    same = ["digest", "words"]
    # the first document of each digest, only where there is a second
    first = u.where("not again").groupBy(*same).agg(F.min("doc").alias("first"), F.max("doc").alias("last")) \
        .where("last > first").drop("last")
    first = stage(first, "repeated-units")
    later = u.join(first, same).where("doc > first or again").select("doc", "unit", "start", "stop", "words")
    inside = u.where("again").join(first, same, "left_anti").select("doc", "unit", "start", "stop", "words")
    hit = later.unionByName(inside).groupBy("doc").agg(
        F.array_sort(F.collect_set(F.struct("unit", "start", "stop", "words"))).alias("hits"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc, hits in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                h = hits.values.flatten()
                unit, start, stop, words = (x.to_numpy() for x in h)
                cut = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1] + 1])
                size = np.add.reduceat(words, cut)
                ends = np.r_[cut[1:], len(unit)] - 1
                keep = size >= min_words
                if keep.any():
                    spans = [{"start": int(s), "stop": int(e)} for s, e in zip(start[cut[keep]], stop[ends[keep]], strict=True)]
                    out.append((doc, spans, int(size[keep].sum())))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.record_batch([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], kind),
                                   pa.array([x[2] for x in out], pa.int64())], ["doc", "spans", "n_words"])

    return hit.mapInArrow(runs, "doc long, spans array<struct<start:int,stop:int>>, n_words long")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document row: doc_id, spans to remove, n_removed_words."""
    rows, _ = keyed(docs)
    found = stage(_runs(rows, min_words), "runs")
    return rows.select("doc_id", F.col(ROW).alias("doc")).join(found, "doc", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"),
        F.coalesce("n_words", F.lit(0).cast("long")).alias("n_removed_words"))


def without_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents without the spans that ``repeated_runs`` found."""
    cut = F.aggregate(
        "__spans", F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(F.concat(acc["done"], F.substring("text", acc["at"] + 1, x["start"] - acc["at"])).alias("done"),
                                x["stop"].alias("at")),
        lambda acc: F.concat(acc["done"], F.substring("text", acc["at"] + 1, F.char_length("text"))))
    return keyed(docs)[0].join(found.select(F.col("doc").alias(ROW), F.col("spans").alias("__spans")), ROW, "left") \
        .withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)
