"""Operator 9: n-gram Jaccard join of whole documents.

Method: size-banded tiles with hashed bitmap signatures; bit counts bound the
overlap from above before the exact intersection of sorted arrays.  The tiles
are the value groups of ``setjoin``: within one, only documents of compatible
sizes meet.  A tile over all documents of a size band would grow with the
square of the corpus, so tiles are formed per shared prefix value.

Texts with equal shingle sets are one class, found by a 128-bit digest;
components are computed over one document per class.

Defined cases: NULL text or text without words has an empty set and links with
nothing; fewer words than ``words`` make one shingle of the whole sequence;
each row is a node of its own, also rows without a doc_id or of one doc_id (which
can so lie in several components of one smallest doc_id); rows without a doc_id
rank last, and a component of only such rows has component_id NULL; other
columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import ROW, keyed, mix, split_words, stage, with_ids
from .components import components
from .setjoin import (PAIR, Heavy, Sets, Units, digests, equal_units, leading, more_pairs, nominated, prefix_size, survey,
                      tiles, verify)


class Shingles(Units):
    """Distinct hashed word n-grams per text, A-Z in lower case."""

    reports_all = True

    def __init__(self, words: int, percent: int):
        self.words, self.percent = words, percent

    def _hashed(self, chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc, offsets, values by hash) of the texts that have words."""
        k = self.words
        offsets, codes, uniq = split_words(pc.ascii_lower(pc.fill_null(chunk.column("text"), "")))
        h = uniq[codes]
        grams = np.zeros(max(0, len(h) - k + 1), np.uint64)
        for i in range(k if len(grams) else 0):
            grams = mix(grams + h[i:len(h) - k + 1 + i])
        parts, docs = [], []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            if b - a >= k:
                u = np.sort(grams[a:b - k + 1])
                parts.append(u[np.r_[True, u[1:] != u[:-1]]])
            elif b > a:
                short = np.full(1, b - a, np.uint64)
                for x in h[a:b]:
                    short = mix(short + x)
                parts.append(mix(short))
            else:
                continue
            docs.append(i)
        values = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return chunk.column("doc").to_numpy()[docs].astype(np.int64), np.r_[0, np.cumsum(sizes)].astype(np.int64), values

    def counted(self, chunk: pa.RecordBatch) -> tuple:
        """Counts what may be in a prefix: leading values by hash, with some
        room for heavy ones that move back."""
        doc, offsets, values = self._hashed(chunk)
        n = np.diff(offsets)
        some = leading(offsets, values, np.minimum(n, prefix_size(self.percent, n) * 5 // 4 + 8))[2]
        v, c = np.unique(some, return_counts=True)
        return v, c, digests(offsets, values), digests(offsets, values, 1), doc

    def sets(self, chunk: pa.RecordBatch, heavy: Heavy) -> Sets:
        doc, offsets, values = self._hashed(chunk)
        id1, id2 = digests(offsets, values), digests(offsets, values, 1)
        if len(heavy.values) and len(values):
            count = heavy.count(values)
            for i in np.unique(np.repeat(np.arange(len(doc)), np.diff(offsets))[count > 0]):
                at = slice(offsets[i], offsets[i + 1])
                values[at] = values[at][np.argsort(count[at], kind="stable")]
        return Sets(doc, np.zeros(len(doc), np.int32), offsets, values, id1, id2, np.zeros(len(doc), bool))

    def texts(self, chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        doc = chunk.column("doc").to_numpy()
        return doc, np.zeros(len(doc), np.int32), chunk.column("text")


def similar_links(rows: DataFrame, words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, links, labels) of the ``keyed`` rows whose shingle sets link.

    classes: doc, n_shingles, rep (the smallest doc with an equal set), for
    documents with words.  links: a, b between class representatives; every
    two linked classes are connected by a path of links.  labels: node,
    component of the representatives that have a link.
    """
    docs = rows.select(F.col(ROW).alias("doc"), F.col("text").cast("string"))
    units = Shingles(words, percent)
    t = tiles(docs, units, survey(docs, units))
    classes = equal_units(t).select("doc", F.col("n").cast("long").alias("n_shingles"), F.col("x_doc").alias("rep"))

    near = stage(nominated(t), "nominated")
    tested = near.where("place = 1").select(*PAIR)
    links = stage(verify(tested, t, docs, units), "links")
    for per_unit in (3, None):
        label = components(links.select(F.col("doc").alias("a"), F.col("x_doc").alias("b")))
        part = lambda name: label.select(F.col("node").alias(name), F.col("component").alias(f"{name}_part"))
        # nominated and not tested, then what was not nominated, between components
        left = near.where("place > 1").select(*PAIR).join(part("doc"), "doc", "left").join(part("x_doc"), "x_doc", "left") \
            .where(F.coalesce("doc_part", "doc") != F.coalesce("x_doc_part", "x_doc")).select(*PAIR)
        parts = t.where("pos >= 0 and open").select("doc", "line").distinct() \
            .join(label.withColumnRenamed("node", "doc"), "doc", "left") \
            .select("doc", "line", F.coalesce("component", "doc").alias("part"))
        pairs = stage(left.union(more_pairs(t, percent, parts, per_unit)).distinct().join(tested, PAIR, "left_anti"), "pairs")
        if pairs.isEmpty():
            break
        links = stage(links.union(verify(pairs, t, docs, units)), "links")
        tested = tested.union(pairs)
    else:
        label = components(links.select(F.col("doc").alias("a"), F.col("x_doc").alias("b")))
    return classes, links.select(F.col("doc").alias("a"), F.col("x_doc").alias("b")), label


def similar_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (smallest
    doc_id reachable by links)."""
    rows, own = keyed(docs)
    classes, _, label = similar_links(rows, words, percent)
    ids = classes.groupBy("doc").agg(F.max("n_shingles").alias("n_shingles"), F.min("rep").alias("rep")) \
        .join(label.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("doc", "n_shingles", F.coalesce("component", "rep").alias("component"))
    out = rows.select("doc_id", F.col(ROW).alias("doc")).join(ids, "doc", "left").select(
        "doc_id", F.coalesce("n_shingles", F.lit(0)).alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))
    return with_ids(out, "component_id", rows, own).select("doc_id", "n_shingles", "component_id")


def one_per_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Of each component the row of the smallest doc_id, rows without one last;
    rows without words all stay."""
    rows, _ = keyed(docs)
    classes, _, label = similar_links(rows, words, percent)
    gone = classes.join(label.withColumnRenamed("node", "rep"), "rep", "left") \
        .where(F.col("doc") > F.coalesce("component", "rep")).select(F.col("doc").alias(ROW)).distinct()
    return rows.join(gone, ROW, "left_anti").select(*docs.columns)
