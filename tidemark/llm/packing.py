"""Operator 7: conflict-constrained best-fit packing.

Method: documents go into bins of ``capacity`` words, largest first, each into
the tightest bin that has room and no conflict.  A bin carries a bitmap of its
sources and one of its duplicate clusters; a bin that shares either bit is
passed over and the search goes on to the next larger residual.

Documents over ``capacity`` words are cut into pieces: the full ones are bins
of their own, the rest is packed like a document.  Pieces are dealt by hash to
groups of about ``group_rows``, each packed by one task in bounded memory; a
hot source or a large cluster of copies is spread over all groups.  Packing in
groups costs at most the few bins of a group that stay open.

Defined cases: NULL or empty text makes a piece of 0 words, which conflicts
like any other; rows without source share one source; rows that repeat are
pieces of one cluster, so never in one bin; no rows, no bins; other columns are
ignored.
"""
from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import one_space, stage, word_count

CAPACITY = 2048
GROUP_ROWS = 4000


class Bins:
    """Open bins of one group, indexed by residual."""

    def __init__(self, capacity: int):
        self.by_residual: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0  # bit r: some bin has residual r
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.capacity = capacity

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin for a piece, and where in it the piece starts.  ``source`` and
        ``cluster`` are one-bit masks."""
        later = self.open >> size << size
        while later:
            low = later & -later
            residual = low.bit_length() - 1
            at = self.by_residual[residual]
            for k, b in enumerate(at):
                if not (self.sources[b] & source or self.clusters[b] & cluster):
                    at.pop(k)
                    if not at:
                        self.open ^= low
                    self._place(b, residual - size, source, cluster)
                    return b, self.capacity - residual
            later ^= low
        self.sources.append(0)
        self.clusters.append(0)
        self._place(len(self.sources) - 1, self.capacity - size, source, cluster)
        return len(self.sources) - 1, 0

    def _place(self, b: int, residual: int, source: int, cluster: int) -> None:
        self.sources[b] |= source
        self.clusters[b] |= cluster
        self.by_residual[residual].append(b)
        self.open |= 1 << residual


def _bits(values: pd.Series) -> list[int]:
    """One-bit mask per value, from the group's own numbering."""
    return [1 << int(k) for k in pd.factorize(values)[0]]


def pack(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, seed: int = 5) -> DataFrame:
    """One row per piece: doc_id, source, piece, first_word, n_words,
    pack_group, bin, bin_start."""
    text = F.col("text").cast("string")
    rows = stage(docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(text).alias("words"),
                             F.xxhash64(one_space(text)).alias("cluster")), "sizes")
    groups = max(1, -(-rows.count() // group_rows))
    pieces = rows.withColumn("piece", F.explode(F.sequence(
        F.lit(0), F.greatest(F.ceil(F.col("words") / capacity) - 1, F.lit(0)).cast("int"))))
    first = F.col("piece").cast("long") * capacity
    pieces = pieces.select("doc_id", "source", "cluster", "piece", first.alias("first_word"),
                           F.least(F.col("words") - first, F.lit(capacity)).cast("int").alias("n_words"))
    # numbered one by one, as rows that repeat have full pieces alike in all columns
    full = pieces.where(F.col("n_words") == capacity).select(
        "doc_id", "source", "piece", "first_word", "n_words", F.lit(-1).cast("long").alias("pack_group"),
        F.monotonically_increasing_id().alias("bin"), F.lit(0).alias("bin_start"))
    # Copies differ in doc_id, so a cluster is spread; rows that repeat whole are
    # spread by their place in the scratch table.
    salt = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "cluster", F.monotonically_increasing_id()), F.lit(groups))
    rest = pieces.where(F.col("n_words") < capacity).withColumn("pack_group", salt)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_words", "cluster", "doc_id"], ascending=[False, True, True], kind="stable")
        bins = Bins(capacity)
        put = [bins.put(int(n), s, c) for n, s, c in
               zip(pdf["n_words"], _bits(pdf["source"].fillna("\0null")), _bits(pdf["cluster"]), strict=True)]
        return pdf.assign(bin=[b for b, _ in put], bin_start=[s for _, s in put])[
            ["doc_id", "source", "piece", "first_word", "n_words", "pack_group", "bin", "bin_start"]]

    packed = rest.groupBy("pack_group").applyInPandas(
        fill, f"doc_id {id_type}, source string, piece int, first_word long, n_words int, pack_group long, bin long, "
              "bin_start int")
    return packed.unionByName(full)
