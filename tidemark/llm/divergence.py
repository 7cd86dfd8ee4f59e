"""Source divergence audit: how far the term distributions of the sources of a
language lie apart, and which terms a source uses more than its language does.

Terms are runs of letters (any character that is not ASCII counts as one), with
A-Z lower-cased.  A language keeps the terms that occur in ``min_docs`` of its
documents or more, V of them.  A group is a (lang, source) that occurs, also
without a term; with ``count`` occurrences of a kept term and N of all kept ones
it gives that term ``p = 1 + floor(SCALE * (count + 5) / (N + 5 V))``; a language
does likewise.  All of it is integer arithmetic.

Method.  The kept terms of a language, most frequent first, are the positions of
a segment tree, cut into blocks of ``WIDTH`` terms.  A task holds one block for
two bands of at most ``BAND`` groups.  It builds the groups' trees bottom up and
hash-consed: subtrees of equal counts are one node, wherever and in whichever
group they stand (rare terms make most subtrees all zero).  Two trees are then
walked from the roots together; the state is the two nodes and the groups' two
denominators, and each state is priced once however often it occurs.  Blocks add
up in Spark.  A task's memory depends on WIDTH and BAND alone.

Cases: NULL text, lang and source count as ''.  A document without terms still
makes its group; where no term is kept all distances are 0.  Repeated rows
count as often as they occur; doc_id is not used.  Very long texts are cut into
terms whole, one at a time.  Ties of value are ordered by item.  An empty table
gives no rows.  Other columns are ignored, whatever their names.  Counts are
exact up to N + 5 V < 2**53.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage, text_chunks

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
PRIOR = 5
#: Terms in a block (a power of two) and groups in a band.
WIDTH = 1024
BAND = 32
_COUNTS = "lang string, source string, term string, n long, docs long"
_PAIRS = "lang string, source string, item string, value long"

# Every byte that is part of a term stays, A-Z in lower case; all others become a space.
_TERM_BYTE = np.full(256, 0x20, np.uint8)
_TERM_BYTE[0x80:] = np.arange(0x80, 0x100)
_TERM_BYTE[0x61:0x7B] = np.arange(0x61, 0x7B)
_TERM_BYTE[0x41:0x5B] = np.arange(0x61, 0x7B)


def _split_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Terms of each text: (number per text, code per term, distinct terms)."""
    texts = pa.concat_arrays([pc.fill_null(texts, "").cast(pa.large_string())])
    _, offsets, data = texts.buffers()
    mapped = _TERM_BYTE[np.frombuffer(data, np.uint8)] if data is not None and data.size else np.empty(0, np.uint8)
    texts = pa.LargeStringArray.from_buffers(len(texts), offsets, pa.py_buffer(mapped), offset=texts.offset)
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.index(encoded.dictionary, pa.scalar("", encoded.dictionary.type)).as_py()
    if empty >= 0:  # a text without terms splits into one empty one
        text_of = np.repeat(np.arange(len(lengths)), lengths)
        keep = codes != empty
        lengths, codes = np.bincount(text_of[keep], minlength=len(lengths)), codes[keep]
    return lengths, codes, encoded.dictionary.cast(pa.string())


def _count_chunk(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """Occurrences and documents per (lang, source, term) of a chunk, and a row
    without a term per (lang, source)."""
    lang, source = lang.dictionary_encode(), source.dictionary_encode()
    n_source = max(len(source.dictionary), 1)
    group = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n_source \
        + source.indices.to_numpy(zero_copy_only=False)
    lengths, codes, terms = _split_terms(text)
    n_terms = max(len(terms), 1)
    in_doc, times = np.unique(np.repeat(np.arange(len(lengths)), lengths) * n_terms + codes, return_counts=True)
    key, place = np.unique(group[in_doc // n_terms] * n_terms + in_doc % n_terms, return_inverse=True)
    marks = np.unique(group)
    of = np.concatenate([key // n_terms, marks])
    n = np.concatenate([np.bincount(place, times, len(key)), np.zeros(len(marks))]).astype(np.int64)
    docs = np.concatenate([np.bincount(place, minlength=len(key)), np.zeros(len(marks), np.int64)])
    term = pa.concat_arrays([terms.take(pa.array(key % n_terms)), pa.nulls(len(marks), pa.string())])
    return pa.RecordBatch.from_arrays(
        [lang.dictionary.take(pa.array(of // n_source)), source.dictionary.take(pa.array(of % n_source)),
         term, pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in text_chunks(batches, "text"):
        yield _count_chunk(*(chunk.column(c).cast(pa.string()) for c in ("lang", "source", "text")))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term,
    and a row with a NULL term for every (lang, source)."""
    text = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return text.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term") \
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count, total) -> Column:
    """``1 + floor(SCALE * (count + PRIOR) / total)`` as an exact long."""
    return F.lit(1).cast("long") + F.call_function(
        "div", F.lit(SCALE).cast("decimal(10,0)") * (F.col(count) + PRIOR).cast("decimal(20,0)"),
        F.col(total).cast("decimal(20,0)"))


def _share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``share`` on arrays: long division by three digits of base 1000."""
    rest = count + PRIOR
    digits, rest = np.divmod(rest, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        digits = digits * 1000 + digit
    return digits + 1


# --------------------------------------------------------------------------
# Hash-consed trees of one block
# --------------------------------------------------------------------------

def build_trees(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Trees over the rows of ``counts`` (groups x 2**depth): the value of each
    leaf node, the children (left, right) of each inner node per level from the
    leaves up, and each row's root.  Equal subtrees are one node of their level."""
    leaves, node = np.unique(counts, return_inverse=True)
    node, known, levels = node.reshape(counts.shape), len(leaves), []
    while node.shape[1] > 1:
        pair, node_up = np.unique(node[:, 0::2] * known + node[:, 1::2], return_inverse=True)
        levels.append((pair // known, pair % known))
        node, known = node_up.reshape(len(counts), -1), len(pair)
    return leaves, levels, node[:, 0]


class _States:
    """Distinct unordered pairs of (denominator, node)."""

    def __init__(self, scales: int, nodes: int):
        self.scales, self.nodes = scales, nodes

    def pack(self, sa, na, sb, nb) -> np.ndarray:
        swap = (sa > sb) | (sa == sb) & (na > nb)
        sa, sb, na, nb = (np.where(swap, y, x) for x, y in ((sa, sb), (sb, sa), (na, nb), (nb, na)))
        return ((sa * self.scales + sb) * self.nodes + na) * self.nodes + nb

    def unpack(self, key):
        key, nb = np.divmod(key, self.nodes)
        key, na = np.divmod(key, self.nodes)
        sa, sb = np.divmod(key, self.scales)
        return sa, na, sb, nb


def price_pairs(counts: np.ndarray, totals: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum over the columns of ``|share of row a - share of row b|`` per pair.

    A negative count marks a column outside the block: it costs nothing."""
    leaves, levels, roots = build_trees(counts)
    scale, of = np.unique(totals, return_inverse=True)
    sizes = [len(leaves)] + [len(left) for left, _ in levels]
    at = _States(len(scale), sizes[-1])
    state, start = np.unique(at.pack(of[a], roots[a], of[b], roots[b]), return_inverse=True)
    links = []
    for (left, right), below in zip(reversed(levels), reversed(sizes[:-1])):
        sa, na, sb, nb = at.unpack(state)
        at = _States(len(scale), below)
        state, link = np.unique(np.concatenate([at.pack(sa, left[na], sb, left[nb]),
                                                at.pack(sa, right[na], sb, right[nb])]), return_inverse=True)
        links.append(link)
    sa, na, sb, nb = at.unpack(state)
    inside = leaves[na] >= 0
    price = np.zeros(len(state), np.int64)
    price[inside] = np.abs(_share(leaves[na[inside]], scale[sa[inside]]) - _share(leaves[nb[inside]], scale[sb[inside]]))
    for link in reversed(links):
        half = len(link) // 2
        price = price[link[:half]] + price[link[half:]]
    return price[start]


def _tiles(band: int):
    def tile(table: pa.Table) -> pa.Table:
        """Distances of the pairs between two bands of groups within one block."""
        mark = pc.is_null(table["pos"])
        groups = table.filter(mark).sort_by("g")
        cells = table.filter(pc.invert(mark))
        number, totals = groups["g"].to_numpy(), groups["total"].to_numpy()
        low, width, i, j = (groups[c][0].as_py() for c in ("low", "width", "i", "j"))
        counts = np.full((len(number), 1 << max(width - 1, 0).bit_length()), -1, np.int64)
        counts[:, :width] = 0
        counts[np.searchsorted(number, cells["g"].to_numpy()), cells["pos"].to_numpy() - low] = cells["n"].to_numpy()
        if i == j:
            a, b = np.triu_indices(len(number), 1)
        else:
            first = number // band == i
            a, b = (x.ravel() for x in np.meshgrid(np.flatnonzero(first), np.flatnonzero(~first), indexing="ij"))
        value = pa.array(price_pairs(counts, totals, a, b)) if width else pa.array(np.zeros(len(a), np.int64))
        names = groups["source"].combine_chunks()
        x, y = names.take(pa.array(a)), names.take(pa.array(b))
        lang = pa.array([groups["lang"][0].as_py()] * (2 * len(a)), pa.string())
        return pa.table([lang, pa.concat_arrays([x, y]), pa.concat_arrays([y, x]), pa.concat_arrays([value, value])],
                        ["lang", "source", "item", "value"])
    return tile


# --------------------------------------------------------------------------
# The audit
# --------------------------------------------------------------------------

def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group.

    Part ``pair``: each other source of the language with the distance to it,
    the largest first.  Part ``term``: the ``top`` kept terms whose share in the
    group exceeds the language's by most.  The groups of a language are numbered
    in one window: as many rows as sources, which come in pairs in the result.
    """
    counts = stage(term_counts(docs), "term-counts")
    order = [F.col("lang"), F.col("lang_n").desc(), F.col("term")]
    kept = counts.where("term is not null").groupBy("lang", "term") \
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d")).where(F.col("d") >= min_docs).drop("d")
    # positions ascend within the partitions of the range shuffle; a block lies in one
    kept = stage(kept.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("id", F.monotonically_increasing_id())
                 .select("lang", "term", "lang_n", F.expr(f"id div {WIDTH}").alias("block"),
                         (F.col("id") % WIDTH).alias("pos")), "kept-terms")
    held = counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"])

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    own = held.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    by_lang = Window.partitionBy("lang")
    zero = F.lit(0).cast("long")
    groups = stage(
        counts.where("term is null").select("lang", "source").join(own, ["lang", "source"], "left")
        .join(langs, "lang", "left").na.fill(0, ["own", "v", "lang_total"])
        .select("lang", "source", (F.col("own") + PRIOR * F.col("v")).alias("total"),
                (F.col("lang_total") + PRIOR * F.col("v")).alias("lang_total"),
                (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("g"),
                F.ceil(F.count("*").over(by_lang) / BAND).alias("bands")), "groups")
    held = stage(held.join(groups, ["lang", "source"]), "kept-counts")

    # a block of no width per language gives every pair, also where no term is kept
    blocks = kept.groupBy("lang", "block").agg(F.min("pos").alias("low"), F.max("pos").alias("high")) \
        .select("lang", "block", "low", (F.col("high") - F.col("low") + 1).alias("width")) \
        .union(groups.select("lang", F.lit(-1).cast("long"), zero, zero).distinct())
    cell = ["lang", "block", "g", "bands"]
    marks = groups.join(blocks, "lang").select(*cell, "source", "total", "low", "width",
                                               F.lit(None).cast("long").alias("pos"), zero.alias("n"))
    cells = held.select(*cell, F.lit(None).cast("string"), zero, zero, zero, "pos", "n")
    band = F.expr(f"g div {BAND}")
    tiles = marks.union(cells).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bands") - 1))) \
        .withColumns({"i": F.least(band, "other"), "j": F.greatest(band, "other")})
    distance = tiles.groupBy("lang", "block", "i", "j").applyInArrow(_tiles(BAND), _PAIRS) \
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    excess = held.select("lang", "source", F.col("term").alias("item"),
                         (share("n", "total") - share("lang_n", "lang_total")).alias("value")) \
        .where((F.col("value") > 0) & (F.col("n") > 0))

    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")

    def part(name: str, df: DataFrame) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value",
                         F.row_number().over(ranked).alias("rank"))
    return part("pair", distance).union(part("term", excess).where(F.col("rank") <= top))
