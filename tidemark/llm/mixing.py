"""Operator 1: mixing sources to target weights.

Method: Sainte-Lague apportionment.  Each source gets a target in words; the
mix is cut into blocks of equal tokens, dealt to the sources by highest
quotients, then in the same way to the shards of each source, so that every
shard has an integer quota; a shard takes its quota by a seeded selection of
its blocks.

Documents of a source are dealt to shards by hash and ordered in a shard by
seeded hash; the shard is the line of their words, cut every ``block`` words
(the last block may be shorter).  A quota of ``q`` out of ``n`` blocks takes
the line ``q // n`` times whole and ``q % n`` blocks once more, evenly spaced
from a seeded start.  Which words of a document are taken follows from its
place in the line, so no block is ever listed.

Targets: weights 3, 1, 2, repeating over the sources in code point order (NULL
last); the mix is ``share`` percent of all words; a target stops at ``most``
times its source's words and the excess goes to the others by weight.

Defined cases: NULL or empty text has size 0 and takes 0; NULL source is a
source; rows that repeat a doc_id are separate rows; no rows, no result;
columns other than doc_id, text and source are ignored.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import ROW, stage, word_count

#: Weights of the sources in turn.
WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 1024
SHARD_WORDS = 4_000_000


def targets(sizes: DataFrame, share: int = 150, most: int = 2, weights: tuple = WEIGHTS) -> DataFrame:
    """One row per source: source, source_size, n_docs, weight, target.

    ``sizes`` has source and size.  The windows run over the sources table (a
    row per source of the mix), not over documents.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    src = stage(src.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
                               .cast("double")), "sources")
    # Fill up: sources reach their cap in the order of cap / weight.
    total = F.sum("source_size").over(Window.partitionBy()) * (share / 100)
    cap = F.col("source_size") * float(most)
    order = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    level = left / F.sum("weight").over(after)  # words per weight if this source were the first below its cap
    src = src.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") < cap)
    # past the first source below its cap the level only falls
    final = F.max(F.when(F.col("free"), F.col("level"))).over(Window.partitionBy())
    return src.withColumn("target", F.coalesce(F.least(cap, final * F.col("weight")), cap)) \
        .withColumn("full", F.col("target") >= cap).drop("level", "free")


def apportion(cells: DataFrame, group: list[str], order: list[str], weight: str, seats: Column, limit: str) -> DataFrame:
    """Column ``quota``: ``seats`` (of each group) dealt by the highest quotients
    weight / (2 * quota + 1), never above ``limit``.

    Starts at each exact share rounded to the nearest; the few seats that are
    then missing or too many go by quotient.  The candidates for them number
    at most about twice the cells.
    """
    w = Window.partitionBy(*group)
    cells = cells.withColumn("seats", seats).withColumn("exact", F.coalesce(F.try_divide(
        F.col("seats") * F.col(weight).cast("double"), F.sum(F.col(weight).cast("double")).over(w)), F.lit(0.0)))
    cells = cells.withColumn("start", F.least(F.floor(F.col("exact") + 0.5), F.col(limit)))
    cells = stage(cells.withColumn("short", F.col("seats") - F.sum("start").over(w)), "shares")
    spread = F.ceil(F.coalesce(F.try_divide(F.abs("short") * F.col("exact"), F.col("seats")), F.lit(0.0))) + 2
    up = F.when(F.col("short") > 0, F.least(spread, F.col(limit) - F.col("start")))
    down = F.when(F.col("short") < 0, F.least(spread, F.col("start")))
    steps = F.coalesce(up, down, F.lit(0)).cast("int")
    each = cells.where(steps > 0).withColumn("k", F.explode(F.sequence(F.lit(1), steps)))
    quotient = F.col(weight) / (2 * F.when(F.col("short") > 0, F.col("start") + F.col("k") - 1)
                                .otherwise(F.col("start") - F.col("k")) + 1)
    best = Window.partitionBy(*group).orderBy(
        F.when(F.col("short") > 0, -quotient).otherwise(quotient), *order, "k")
    changed = each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= F.abs("short")) \
        .groupBy(*group, *order).agg(F.sum(F.signum("short")).cast("long").alias("change"))
    return cells.join(changed, [*group, *order], "left") \
        .withColumn("quota", F.col("start") + F.coalesce("change", F.lit(0))) \
        .drop("exact", "short", "seats", "start", "change")


def plan(sizes: DataFrame, share: int = 150, most: int = 2, seed: int = 17, block: int = BLOCK_WORDS,
         shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, int]:
    """(sources, shards, block): targets and integer quotas.

    ``sizes`` has a number per row (``ROW``), id, source, size.  The block is at most ``block`` words, and
    small enough that the mix holds some hundred blocks per source.
    """
    src = stage(targets(sizes, share, most), "targets")
    n, total = src.agg(F.count("*"), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    block = int(min(block, max(1, total // (400 * max(n, 1)))))
    src = src.withColumn("s", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())) \
        .withColumn("shards", F.ceil(F.col("source_size") / shard_words).cast("long")) \
        .withColumn("blocks", F.ceil(F.col("source_size") / block))
    # a source at its cap takes everything `most` times; the others share the rest
    free = F.when(F.col("full"), 0).otherwise(F.col("target"))
    given = apportion(src.withColumn("free", free).withColumn("limit", F.col("blocks") * most).withColumn("all", F.lit(1)),
                      ["all"], ["s"], "free",
                      F.round(F.sum(free).over(Window.partitionBy()) / block).cast("long"), "limit")
    src = stage(given.withColumn("source_quota", F.when(F.col("full"), F.col("limit")).otherwise(F.col("quota")))
                .drop("quota", "free", "limit", "all"), "quotas")
    placed = place(sizes, src, seed)
    cells = placed.groupBy("s", "shard").agg(F.sum("size").alias("words"), F.first("source_quota").alias("source_quota")) \
        .withColumn("n_blocks", F.ceil(F.col("words") / block)).withColumn("limit", F.col("n_blocks") * most)
    # a shard's blocks are rounded up, so the cap of a full source is raised to the shards' own
    cells = stage(cells, "cells").join(src.select("s", "full"), "s")
    w = Window.partitionBy("s")
    quotas = apportion(cells, ["s"], ["shard"], "n_blocks",
                       F.when(F.col("full"), F.sum("limit").over(w)).otherwise(F.least("source_quota", F.sum("limit").over(w))),
                       "limit")
    return src, stage(quotas.select("s", "shard", "n_blocks", "quota"), "shard-quotas"), block


def place(sizes: DataFrame, src: DataFrame, seed: int) -> DataFrame:
    """Sizes with their source's columns and their shard."""
    s = F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())
    return sizes.withColumn("s", s).join(src.drop("source"), "s") \
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "id", "size"), F.greatest("shards", F.lit(1))))


def mix_sizes(sizes: DataFrame, share: int = 150, most: int = 2, seed: int = 17, block: int = BLOCK_WORDS,
              shard_words: int = SHARD_WORDS) -> DataFrame:
    """Sizes with source_size, target, taken, whole (times the document is taken
    whole) and at, shard columns from which ``taken_spans`` finds the rest."""
    src, shards, block = plan(sizes, share, most, seed, block, shard_words)
    line = Window.partitionBy("s", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "id", "size"), "id", "size", ROW)
    at = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    d = place(sizes, src, seed).withColumn("at", at).join(shards, ["s", "shard"])
    n, q = F.greatest("n_blocks", F.lit(1)), F.col("quota")
    d = d.withColumn("whole", F.floor(q / n)).withColumn("extra", q - F.col("whole") * n).withColumn("n_blocks", n) \
        .withColumn("start", F.pmod(F.xxhash64(F.lit(seed + 2), "s", "shard"), n)).withColumn("block", F.lit(block).cast("long"))

    def picked(b: Column) -> Column:  # picked among the first b blocks of the shard
        return F.floor((b * F.col("extra") + F.col("start")).cast("decimal(38,0)") / F.col("n_blocks")).cast("long")

    def words(x: Column) -> Column:  # picked words among the first x of the shard
        b = F.floor(x / F.lit(block))
        return picked(b) * block + (x - b * block) * (picked(b + 1) - picked(b))

    more = words(F.col("at") + F.col("size")) - words(F.col("at"))
    return d.withColumn("taken", (F.col("whole") * F.col("size") + more).cast("long"))


def sizes_of(docs: DataFrame) -> DataFrame:
    """Sizes of the rows of ``docs``, numbered by ``ROW`` where they aren't yet."""
    row = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id().alias(ROW)
    return stage(docs.select(row, F.col("doc_id").alias("id"), F.col("source"), word_count(F.col("text")).alias("size")), "sizes")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target, taken."""
    return mix_sizes(sizes_of(docs), **options).select(
        F.col("id").alias("doc_id"), F.col("source"), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: documents taken whole, once per time, and the taken parts
    of documents taken in part, with the columns of ``docs``.

    The rows are numbered in scratch and meet their plan by that number alone, so
    rows that repeat, or lack a doc_id, take their own quota.
    """
    names = docs.columns
    rows = stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    d = mix_sizes(sizes_of(rows), **options).select(
        ROW, F.col("size").alias("words"), "at", "whole", "extra", "start", "n_blocks", "block", "taken")
    rows = rows.select(F.struct(*names).alias("row"), ROW).join(d, ROW)
    part = F.col("taken") - F.col("whole") * F.col("words")
    times = F.col("whole") + F.when((part > 0) & (part == F.col("words")), 1).otherwise(0)
    whole = rows.where(times > 0).withColumn("n", F.explode(F.sequence(F.lit(1), times.cast("int")))).select("row.*")
    cut = rows.where((part > 0) & (part < F.col("words"))) \
        .withColumn("text", taken_text("row.text", "at", "words", "extra", "start", "n_blocks", "block"))
    cut = cut.select(*[F.col("text") if c == "text" else F.char_length("text").cast(docs.schema[c].dataType).alias(c)
                       if c == "n_chars" else F.col(f"row.`{c}`") for c in names])
    return whole.unionByName(cut)


@F.pandas_udf(T.StringType())
def taken_text(text: pd.Series, at: pd.Series, words: pd.Series, extra: pd.Series, start: pd.Series,
               n_blocks: pd.Series, block: pd.Series) -> pd.Series:
    """The words of each text that lie in its shard's picked blocks; what lies
    between two words of one stretch stays as it was."""
    import re
    out = []
    for t, a, size, k, u, n, width in zip(text, at, words, extra, start, n_blocks, block, strict=True):
        blocks = np.arange(a // width, (a + size - 1) // width + 1, dtype=object)
        on = [int((b + 1) * k + u) // n - int(b * k + u) // n > 0 for b in blocks]
        spans, parts, i = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)], [], 0
        while i < len(on):
            j = i
            while j < len(on) and on[j]:
                j += 1
            if j > i:
                lo, hi = max(0, int(blocks[i]) * width - a), min(size, (int(blocks[j - 1]) + 1) * width - a)
                parts.append(t[spans[lo][0]:spans[hi - 1][1]])
            i = j + 1
        out.append("\n".join(parts))
    return pd.Series(out, dtype=object)
