"""Operator 3: sharding by jump consistent hashing.

Method: a jump consistent hash maps the stable key doc_id to a shard without
a ring table; with one more shard, rows only move into the new one.

Slots (the row's place in its shard, gapless) need no task that holds a shard:
each input split counts on its own, and the splits' counts are added up in
front of it.

Defined cases: NULL text has size 16 and the checksum of the empty text; rows
without a doc_id share one key; rows that repeat a doc_id get the same shard
and slots of their own; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import mix, stage

SHARDS = 40
#: Fixed value: multiplier of the published generator of the jump hash.
JUMP = 2862933555777941757


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, for all keys at once."""
    key = keys.astype(np.uint64, copy=True)
    shard, ahead = np.zeros(len(key), np.int64), np.zeros(len(key), np.float64)
    going = np.ones(len(key), bool)
    while going.any():
        shard[going] = ahead[going].astype(np.int64)
        key[going] = key[going] * np.uint64(JUMP) + np.uint64(1)
        ahead[going] = np.floor((shard[going] + 1) * (2.0**31 / ((key[going] >> np.uint64(33)).astype(np.float64) + 1)))
        going &= ahead < shards
    return shard


def shard_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document row: doc_id, size, text_crc32, law, shard, slot,
    grown_shard."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 16).alias("size"), F.crc32(text).alias("text_crc32"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, filled = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            key = mix(b.column("doc_id").fill_null(-1).to_numpy().astype(np.int64).view(np.uint64))
            shard, grown = jump_hash(key, shards), jump_hash(key, shards + 1)
            order = np.argsort(shard, kind="stable")
            count = np.bincount(shard, minlength=shards)
            rank = np.empty(len(shard), np.int64)
            rank[order] = np.arange(len(shard)) - np.repeat(np.cumsum(count) - count, count)
            place = filled[shard] + rank
            filled += count
            yield pa.record_batch([*b.columns, shard.astype(np.int32), grown.astype(np.int32), place,
                                   np.full(len(shard), part, np.int32)],
                                  ["doc_id", "size", "text_crc32", "shard", "grown_shard", "place", "part"])

    dealt = stage(rows.mapInArrow(deal, f"doc_id {id_type}, size long, text_crc32 long, shard int, grown_shard int, "
                                        "place long, part int"), "dealt")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "part").agg(F.count("*").alias("n")) \
        .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return dealt.join(offsets, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("place")).alias("slot"), "grown_shard")
