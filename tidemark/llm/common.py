"""Helpers shared by the operators: scratch tables, word splitting, hashing."""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path

# Words are maximal runs of characters outside the six ASCII space characters.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

# Text handled at once inside a Python task; bounds its memory whatever the
# batch holds (a single longer text is handled alone).
CHUNK_BYTES = 6 << 20

#: Column with the number of a row.
ROW = "__row"


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs no more than its own unfinished tasks, and fixes values that a
    second evaluation could change (partition numbers, ties).
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` with a number per row in ``ROW`` that ascends with doc_id, rows
    without one last; and whether that number is the doc_id itself.

    doc_ids that are all there and all different serve as they are.  Otherwise
    rows are numbered from 0 in order of (doc_id, hash of text), so a second call
    numbers them alike up to rows that repeat whole.  The range shuffle spreads
    rows of one doc_id, or without one, by that hash and by their place.
    """
    spark, doc_id = docs.sparkSession, F.col("doc_id")
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        n = docs.groupBy(doc_id.cast("long").alias("id")).agg(F.count("*").alias("n"))
        if n.where(f"id is null or n > 1 or id = {(1 << 63) - 1}").isEmpty():
            return docs.withColumn(ROW, doc_id.cast("long")), True
    order = [doc_id.asc_nulls_last(), F.col("__hash"), F.col("__place")]
    placed = docs.withColumn("__hash", F.xxhash64(F.col("text").cast("string"))) \
        .withColumn("__place", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stage(placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("__hash", "__place")
                 .withColumn(ROW, F.monotonically_increasing_id()), "rows")
    # numbers of a partition start at its index << 33; a count per partition closes the gaps
    part = F.shiftright(ROW, 33)
    first, at = [], 0
    for r in rows.groupBy(part.alias("part")).count().orderBy("part").collect():
        first.append((r.part, at - (r.part << 33)))
        at += r["count"]
    first = spark.createDataFrame(first, "__part long, __first long")
    return rows.withColumn("__part", part).join(F.broadcast(first), "__part") \
        .withColumn(ROW, F.col(ROW) + F.col("__first")).select(*docs.columns, ROW), False


def with_ids(df: DataFrame, column: str, rows: DataFrame, own: bool) -> DataFrame:
    """``df`` with the doc_id of each row number in ``column``, from ``keyed``."""
    if own:
        return df
    ids = rows.select(F.col(ROW).alias(column), F.col("doc_id").cast("long").alias("__id"))
    return df.join(ids, column, "left").withColumn(column, F.col("__id")).drop("__id")


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def one_space(text: Column) -> Column:
    """Each run of ASCII space characters as one space; NULL as empty.

    Runs that are a single space already are not matched, which spares the
    matcher nearly all replacements.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")),
                            rf"[\x09-\x0D][{SPACE}]*|\x20[{SPACE}]+", " ")


def text_chunks(batches: Iterator[pa.RecordBatch], column: str,
                max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts add up to at most ``max_bytes``
    (or hold one longer text)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text: (offsets, code per word, 64-bit hash per code).

    Works on Arrow kernels and a dictionary of the chunk's distinct words,
    so that Python touches each distinct word once.
    """
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    words = encoded.dictionary.cast(pa.binary())
    # as objects in one step: ``to_pylist`` takes a microsecond or two a word
    known = words.to_numpy(zero_copy_only=False)
    if (blank := pc.index(words, b"").as_py()) >= 0:  # a text without words splits into one empty word
        empty = codes == blank
        offsets = offsets - np.concatenate([[0], np.cumsum(empty)])[offsets]
        codes = codes[~empty]
    return offsets, codes, np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer on 64-bit values (a bijection).

    Fixed values: shifts and multipliers of the public splitmix64 finaliser.
    """
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)
