"""Operator 6: exact dedup by content sort, in DataFrame operations only.

Method: sampled splitters range-partition the normalised text, the sort within
the partitions puts equals next to each other, neighbours are compared in
full, and the smallest doc_id of each run of equals stays.

``repartitionByRange`` samples the splitters; the window over (head of the
text, hash, salt, text) keeps that partitioning, sorts externally and compares
neighbouring keys in full.  A text with a large share of the rows would fill one range, so such
texts (at most ``HOT_SLOTS`` by their definition, found by a digest count) are
salted: their rows go to several ranges and the runs are added up afterwards.

Defined cases: NULL text is empty text; the empty texts are equal to each
other; rows without a doc_id rank last; rows that repeat are copies of each
other; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import one_space, stage

#: Texts with more than 1/256 of all rows are hot, so fewer than 256 are.
HOT_SLOTS = 256
SALTS = 64


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    norm = docs.select("doc_id", one_space(F.col("text").cast("string")).alias("norm"))
    counts = stage(norm.groupBy(F.xxhash64("norm").alias("h")).agg(F.count("*").alias("n")).where("n > 16"), "counts")
    total = docs.count()
    hot = counts.where(F.col("n") * HOT_SLOTS > total).select("h").withColumn("hot", F.lit(True))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(0)
    # fewer than HOT_SLOTS rows by definition, so they are sent to all tasks
    salted = norm.withColumn("h", F.xxhash64("norm")).join(F.broadcast(hot), "h", "left").withColumn("salt", salt)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Splitters are collected by the driver, so they hold the head of a text and
    # its hash only; the window still compares the whole text.
    place = ["head", "h", "salt"]
    run = Window.partitionBy(*place, "norm")
    ranked = salted.withColumn("head", F.substring("norm", 1, 32)).repartitionByRange(parts, *place).select(
        "doc_id", "hot", F.min("doc_id").over(run).alias("first_id"), F.count("*").over(run).alias("n"),
        F.row_number().over(run.orderBy(F.col("doc_id").asc_nulls_last())).alias("place"),
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"))
    ranked = stage(ranked, "sorted")
    # runs of a hot text, one per salt
    runs = ranked.where("hot and place = 1").groupBy("text_sha256").agg(
        F.min("first_id").alias("all_first"), F.sum("n").alias("all_n"))
    out = ranked.join(F.broadcast(runs), "text_sha256", "left")
    keep = F.coalesce("all_first", "first_id")
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("all_n", "n").alias("group_size"),
                      ((F.col("place") == 1) & F.col("doc_id").eqNullSafe(keep)).alias("kept"), "text_sha256")
