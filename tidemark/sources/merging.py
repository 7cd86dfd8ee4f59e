"""Tables that increments are merged into, a few buckets at a time (S3, Q2).

A merged table is partitioned by ``key_bucket``, a hash of its key columns.  An
increment rewrites the buckets that hold its keys and reads no others.  What
becomes of a key's old and new rows is up to ``combine``: ``upsert`` keeps the
latest row, ``accumulate`` merges aggregate states.

Buckets are replaced one by one when the write commits, so a run that dies then
leaves some of them new.  Every bucket therefore carries the batch it was last
merged with: running the same batch again takes up the buckets still missing and
leaves the others alone, which makes a rerun safe for sums too.  Batch ids must
ascend as text (``yyyyMMddHHmmss``).

A ``clustered`` table is bucketed by its keys as well, within the ``key_bucket``
folders, and ``key_bucket`` follows from the hash that Spark's exchanges use: rows
that an exchange by the keys has placed are written where they are, in a few files a
task, and old rows are joined on the keys without an exchange.
"""
from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import states
from ..session import staged
from .sinks import new_location

BUCKET, BATCH = "key_bucket", "merged_batch"
#: Buckets of a new table; choose so that a bucket is a file or a few.
BUCKETS = 64

_MODE = "spark.sql.sources.partitionOverwriteMode"
_MODE_LOCK = threading.Lock()


@dataclass(frozen=True)
class Merged:
    """What a merge did: buckets rewritten, and buckets that had the batch already."""
    rewritten: tuple[int, ...]
    skipped: tuple[int, ...]
    next_start: dt.datetime | None = None


def read_merged(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a merged table, without its bookkeeping columns."""
    return spark.table(name).drop(BUCKET, BATCH)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def merge_increment(spark: SparkSession, increment: DataFrame, name: str, keys: Sequence[str], batch_id: str,
                    combine: Callable[[DataFrame, DataFrame | None], DataFrame], buckets: int = BUCKETS,
                    fmt: str = "parquet", root: str | None = None, key_rows: DataFrame | None = None,
                    clustered: bool = False, in_place: bool = False) -> Merged:
    """Merge ``increment`` into table ``name``, which is made if there is none.

    ``combine(increment, old rows or None)`` gives the new rows of the buckets.
    ``buckets`` counts for a new table; an old one keeps its number and its keys.

    ``key_rows`` are rows that hold the keys of the increment and no others, where
    they are cheaper to read than it: the buckets are found from them, and the
    increment is not computed but for the buckets still open, once, when
    ``combine`` reads it.  A result of ``combine`` that has the bucket column is
    taken to be partitioned by it.

    ``clustered`` counts for a new table, too.  With ``in_place`` the increment is
    partitioned by the keys: for a clustered table ``combine`` then gets both frames
    with the bucket column and returns it, and nothing is exchanged for the write.
    """
    exists = spark.catalog.tableExists(name)
    if exists:
        known = _properties(spark, name)
        buckets, clustered = int(known["tidemark.buckets"]), known.get("tidemark.clustered") == "true"
        if known["tidemark.keys"] != ",".join(keys):
            raise ValueError(f"{name} is keyed by {known['tidemark.keys']}, not {','.join(keys)}")
        extra = set(increment.columns) ^ set(read_merged(spark, name).columns)
        if extra:
            raise ValueError(f"columns of {name} differ: {sorted(extra)}")

    def placed(df: DataFrame) -> DataFrame:
        df = df.withColumn(BATCH, F.lit(batch_id))
        return df if BUCKET in df.columns else df.withColumn(BUCKET, bucket).repartition(BUCKET)
    bucket = F.pmod((F.hash if clustered else F.xxhash64)(*keys), F.lit(buckets)).cast("int")
    hidden = () if clustered and in_place else (BUCKET,)
    increment = increment.withColumn(BUCKET, bucket)
    if key_rows is None:
        increment = staged(increment, "increment")

    def buckets_of(df: DataFrame) -> list[int]:
        return sorted(r[0] for r in df.select(BUCKET).distinct().collect())

    if not exists:
        touched = buckets_of(increment) if key_rows is None else None
        write = placed(combine(increment.drop(*hidden), None)).write.format(fmt).partitionBy(BUCKET)
        if clustered:
            write = write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
        write.option("path", new_location(spark, name, root)).saveAsTable(name)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('tidemark.keys'='{','.join(keys)}', 'tidemark.buckets'='{buckets}', "
                  f"'tidemark.clustered'='{str(clustered).lower()}')")
        return Merged(tuple(buckets_of(spark.table(name)) if touched is None else touched), ())
    touched = buckets_of(increment if key_rows is None else key_rows.withColumn(BUCKET, bucket))
    table = spark.table(name)
    done = {r[0] for r in table.where(F.col(BUCKET).isin(touched)).groupBy(BUCKET).agg(F.max(BATCH).alias("b"))
            .where(F.col("b") >= batch_id).select(BUCKET).collect()} if touched else set()
    open_ = [b for b in touched if b not in done]
    if open_:
        here = F.col(BUCKET).isin(open_)
        old = table.where(here).drop(*hidden, BATCH)
        # partitions that are replaced may be read: the old files go when the write commits
        new = placed(combine(increment.where(here).drop(*hidden), old))
        with _MODE_LOCK:  # a setting of the session, which other threads share
            before = spark.conf.get(_MODE)
            spark.conf.set(_MODE, "dynamic")
            try:
                new.select(*table.columns).write.insertInto(name, overwrite=True)
            finally:
                spark.conf.set(_MODE, before)
        spark.catalog.refreshTable(name)
    return Merged(tuple(open_), tuple(sorted(done)))


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], arrival: str | None = None) -> DataFrame:
    """One row per key, the greatest by ``order_by`` (NULL is least), then by
    ``arrival``, then by a hash of the row, so that ties are settled alike every time.

    An aggregate, combined map-side: a key with very many rows is no straggler."""
    columns = [c for c in df.columns if c != arrival]
    rest = [c for c in columns if c not in keys]
    if not rest:
        return df.select(*columns).distinct()
    rank = F.struct(*[F.col(c) for c in order_by], *([F.col(arrival)] if arrival else []), F.xxhash64(*columns))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__row")).select(*keys, "__row.*").select(*columns)


def upsert(spark: SparkSession, increment: DataFrame, name: str, keys: Sequence[str], order_by: Sequence[str], batch_id: str,
           start: dt.datetime | None = None, **options) -> Merged:
    """Keep the latest row per key; of rows that tie by ``order_by`` the increment's wins.

    An older row that arrives late does not replace a newer one.  ``next_start`` of
    the result is the greatest first order value of the increment (``start`` if it
    is empty): the lower bound of the next increment.
    """
    def combine(new: DataFrame, old: DataFrame | None) -> DataFrame:
        both = new.withColumn("__new", F.lit(1))
        if old is not None:
            both = old.withColumn("__new", F.lit(0)).unionByName(both)
        return latest(both, keys, order_by, "__new")
    increment = staged(increment, "extract")
    top = increment.agg(F.max(order_by[0])).first()[0]
    done = merge_increment(spark, increment, name, keys, batch_id, combine, **options)
    return Merged(done.rewritten, done.skipped, start if top is None else top)


def accumulate(spark: SparkSession, increment: DataFrame, name: str, keys: Sequence[str], aggs: Sequence[states.Agg],
               batch_id: str, **options) -> Merged:
    """Merge the aggregate state of new rows into a table of states."""
    def combine(new: DataFrame, old: DataFrame | None) -> DataFrame:
        if old is None:
            return new
        n = int(_properties(spark, name)["tidemark.buckets"])
        both = [df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")) for df in (old, new)]
        return states.merge(both, [BUCKET, *keys], aggs, by=BUCKET)
    return merge_increment(spark, states.partial(increment, keys, aggs), name, keys, batch_id, combine,
                           key_rows=increment.select(*keys), **options)
