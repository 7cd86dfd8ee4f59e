"""Spark session and shared-folder helpers."""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on.  Timestamps of the sources
# are zone-less (timestamp_ntz); a UTC session keeps any zoned value equal
# to its wall-clock text.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The milestone stage fuses a broadcast join, seven rule projections, a
    # generator and an aggregate into one generated method; above 8000 bytes
    # of bytecode the JVM does not JIT-compile a method and it runs
    # interpreted.  At this limit Spark splits such stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package settings.

    On a cluster leave ``master`` unset and let the launcher decide; pass
    ``shuffle_partitions`` sized so one partition fits an executor core
    (about 128-256 MB of shuffle data per partition).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(JOB_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if master and master.startswith("local"):
        # Local mode runs everything in the driver JVM; the 1g default
        # starves the shuffle and aggregation buffers.
        conf["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors, as named by ``spark.checkpoint.dir``.

    Only checkpoints and scratch tables go here.  Where the session names no
    such folder a local master gets a fresh scratch folder (tests); on a
    cluster that would be a different disk on each machine, so it is an error.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder; callers pick unique leaf names."""
    return "/".join([shared_dir(spark), "tidemark", *parts])


#: Of scratch tables, which are written once and read a few times.
_CODEC = "zstd"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage with
    files every executor can read, and is computed once for several readers."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", _CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """``staged`` in buckets of ``key``, as many as there are shuffle partitions: a
    group-by or join on ``key`` reads them without an exchange.

    For frames that are partitioned by ``key`` already; of others every task would
    write a file per bucket.  The table's definition goes at once, its files stay.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    table, n = f"tidemark_staged_{mark}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("compression", _CODEC).bucketBy(n, key).option("path", scratch_path(spark, f"{name}-{mark}")).saveAsTable(table)
    out = spark.table(table)
    out.schema  # bound to the files before the definition goes
    spark.sql(f"DROP TABLE {table}")
    return out
