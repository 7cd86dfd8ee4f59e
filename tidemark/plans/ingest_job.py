"""Config-driven ingest of all active sources into bronze tables.

Every active control row is a unit of its own: extract (full or incremental),
stamp with the job start, write ``bronze_<source>``, count, compact, and append one
run-log row, also when it fails.  A failing source does not keep the others from
loading; the run ends with ``IngestFailed`` after all have had their turn.  Running
the same batch id again takes up only the sources without a finished row.

The control rows are a small config table and are read on the driver; every other
step is a Spark job.  Up to ``parallel`` sources load at once.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..functions.runinfo import RunInfo, central_now
from ..sources.control import active_sources, resolve_options
from ..sources.extract import extract_full, extract_incremental
from ..sources.merging import read_merged, upsert
from ..sources.sinks import append_run_log, compact_table, replace_table, table_count, with_audit_ts


class IngestFailed(RuntimeError):
    """Some sources did not load; ``errors`` has the reason of each."""

    def __init__(self, errors: dict[str, str]):
        self.errors = errors
        super().__init__("; ".join(f"{s}: {e}" for s, e in sorted(errors.items())))


def _loaded(spark: SparkSession, log_table: str, batch_id: str) -> set[str]:
    """Sources with a finished row in this batch."""
    if not spark.catalog.tableExists(log_table):
        return set()
    rows = spark.table(log_table).where((F.col("batchId") == batch_id) & F.col("sourceCount").isNotNull())
    return {r["sourceName"] for r in rows.select("sourceName").distinct().collect()}


def ingest_all(spark: SparkSession, control: DataFrame, run: RunInfo, log_table: str,
               fmt: str = "sql", read_config: dict | None = None, table_prefix: str = "bronze_",
               target_bytes: int = 128 * 1024 * 1024, table_format: str = "parquet",
               table_root: str | None = None, upsert_keys: Mapping[str, Sequence[str]] | None = None,
               parallel: int = 1) -> DataFrame:
    """Load every active source that this batch has not loaded; returns the batch's
    log rows of loaded sources.

    ``fmt`` is the format of the extracts, ``table_format`` and ``table_root``
    are those of the tables.  An incremental extract replaces the bronze table
    by its increment, as the original job does, unless ``upsert_keys`` names the
    source's keys: then the table keeps the latest row per key by the incremental
    column.
    """
    upsert_keys = upsert_keys or {}

    def load(row: Row) -> tuple:
        start, query = central_now(), row["sourceQuery"]
        try:
            options = resolve_options(read_config or {}, row["schema"] or "")
            source, column = row["sourceName"], row["incrementalColumn"]
            name = f"{table_prefix}{source}"
            if row["extractionMode"] == "incremental":
                df, query = extract_incremental(spark, row["sourceQuery"], column, row["incrementalStartTime"],
                                                run.job_start, fmt, options)
            else:
                df = extract_full(spark, query, fmt, options)
            df = with_audit_ts(df, run.job_start)
            if row["extractionMode"] == "incremental" and source in upsert_keys:
                upsert(spark, df, name, upsert_keys[source], [column], run.batch_id, row["incrementalStartTime"],
                       fmt=table_format, root=table_root)
                count = read_merged(spark, name).count()
            else:
                replace_table(spark, df, name, table_format, table_root)
                count = table_count(spark, name)
                compact_table(spark, name, target_bytes, table_format, table_root)
            return run.batch_id, source, start, central_now(), count, query, None
        except Exception as e:  # noqa: BLE001 - one source's failure is a log row
            return run.batch_id, row["sourceName"], start, central_now(), None, query, f"{type(e).__name__}: {e}"[:2000]

    done = _loaded(spark, log_table, run.batch_id)
    rows = [r for r in active_sources(control).collect() if r["sourceName"] not in done]
    errors = {}
    with ThreadPoolExecutor(max(parallel, 1)) as pool:
        units = [pool.submit(inheritable_thread_target(spark)(load), r) for r in rows]
        for unit in as_completed(units):  # one writer of the log
            entry = unit.result()
            append_run_log(spark, [entry], log_table, table_format, table_root)
            if entry[-1] is not None:
                errors[entry[1]] = entry[-1]
    if errors:
        raise IngestFailed(errors)
    return spark.table(log_table).where((F.col("batchId") == F.lit(run.batch_id)) & F.col("sourceCount").isNotNull())
