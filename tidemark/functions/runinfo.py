"""Run clock (S12, S14): job start in US Central time and the batch id."""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import SparkSession, functions as F

from .dates import central_time

CENTRAL = "America/Chicago"  # what the zone id 'CST' resolves to in Spark


@dataclass(frozen=True)
class RunInfo:
    job_start: dt.datetime   # US Central wall clock, no zone
    batch_id: str            # yyyyMMddHHmmss of job_start
    job_start_iso: str       # ISO text handed to later steps
    environment: str = ""


def run_info(spark: SparkSession, now: dt.datetime | None = None, environment: str = "") -> RunInfo:
    """Job start = ``now`` (UTC, default the current time) in US Central.

    One one-row query; the value is cast to a zone-less timestamp before it
    reaches Python so the wall clock does not depend on the driver's zone.
    """
    # from text, so that the driver's zone does not matter
    utc = F.lit(str(now)).cast("timestamp_ntz").cast("timestamp") if now is not None else F.current_timestamp()
    start = spark.range(1).select(central_time(utc).cast("timestamp_ntz").alias("t")).first()["t"]
    return RunInfo(start, start.strftime("%Y%m%d%H%M%S"), start.isoformat(), environment)


def central_now() -> dt.datetime:
    """Current US Central wall clock on the driver (for log start/end)."""
    from zoneinfo import ZoneInfo
    return dt.datetime.now(ZoneInfo(CENTRAL)).replace(tzinfo=None, microsecond=0)
