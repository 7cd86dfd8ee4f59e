"""Ingest control table (S1) and connector options."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import CONTROL_SCHEMA


def active_sources(control: DataFrame) -> DataFrame:
    """Active control rows, ordered by source name."""
    return control.where(F.col("isActive")).orderBy("sourceName")


def resolve_options(read_config: dict, schema: str) -> dict:
    """Connector options with the ``<Schema>`` placeholder filled."""
    out = dict(read_config)
    for k, v in out.items():
        if isinstance(v, str) and "<Schema>" in v:
            out[k] = v.replace("<Schema>", schema)
    return out


# The control rows used by the tests and the example ingest.
# One query text holds both single and double quotes; customer is inactive and must not be loaded.
EXAMPLE_CONTROL_ROWS = [
    (True, "orders", "tpch", "full", "SELECT * FROM orders", None, None),
    (True, "events", "web", "incremental",
     "SELECT * FROM events WHERE <IncrementalColumn> > '<IncrementalStartTime>' "
     "AND <IncrementalColumn> <= '<JobStartTime>'",
     "ts", dt.datetime(2024, 1, 10)),
    (True, "lineitem", "tpch", "full",
     "SELECT * FROM lineitem WHERE l_returnflag <> 'none' OR l_linestatus = \"none\"", None, None),
    (False, "customer", "tpch", "full", "SELECT * FROM customer", None, None),
]


def example_control(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXAMPLE_CONTROL_ROWS, CONTROL_SCHEMA)
