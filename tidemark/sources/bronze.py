"""Bronze inputs of the milestone job.

A ``Bronze`` maps source name -> DataFrame with the columns of its contract
(``contracts``).  In production the frames come from catalog tables
(``from_tables``); in tests and benchmarks from the source views derived from the
TPC-H-style tables (``from_fixtures``).  Nothing is read until an action runs, and each query
scans only the columns it uses.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import upper_columns
from . import fixtures
from .contracts import CONTRACTS, as_delivered, bind

# Source name -> columns the job reads.
SOURCES: dict[str, tuple[str, ...]] = {n: tuple(f.name for f in fields) for n, fields in CONTRACTS.items()}


class Bronze(dict):
    """Source name -> DataFrame; attribute access for convenience."""

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self[name]
        except KeyError as e:  # pragma: no cover
            raise AttributeError(name) from e


def from_frames(frames: Mapping[str, DataFrame], columns: Mapping[str, Mapping[str, str]] | None = None) -> Bronze:
    """Frames under their delivered names, bound to the contracts.

    All faults of all sources are raised together, before any scan; ``columns``
    names delivered columns the contracts do not know."""
    return Bronze(bind(frames, columns))


def from_tables(spark: SparkSession, names: Mapping[str, str],
                columns: Mapping[str, Mapping[str, str]] | None = None) -> Bronze:
    """Catalog tables, e.g. ``{"asn": "warehouse.bronze_asn", ...}``, bound to the contracts."""
    return from_frames({k: spark.table(v) for k, v in names.items()}, columns)


def from_fixtures(spark: SparkSession, sf_dir: str, by_order: bool = False) -> Bronze:
    """Source views over the test tables in ``sf_dir``, delivered as real sources are
    (``by_order``: see ``fixtures.register_raw``)."""
    frames = fixtures.register_views(spark, sf_dir, by_order)
    return from_frames({k: as_delivered(k, v) for k, v in frames.items()})


def table(spark: SparkSession, name: str) -> DataFrame:
    """Scan one table or registered view."""
    return upper_columns(spark.table(name))
