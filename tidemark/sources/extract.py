"""Source extracts: full (S2), full in key ranges, and incremental (S3).

``fmt="sql"`` runs the configured query on this session's catalog (tables
or views already registered); any other format is a Spark data source
(e.g. a warehouse connector or ``jdbc``) that receives the query text in
its ``query`` option, so the source does the filtering.
"""
from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..streaming.incremental import bound_query, render_query

#: Accuracy of the quantiles that cut a column into ranges.
ACCURACY = 10_000


def extract_full(spark: SparkSession, query: str, fmt: str = "sql",
                 options: dict | None = None) -> DataFrame:
    """Run the configured extract query."""
    if fmt == "sql":
        return spark.sql(query)
    return spark.read.format(fmt).options(**(options or {})).option("query", query).load()


def cut_points(df: DataFrame, column: str, ranges: int) -> list:
    """At most ``ranges - 1`` ascending values that cut ``column`` (a number, date or
    time) into ranges of about equal row counts; a value with more than a range's
    share of the rows is one cut only."""
    if ranges < 2:
        return []
    shares = [k / ranges for k in range(1, ranges)]
    cuts = df.agg(F.percentile_approx(column, shares, ACCURACY).alias("q")).first()["q"]
    return sorted({c for c in cuts or () if c == c})  # NaN is greater than any cut


def _literal(value) -> str:
    """A cut point as SQL text that sources and Spark read alike."""
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, dt.date):
        return f"DATE '{value}'"
    if isinstance(value, (int, float, decimal.Decimal)) and not isinstance(value, bool):
        return repr(value) if isinstance(value, float) else str(value)
    raise ValueError(f"no range over {type(value).__name__} values")


def range_predicates(column: str, cuts: Sequence) -> list[str]:
    """Conditions of which every row meets exactly one: below the first cut, from
    each cut up to the next, from the last on, and no value at all."""
    if any(a >= b for a, b in zip(cuts, cuts[1:])):
        raise ValueError("cut points must ascend")
    marks = [_literal(c) for c in cuts]
    if not marks:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    return [f"{column} < {marks[0]}", *(f"{column} >= {a} AND {column} < {b}" for a, b in zip(marks, marks[1:])),
            f"{column} >= {marks[-1]}", f"{column} IS NULL"]


def range_queries(query: str, column: str, cuts: Sequence) -> list[str]:
    """The configured query once per range, as a subquery the source can filter in."""
    body = query.strip().rstrip(";")
    return [f"SELECT * FROM (\n{body}\n) extract_ranges WHERE {p}" for p in range_predicates(column, cuts)]


def extract_in_ranges(spark: SparkSession, query: str, column: str, ranges: int = 16, cuts: Sequence | None = None,
                      fmt: str = "sql", options: dict | None = None, properties: dict | None = None) -> DataFrame:
    """The rows of ``query``, read by several tasks instead of one.

    ``column`` is a column of the result (a number, date or time).  Its cut points
    are quantiles, one aggregate that the source's own scan answers for ``sql``; for
    a remote source ``cuts`` saves that pass over the connection.  NULLs have a
    range of their own.  ``jdbc`` gets one partition per predicate over a subquery,
    other formats one load per range.
    """
    options = dict(options or {})
    if cuts is None:
        cuts = cut_points(extract_full(spark, query, fmt, options), column, ranges)
    if fmt == "jdbc":
        body = query.strip().rstrip(";")
        return spark.read.options(**{k: v for k, v in options.items() if k != "url"}).jdbc(
            options["url"], f"(\n{body}\n) extract_ranges", predicates=range_predicates(column, cuts), properties=properties or {})
    return reduce(DataFrame.unionAll, [extract_full(spark, q, fmt, options) for q in range_queries(query, column, cuts)])


def extract_incremental(spark: SparkSession, template: str, column: str,
                        start: dt.datetime, job_start: dt.datetime, fmt: str = "sql",
                        options: dict | None = None) -> tuple[DataFrame, str]:
    """Rows with ``start < column <= job_start`` (S3).

    Returns the DataFrame and the query text as run (for the log).  On this
    session's catalog the bounds are bound parameters (no text pasting);
    a remote source gets the filled-in text.
    """
    if fmt == "sql":
        text, args = bound_query(template, column, start, job_start)
        return spark.sql(text, args=args), render_query(template, column, start, job_start)
    text = render_query(template, column, start, job_start)
    return extract_full(spark, text, fmt, options), text
