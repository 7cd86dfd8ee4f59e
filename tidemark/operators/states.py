"""Aggregates as mergeable states.

A rollup keeps one state row per key.  The state of an increment is computed from
its rows alone and merged with the stored state, so earlier rows are not read
again:

    finish(merge(partial(base), partial(increment))) == finish(partial(base + increment))

``max``, ``min``
    the value itself
``sum``, ``count``
    the running total; a sum over nothing but NULL stays NULL
``max_if_complete``
    the greatest value, the rows and the rows that have one: two counters tell
    whether any was missing, now or in an earlier increment

Rows can be added, not taken back.  NULL is a key value like any other, as in GROUP
BY.  Merging is a union and a ``groupBy``, combined map-side.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("max", "min", "sum", "count", "max_if_complete")


@dataclass(frozen=True)
class Agg:
    """Output column ``name``: ``kind`` of the SQL expression ``value``."""
    name: str
    kind: str
    value: str

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"no mergeable aggregate: {self.kind}")

    @property
    def column(self) -> Column:
        return F.expr(self.value)

    @property
    def parts(self) -> tuple[str, ...]:
        """State columns."""
        more = ("__rows", "__known") if self.kind == "max_if_complete" else ()
        return (self.name, *(self.name + m for m in more))

    def start(self) -> list[Column]:
        """State of a group of input rows."""
        v = self.column
        first = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count, "max_if_complete": F.max}[self.kind](v)
        more = [F.count(F.lit(1)), F.count(v)] if self.kind == "max_if_complete" else []
        return [c.alias(n) for c, n in zip([first, *more], self.parts)]

    def combine(self) -> list[Column]:
        """State of a group of state rows."""
        first = {"min": F.min, "sum": F.sum, "count": F.sum}.get(self.kind, F.max)
        return [f(F.col(n)).alias(n) for f, n in zip([first, F.sum, F.sum], self.parts)]

    def result(self) -> Column:
        if self.kind != "max_if_complete":
            return F.col(self.name)
        rows, known = self.parts[1:]
        return F.when(F.col(rows) == F.col(known), F.col(self.name)).alias(self.name)


def partial(df: DataFrame, keys: Sequence[str], aggs: Sequence[Agg]) -> DataFrame:
    """The state of the rows of ``df``: keys and state columns."""
    return df.groupBy(*keys).agg(*[c for a in aggs for c in a.start()])


def merge(states: Sequence[DataFrame], keys: Sequence[str], aggs: Sequence[Agg], by: str | None = None) -> DataFrame:
    """One state of several; their column types are those of the first.

    With ``by``, one of the keys, rows are exchanged by that column alone and the
    result stays so; a key has one row per state, so none is heavy."""
    both = reduce(lambda a, b: a.unionByName(b), states)
    if by:
        both = both.repartition(by)
    types = states[0].schema
    merged = both.groupBy(*keys).agg(*[c for a in aggs for c in a.combine()])
    # a sum of sums is declared wider than the sum it continues
    return merged.select(*[F.col(c).cast(types[c].dataType).alias(c) for c in [*keys, *(p for a in aggs for p in a.parts)]])


def finish(state: DataFrame, keys: Sequence[str], aggs: Sequence[Agg]) -> DataFrame:
    """The rollup a state stands for."""
    return state.select(*keys, *[a.result() for a in aggs])


def rollup(df: DataFrame, keys: Sequence[str], aggs: Sequence[Agg]) -> DataFrame:
    """The rollup computed from all rows at once."""
    return finish(partial(df, keys, aggs), keys, aggs)
