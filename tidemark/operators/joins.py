"""Join helpers: keyed left joins, existence flags, checked broadcasts.

Every join of the milestone job is a LEFT equi-join.  Two scale concerns are
handled here rather than at each call site:

* NULL keys on the left never match, yet a hash exchange sends all of them
  to one reducer (hash(NULL) is one value).  When a third of the rows have
  no shipment, that reducer gets a third of the data.  ``left_join`` gives
  such rows a deterministic spread key and guards the join with
  ``key IS NOT NULL``, so they scatter over all reducers and still match
  nothing.
* ``F.broadcast`` is applied only after the row count of the small side is
  checked against a bound; above it the planner's shuffle join is kept.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

_SALT = "__null_spread"


def _spread_buckets(df: DataFrame) -> int:
    try:
        return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    except Exception:  # pragma: no cover - conf always present in practice
        return 200


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _spreadable(t: T.DataType) -> bool:
    """Can a bucket number be a value of this key type?"""
    return isinstance(t, (T.IntegralType, T.StringType)) or isinstance(t, T.DecimalType) and t.precision - t.scale >= 10


def left_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
              spread_null_keys: bool = True, drop_right_keys: bool = True,
              spread_by: str | None = None) -> DataFrame:
    """LEFT JOIN ``right`` on pairs ``(left_col, right_col)`` of equal keys.

    Right key columns are dropped (they equal the left keys or are NULL)
    unless ``drop_right_keys`` is False.  Other column names must not clash.
    Key columns are matched by name, so the same frame may be joined twice.

    With ``spread_null_keys`` a NULL left key is replaced, for the join only,
    by a spread value of the same type (a hash of ``spread_by``, by default the
    first left column, modulo the shuffle partition count; other columns are not
    read for it), and ``left key IS NOT NULL`` is added to the ON
    condition.  A LEFT join cannot push that condition into its left input,
    so the replaced rows never match (whatever value they got) while their
    exchange spreads them over all reducers.  The right side keeps its own
    partitioning on the key: no extra exchange there.
    """
    tmp = {rk: f"__rk{i}" for i, (_, rk) in enumerate(on)}
    right = right.withColumnsRenamed(tmp)
    types = dict((f.name, f.dataType) for f in left.schema.fields)
    lkeys = [lk for lk, _ in on]
    spread = spread_null_keys and lkeys[0] in types and _spreadable(types[lkeys[0]])
    join_left = {lk: lk for lk in lkeys}
    if spread:
        any_null = " OR ".join(f"{_q(k)} IS NULL" for k in lkeys)
        row_hash = f"xxhash64({_q(spread_by or left.columns[0])})"
        n = _spread_buckets(left)
        first = lkeys[0]
        left = left.withColumn("__lk", F.expr(
            f"CASE WHEN {any_null} THEN CAST(pmod({row_hash}, {n}) AS {types[first].simpleString()}) "
            f"ELSE {_q(first)} END"))
        join_left[first] = "__lk"
    conds = [F.col(join_left[lk]) == F.col(tmp[rk]) for lk, rk in on]
    if spread:
        conds += [F.col(lk).isNotNull() for lk in lkeys]
    out = left.join(right, reduce(lambda a, b: a & b, conds), "left")
    drop = ["__lk"] if spread else []
    if drop_right_keys:
        return out.drop(*drop, *tmp.values())
    return out.drop(*drop).withColumnsRenamed({v: k for k, v in tmp.items()})


def left_join_each(left: DataFrame, rights: Sequence[DataFrame], key: str) -> DataFrame:
    """LEFT JOIN several frames on the one column ``key`` that all have, with a single
    exchange of ``left``; NULL keys are spread as in ``left_join``."""
    t = left.schema[key].dataType
    on = key
    if _spreadable(t):
        on = "__lk"
        left = left.withColumn(on, F.expr(
            f"CASE WHEN {_q(key)} IS NULL THEN CAST(pmod(xxhash64({_q(left.columns[0])}), {_spread_buckets(left)}) "
            f"AS {t.simpleString()}) ELSE {_q(key)} END"))
    for i, right in enumerate(rights):
        rk = f"__rk{i}"
        left = left.join(right.withColumnRenamed(key, rk), (F.col(on) == F.col(rk)) & F.col(key).isNotNull(), "left").drop(rk)
    return left.drop("__lk")


def exists_flag(left: DataFrame, keys: DataFrame, left_key: str, right_key: str,
                flag: str) -> DataFrame:
    """Add boolean ``flag``: does ``left_key`` occur among ``keys[right_key]``.

    The semi join is expressed as a LEFT join to the DISTINCT keys, so every
    left row is kept and gets True or False.  ``distinct`` aggregates map-side,
    so a hot key costs one row per map task, not one per input row.
    """
    k = keys.select(F.col(right_key).alias(right_key)).where(F.col(right_key).isNotNull()).distinct()
    k = k.withColumn(flag, F.lit(True))
    out = left_join(left, k, [(left_key, right_key)], spread_null_keys=False)
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def broadcast_if_small(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` has at most ``max_rows`` rows.

    The count runs over ``limit(max_rows + 1)`` so the check stays cheap
    whatever the table holds; above the bound the frame is returned
    unchanged and the planner shuffles it instead.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def upper_columns(df: DataFrame) -> DataFrame:
    """Upper-case all column names (sources may arrive lower-case)."""
    return df.toDF(*[c.upper() for c in df.columns])
