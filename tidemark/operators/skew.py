"""LEFT JOIN with heavy keys split.

A key that holds a large share of the rows of either side of a join makes one
straggler task, and adaptive execution cannot split the side that a LEFT join does
not preserve.  ``heavy_keys`` finds such keys by counting; ``split_left_join``
deals the rows of a heavy key over a grid of cells: left rows over ``left``
stripes, right rows over ``right`` stripes, each row repeated once per stripe of
the other side, so that every pair of rows meets in exactly one cell.

In a large fan-out nearly all time goes to its pairs.  ``packed`` gathers the right
rows of a key in arrays, so that a join looks up a few arrays per left row, and
``unpacked``, as the last step, makes the pairs in one generated loop with whatever
reads them.

There can be no more heavy keys than the bound allows (a key is heavy with more
than one share of ``shares``), so their list is small whatever the data: it travels
as literals, which push down to the scans.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .joins import left_join

#: Below this many rows a key is not worth splitting.
MIN_ROWS = 100_000
#: Pairs of rows that one cell may make.
CELL_PAIRS = 10_000_000
#: Most partitions the cells of a join are hashed to.
MAX_PARTITIONS = 20_000
#: Most rows of a packed array.
PACKED_ROWS = 1024
_ROWS, _NOTHING = "__rows", "__nothing"


@dataclass(frozen=True)
class Heavy:
    """A heavy key and the stripes its rows are dealt to on each side."""
    key: object
    left: int = 1
    right: int = 1


def heavy_keys(df: DataFrame, key: str, min_rows: int = MIN_ROWS, shares: int | None = None) -> tuple[list, int]:
    """(keys, bound): the keys with more rows than ``bound``, which is ``min_rows``
    or one ``shares``-th of all rows (default: twice the shuffle partitions),
    whichever is more; so there are fewer than ``shares``.  Rows are counted
    map-side, once; NULL keys never join."""
    shares = shares or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = staged(df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")), "key-counts")
    bound = max(min_rows, (counts.agg(F.sum("__n")).first()[0] or 0) // shares, 1)
    return [r[key] for r in counts.where(F.col(key).isNotNull() & (F.col("__n") > bound)).collect()], bound


def stripes(rows: int, per_stripe: int) -> int:
    return max(1, -(-rows // per_stripe))


def stripes_by_pairs(left: DataFrame, left_key: str, right: DataFrame, right_key: str, heavy: Sequence[Heavy],
                     pairs: int = CELL_PAIRS) -> list[Heavy]:
    """``heavy`` with enough stripes that no cell makes more than about ``pairs``
    pairs, however many rows its key has on both sides.

    Stripes are added to the side whose stripes hold more rows, so that the
    cells stay near square and few rows are repeated."""
    def rows(df: DataFrame, key: str) -> dict:
        few = df.where(is_heavy(key, heavy)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return {r[key]: r["n"] for r in few.collect()}
    n, m = rows(left, left_key), rows(right, right_key)
    out = []
    for h in heavy:
        a, b, x, y = h.left, h.right, n.get(h.key, 0), m.get(h.key, 0)
        while x * y > a * b * pairs:
            if x * b >= y * a:
                a = min(2 * a, stripes(x * y, b * pairs))
            else:
                b = min(2 * b, stripes(x * y, a * pairs))
        out.append(Heavy(h.key, a, b))
    return out


def is_heavy(key: str, heavy: Sequence[Heavy]) -> Column:
    """Is the key one of the heavy ones; False for NULL."""
    return F.coalesce(F.col(key).isin([h.key for h in heavy]), F.lit(False))


def packed(df: DataFrame, keys: Sequence[str], in_place: bool = False) -> DataFrame:
    """Rows of ``df`` by ``keys``: the keys and an array of the other columns, of at
    most ``PACKED_ROWS`` rows; a key with more has several arrays.

    ``df`` is exchanged by ``keys``, unless it is partitioned so (``in_place``).  Which
    rows share an array is up to their order in the task; unpacked they are the same."""
    if not in_place:
        df = df.repartition(*keys)
    rest = [c for c in df.columns if c not in keys] or [F.lit(1).alias(_NOTHING)]
    # the low 33 bits count the rows of the partition
    place = F.shiftright(F.monotonically_increasing_id() % 2 ** 33, PACKED_ROWS.bit_length() - 1)
    return df.withColumn("__array", place).groupBy(*keys, "__array").agg(F.collect_list(F.struct(*rest)).alias(_ROWS)).drop("__array")


def unpacked(df: DataFrame) -> DataFrame:
    """A join with a packed right side, its arrays unpacked; rows without one are kept."""
    return df.select(*[c for c in df.columns if c != _ROWS], F.inline_outer(_ROWS)).drop(_NOTHING)


def split_left_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], heavy: Sequence[Heavy],
                    drop_right_keys: bool = True, pack: bool = False) -> DataFrame:
    """``left_join`` on heavy keys: ``right`` holds those only; rows of ``left`` with
    another first key, or none, meet nothing and are kept.

    A LEFT join per cell would also give a row without a match for every cell
    that holds none of a key's right rows.  Those rows go, unless the key has no
    right row at all: such keys get one stripe, so their rows meet no match once.
    With one right stripe per key (the right side unique on ``on``, say) no such
    row arises, and nothing is looked up.

    With ``pack`` the right columns other than the keys come ``packed``.
    """
    if not heavy:
        right = packed(right, [rk for _, rk in on]) if pack else right
        return left_join(left, right, on, drop_right_keys=drop_right_keys)
    spark = left.sparkSession
    key_type = right.schema[on[0][1]].dataType.simpleString()
    grid = spark.createDataFrame([(str(h.key), h.left, h.right) for h in heavy], "__key string, __l int, __r int") \
        .withColumn("__key", F.col("__key").cast(key_type))
    many = any(h.right > 1 for h in heavy)
    if many:
        found = right.where(is_heavy(on[0][1], heavy)).select(F.col(on[0][1]).alias("__key")).distinct()
        grid = grid.join(F.broadcast(found.withColumn("__met", F.lit(True))), "__key", "left") \
            .withColumn("__r", F.when(F.col("__met"), F.col("__r")))
    grid = F.broadcast(grid)  # fewer rows than shares
    right_keys = {rk: f"__rk{i}" for i, (_, rk) in enumerate(on)}

    def stripe(df: DataFrame, n: str) -> Column:
        return F.pmod(F.xxhash64(*df.columns), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(grid, F.col(on[0][0]) == F.col("__key"), "left") \
        .withColumns({n: F.coalesce(F.col(n), F.lit(1)) for n in ("__l", "__r")}) \
        .withColumn("__a", stripe(left, "__l")).withColumn("__b", every("__r")).drop("__key", "__l", "__r")
    b = right.join(grid.select("__key", "__l", "__r"), F.col(on[0][1]) == F.col("__key")).withColumn("__rb", stripe(right, "__r")).withColumn("__ra", every("__l")) \
        .select(*[F.col(c).alias(right_keys.get(c, c)) for c in right.columns], "__ra", "__rb")
    cond = (F.col("__a") == F.col("__ra")) & (F.col("__b") == F.col("__rb"))
    for lk, rk in on:
        cond &= F.col(lk) == F.col(right_keys[rk])
    cells = sum(h.left * h.right for h in heavy)
    if cells > len(heavy):
        # by number: adaptive execution would merge partitions that are small before the join
        parts = min(max(2 * cells, int(spark.conf.get("spark.sql.shuffle.partitions"))), MAX_PARTITIONS)
        a = a.repartition(parts, "__a", "__b", *[lk for lk, _ in on])
        b = b.repartition(parts, "__ra", "__rb", *[right_keys[rk] for _, rk in on])
    if pack:
        b = packed(b, ["__ra", "__rb", *right_keys.values()], in_place=cells > len(heavy))
    out = a.join(b, cond, "left")
    if many:
        out = out.where(F.col("__met").isNull() | F.col("__ra").isNotNull()).drop("__met")
    out = out.drop("__a", "__b", "__ra", "__rb")
    if drop_right_keys:
        return out.drop(*right_keys.values())
    return out.withColumnsRenamed({v: k for k, v in right_keys.items()})
