"""Ordering and joining groups of any size, in one way for every key.

A plain window sorts a whole group in one task, and a plain join sends all rows of a key to
one. Here every group is cut into pieces that follow its order, down to the last order
column; the window runs per piece, and the pieces' totals, counted with map-side combining,
join them up again. A join gives both sides a shuffle of its own, which is what adaptive
execution needs to split the rows of a busy key; it never splits a window, nor a join below
which a side is still arranged for a ranking or an aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attemptlog.session import materialize

#: Rows drawn for each range.
SAMPLED = 60


def order_within(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    pieces: list[Column],
    number: str,
    previous: dict[str, str] | None = None,
) -> DataFrame:
    """Number rows per key in ascending ``order`` and fetch values of the row before.

    ``pieces`` cut a group, each one finer than and inside the one before; along ``order``
    they must not decrease. ``previous`` maps a new column to the column whose preceding
    value it takes (NULL on the first row).
    """
    previous = previous or {}
    names = [f"_piece{i}" for i in range(len(pieces))]
    cut = df.withColumns(dict(zip(names, pieces)))
    within = Window.partitionBy(*keys, *names).orderBy(*order)
    local = cut.withColumn("_place", F.row_number().over(within)).withColumns(
        {f"_own_{name}": F.lag(source).over(within) for name, source in previous.items()}
    )
    sources = [F.col(s).alias(name) for name, s in previous.items()]
    last = F.max_by(F.struct(F.lit(True).alias("_any"), *sources), F.struct(*order))
    sizes = cut.groupBy(*keys, *names).agg(
        F.count(F.lit(1)).alias("_rows"), *([last.alias("_last")] if previous else [])
    )
    joined = _same(local, _joints(sizes, keys, names), [*keys, *names])
    opens = (F.col("_place") == 1) & F.lit(bool(previous))
    return joined.select(
        *df.columns,
        (F.col("_place") + F.col("_before")).alias(number),
        *[
            F.when(opens, F.col(f"_joint.{name}")).otherwise(F.col(f"_own_{name}")).alias(name)
            for name in previous
        ],
    )


def order_across(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    number: str,
    previous: dict[str, str] | None = None,
) -> DataFrame:
    """As ``order_within``, without pieces to name: rows are ranged by key and order together.

    The bounds come from a sample of the rows, so a busy key, or a busy moment of it, fills as many
    ranges as it has a share of the rows, whatever its ids look like. The ranges are written to the
    shared folder, which fixes them. Each one is numbered on its own; only keys that go on beyond a
    range, two for each at most, need what lies before.
    """
    ranged = df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    return _over_ranges(df.columns, ranged, _same, ranged, keys, order, number, previous or {})


def order_between(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    number: str,
    previous: dict[str, str] | None = None,
) -> DataFrame:
    """As ``order_across``, with the rows shuffled once and not written: ``df`` is read four times.

    The bounds are drawn from a sample and written to the shared folder, which fixes them. Only keys of
    bounds go on beyond a range: what lies before is as many rows as there are ranges, and is written.
    """
    columns = [*keys, *order]
    bounds = _bounds(df, columns)
    ranged = _in_ranges(df, bounds, columns)
    cut = bounds.select(F.explode(F.flatten("fine")).alias("at")).select(*[f"at.{k}" for k in keys])
    cut = _same(ranged, materialize(cut.distinct(), "cut-keys"), keys)

    def joined(left, right, on, how):
        return _same(left, materialize(right, "joints"), on, how)

    return _over_ranges(df.columns, ranged, joined, cut, keys, order, number, previous or {})


def _over_ranges(
    columns: list[str],
    ranged: DataFrame,
    join: Callable[..., DataFrame],
    cut: DataFrame,
    keys: list[str],
    order: list[str],
    number: str,
    previous: dict[str, str],
) -> DataFrame:
    """Rows numbered per ``_range``, joined up by the rows of ``cut``: those of keys in several ranges."""
    within = Window.partitionBy("_range", *keys).orderBy(*order)
    local = ranged.withColumn("_place", F.row_number().over(within)).withColumns(
        {f"_own_{name}": F.lag(source).over(within) for name, source in previous.items()}
    )
    sources = [F.col(s).alias(name) for name, s in previous.items()]
    last = F.max_by(F.struct(F.lit(True).alias("_any"), *sources), F.struct(*order))
    spans = cut.groupBy(*keys, "_range").agg(
        F.count(F.lit(1)).alias("_rows"), *([last.alias("_last")] if previous else [])
    )
    along = Window.partitionBy(*keys).orderBy("_range")
    before = F.sum("_rows").over(along.rowsBetween(Window.unboundedPreceding, -1))
    joints = spans.select(
        *keys,
        "_range",
        before.alias("_before"),
        *([F.lag("_last").over(along).alias("_joint")] if previous else []),
    ).filter("_before IS NOT NULL")
    joined = join(local, joints, ["_range", *keys], "left")
    opens = (F.col("_place") == 1) & F.lit(bool(previous))
    return joined.select(
        *columns,
        (F.col("_place") + F.coalesce("_before", F.lit(0))).alias(number),
        *[
            F.when(opens, F.col(f"_joint.{name}")).otherwise(F.col(f"_own_{name}")).alias(name)
            for name in previous
        ],
    )


def _bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row, of ``fine``: bounds of ranges of about equal size, in groups, and ``coarse``: their first ones."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, ranges * SAMPLED / max(1, df.count()))
    drawn = df.select(F.struct(*columns).alias("at")).sample(share, seed=1)
    drawn = drawn.agg(F.array_sort(F.collect_list("at")).alias("drawn"))
    every = F.filter("drawn", lambda _, i: i % SAMPLED == SAMPLED // 2)
    group = math.isqrt(ranges) + 1
    groups = F.sequence(F.lit(0), F.floor((F.greatest(F.size("every"), F.lit(1)) - 1) / group).cast("int"))
    fine = F.transform(groups, lambda g: F.slice("every", g * group + 1, group))
    coarse = F.transform(F.slice("fine", 2, ranges), lambda g: F.get(g, F.lit(0)))
    cut = drawn.select(every.alias("every")).select(fine.alias("fine"))
    return materialize(cut.withColumn("coarse", coarse), "bounds")


def _in_ranges(df: DataFrame, bounds: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with the number of their range: their group by the coarse bounds, then their place in it."""
    held = df.withColumn("_bounds", bounds.select(F.struct("coarse", "fine")).scalar())
    row = F.struct(*columns)
    upto = lambda found: F.size(F.filter(found, lambda b: b <= row))
    group, widest = upto(F.col("_bounds.coarse")), F.size(F.get("_bounds.fine", F.lit(0)))
    return held.withColumn("_range", group * (widest + 1) + upto(F.get("_bounds.fine", group))).drop("_bounds")


def running_sum(
    df: DataFrame, keys: list[str], order: list[str], pieces: list[Column], value: str, name: str
) -> DataFrame:
    """Sum of ``value`` over the rows of a key up to each one, cut as in ``order_within``."""
    names = [f"_piece{i}" for i in range(len(pieces))]
    cut = df.withColumns(dict(zip(names, pieces)))
    within = Window.partitionBy(*keys, *names).orderBy(*order)
    local = F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, 0))
    sizes = cut.groupBy(*keys, *names).agg(F.sum(value).alias("_rows"))
    above = _joints(sizes, keys, names).withColumnRenamed("_before", "_sum_before")
    joined = _same(cut.withColumn("_sum", local), above, [*keys, *names])
    return joined.select(*df.columns, (F.col("_sum") + F.col("_sum_before")).alias(name))


def _joints(sizes: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """For each piece the rows before it, and the last of them if sizes have it."""
    *outer, inner = names
    lasts = "_last" in sizes.columns
    along = Window.partitionBy(*keys, *outer).orderBy(inner)
    before = F.sum("_rows").over(along.rowsBetween(Window.unboundedPreceding, -1))
    here = sizes.select(
        *keys,
        *names,
        F.coalesce(before, F.lit(0)).alias("_before"),
        *([F.lag("_last").over(along).alias("_joint")] if lasts else []),
    )
    if not outer:
        return here
    wider = sizes.groupBy(*keys, *outer).agg(
        F.sum("_rows").alias("_rows"),
        *([F.max_by("_last", F.struct(inner)).alias("_last")] if lasts else []),
    )
    above = _joints(wider, keys, outer)
    above = above.withColumnsRenamed({"_before": "_above", "_joint": "_wider"})
    return _same(here, above, [*keys, *outer]).select(
        *keys,
        *names,
        (F.col("_before") + F.col("_above")).alias("_before"),
        *([F.coalesce("_joint", "_wider").alias("_joint")] if lasts else []),
    )


def _same(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """Join to the one row of equal ``columns``, NULL being equal to NULL."""
    named = right.withColumnsRenamed({c: f"_of_{c}" for c in columns})
    match = F.lit(True)
    for c in columns:
        match = match & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return left.join(named, match, how).drop(*[f"_of_{c}" for c in columns])


def time_pieces(df: DataFrame, time: str, last: str) -> list[Column]:
    """Pieces for an order by ``time``, then the id ``last``."""
    return [F.date_trunc("second", F.col(time)), F.struct(time, id_piece(df, last))]


def id_piece(df: DataFrame, column: str) -> Column:
    """A coarser value of an id that follows its order: of text, the first characters."""
    if dict(df.dtypes)[column] == "string":
        return F.substring(column, 1, 3)
    return F.floor(F.col(column) / 4096)


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join (inner, left, left_semi or left_anti) to a side with one row per key.

    The second join column follows from the keys. It brings both sides a shuffle of the
    join's own, also one that is already arranged by the keys.
    """
    again = F.xxhash64(*keys)
    return left.withColumn("_again", again).join(
        right.withColumn("_again", again), [*keys, "_again"], how
    ).drop("_again")


def spread_nulls(key: Column, row_id: Column) -> Column:
    """Join key that scatters rows whose ``key`` is NULL instead of gathering them.

    The stand-in names the row itself and matches no id. Join it to ``id_key``.
    """
    return F.coalesce(id_key(key), F.concat(F.lit("none:"), id_key(row_id)))


def id_key(value: Column) -> Column:
    """An id as text."""
    return value.cast("string")
