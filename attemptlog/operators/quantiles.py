"""Exact quantiles of whole numbers without gathering a group's values, in two ways.

``exact_quantiles`` counts, with map-side combining: how many values fall in each coarse
bucket, then in each finer bucket of the few that hold the wanted ranks, down to single
values. Each level reads the values again but shuffles only counts; what a window sorts is
bounded by the number of buckets in one level, not by the data.

``selected_quantiles`` reads the values twice, whatever their range: a sketch first gives two
splitters around each wanted rank, then the values between them are counted one by one, and
those below only in total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attemptlog.operators.skew import running_sum

# Bucket widths for durations in microseconds: 30 days, an hour, a second, a microsecond.
DURATION_WIDTHS = (2_592_000_000_000, 3_600_000_000, 1_000_000, 1)


def exact_quantiles(
    df: DataFrame,
    groups: list[str],
    value: str,
    quantiles: dict[str, float],
    widths: tuple[int, ...] = DURATION_WIDTHS,
) -> DataFrame:
    """Interpolated quantiles of the long column ``value`` per group.

    Returns the group columns, ``n`` and one double column per entry of ``quantiles``.
    """
    levels = [f"_b{i}" for i in range(len(widths))]
    values = (
        df.select(*groups, F.col(value).cast("long").alias("_v"))
        .select(*groups, *[F.expr(f"_v div {w}").alias(b) for b, w in zip(levels, widths)])
        .dropna(subset=levels)
    )
    count = F.count(F.lit(1)).alias("_rows")

    wanted = []
    for name, q in quantiles.items():
        spot = F.lit(q) * (F.col("_total") - 1)
        for side, rank in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            wanted.append(
                F.struct(
                    F.lit(name).alias("name"),
                    F.lit(side).alias("side"),
                    rank.cast("long").alias("rank"),
                    (spot - F.floor(spot)).alias("share"),
                )
            )

    ranks = None
    for depth, level in enumerate(levels):
        parent = [*groups, *levels[:depth]]
        if ranks is None:
            whole = Window.partitionBy(*groups)
            sizes = values.groupBy(*groups, level).agg(count)
            placed = sizes.withColumn("_end", F.sum("_rows").over(whole.orderBy(level)))
            found = placed.withColumn("_total", F.sum("_rows").over(whole)).withColumn(
                "_want", F.explode(F.array(*wanted))
            )
        else:
            inside = Window.partitionBy(*parent, "_want").orderBy(level)
            sizes = values.join(ranks, parent).groupBy(*parent, level, "_total", "_want").agg(count)
            found = sizes.withColumn("_end", F.sum("_rows").over(inside))
        rank, start = F.col("_want.rank"), F.col("_end") - F.col("_rows")
        ranks = found.filter((rank >= start) & (rank < F.col("_end"))).select(
            *parent, level, "_total", F.col("_want").withField("rank", rank - start).alias("_want")
        )

    picks = {
        name: (
            F.max(F.when(F.col("_want.name") == name, F.col("_want.share"))),
            *[
                F.max(
                    F.when(
                        (F.col("_want.name") == name) & (F.col("_want.side") == side),
                        F.col(levels[-1]),
                    )
                ).cast("double")
                for side in ("lo", "hi")
            ],
        )
        for name in quantiles
    }
    return ranks.groupBy(*groups).agg(
        F.max("_total").alias("n"),
        *[(lo + share * (hi - lo)).alias(name) for name, (share, lo, hi) in picks.items()],
    )


#: Relative error of a sketch's ranks is one in so many; splitters lie twice that off the rank.
ACCURACY = 1_000
#: Groups of fewer values are counted whole: there a rank has too little room for the error.
COUNTED_WHOLE = 4 * ACCURACY
#: Neighbouring values that one task puts in order, by levels.
VALUES_TOGETHER = (1 << 40, 1 << 20)


def selected_quantiles(
    df: DataFrame, groups: list[str], value: str, quantiles: dict[str, float]
) -> DataFrame:
    """As ``exact_quantiles``: the group columns, ``n`` and a double column per quantile."""
    names = [f"_g{i}" for i in range(len(groups))]
    keys = names or ["_g"]
    # A group of all rows has a key too, made from the rows so that it joins like any other.
    own = [F.col(g).alias(n) for g, n in zip(groups, names)] or [(F.col(value) * 0).cast("long").alias("_g")]
    values = df.select(*own, F.col(value).cast("long").alias("_v")).filter("_v IS NOT NULL")

    n, slack = F.count("_v"), 2 / ACCURACY
    at = lambda q: F.percentile_approx("_v", F.lit(q), F.lit(ACCURACY))
    splitters = []
    for name, q in quantiles.items():
        low, high = F.min("_v"), F.max("_v")
        low = F.when(n < COUNTED_WHOLE, low).otherwise(at(q - slack) if q > slack else low)
        high = F.when(n < COUNTED_WHOLE, high).otherwise(at(q + slack) if q < 1 - slack else high)
        splitters.append(F.struct(F.lit(name).alias("name"), F.lit(q).alias("q"), low.alias("low"), high.alias("high")))
    bounds = values.groupBy(*keys).agg(n.alias("_n"), F.array(*splitters).alias("_bounds"))

    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_of{k}"))
    named = bounds.withColumnsRenamed({k: f"_of{k}" for k in keys})
    met = values.join(named, match).select(*keys, "_n", "_v", F.explode("_bounds").alias("_b"))
    met = met.filter(F.col("_v") <= F.col("_b.high"))
    slot = F.when(F.col("_v") >= F.col("_b.low"), F.col("_v"))
    each = [*keys, "_n", "_name", "_q"]
    counted = (
        met.select(*keys, "_n", F.col("_b.name").alias("_name"), F.col("_b.q").alias("_q"), slot.alias("_slot"))
        .groupBy(*each, "_slot")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    # Those below the splitter come first, as one.
    counted = counted.withColumn("_slot", F.coalesce("_slot", F.lit(-(1 << 63))))
    cuts = [F.floor(F.col("_slot") / n).cast("long") for n in VALUES_TOGETHER]
    placed = running_sum(counted, each, ["_slot"], cuts, "_rows", "_end")
    spot = F.col("_q") * (F.col("_n") - 1)
    start = F.col("_end") - F.col("_rows")
    holds = lambda rank: F.max(F.when((rank >= start) & (rank < F.col("_end")), F.col("_slot"))).cast("double")
    picked = placed.groupBy(*each).agg(holds(F.floor(spot)).alias("_lo"), holds(F.ceil(spot)).alias("_hi"))
    picked = picked.withColumn("_at", F.col("_lo") + (spot - F.floor(spot)) * (F.col("_hi") - F.col("_lo")))
    missed = F.raise_error(F.lit("a splitter lies beyond the rank it was made for"))
    picked = picked.withColumn("_at", F.coalesce("_at", missed.cast("double")))
    return picked.groupBy(*keys, F.col("_n").alias("n")).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_at"))).alias(name) for name in quantiles]
    ).select(*[F.col(n).alias(g) for n, g in zip(names, groups)], "n", *quantiles)
