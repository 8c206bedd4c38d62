"""Audit of filters that overlap: what each removes in every order, and its fair share.

Each document gets a mask of the filters it fails. How many documents a coalition of filters
removes is tabulated once for all 32 coalitions of a part; every figure of every order is a
difference of two of them. The shares (Shapley values) are the weights of an additive model
fitted to the coalitions by least squares with the Shapley kernel, constrained to add up to
what all filters remove together; the normal equations are solved in rationals.

Defined results: a null text counts as empty, and so as identical to every empty one. A null id
is smaller than none: such a row never repeats another and is repeated by none. Rows that share an
id are one document given twice: neither repeats the other, each counts. A label counts if any
row of its id has it. A part is a source as it is spelt; null joins the empty string. An empty table gives no
rows. Very long texts are one row each. Columns besides the named ones are not looked at.
"""

from __future__ import annotations

import json
from fractions import Fraction
from itertools import combinations, permutations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attemptlog.operators.skew import join_unique
from attemptlog.session import materialize

#: The filters in the order of their bits: few words, few distinct words, capitals, symbols, repeats.
FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
FEWEST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITALS_PERCENT = 5
SYMBOLS = "[#$%&*|]"
#: Key of the count of all documents beside those of the coalitions.
TOTAL = ALL + 1


def shares() -> list[dict[int, Fraction]]:
    """Per filter, its share as a weighted sum of what the coalitions remove: coalition to weight.

    Normal equations of the kernel-weighted fit over all coalitions but none and all, with one
    multiplier that holds the shares to the total.
    """
    m = len(FILTERS)
    kernel = {}
    for size in range(1, m):
        for chosen in combinations(range(m), size):
            kernel[sum(1 << i for i in chosen)] = Fraction(m - 1, comb(m, size) * size * (m - size))
    rows = [
        [sum((w for s, w in kernel.items() if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(m)] + [Fraction(1)]
        for i in range(m)
    ]
    inverse = _inverse(rows + [[Fraction(1)] * m + [Fraction(0)]])
    return [
        {s: w * sum(inverse[i][j] for j in range(m) if s >> j & 1) for s, w in kernel.items()} | {ALL: inverse[i][m]}
        for i in range(m)
    ]


def _inverse(rows: list[list[Fraction]]) -> list[list[Fraction]]:
    n = len(rows)
    work = [row + [Fraction(i == j) for j in range(n)] for i, row in enumerate(rows)]
    for at in range(n):
        pivot = next(i for i in range(at, n) if work[i][at])
        work[at], work[pivot] = work[pivot], work[at]
        work[at] = [x / work[at][at] for x in work[at]]
        for i in range(n):
            if i != at:
                work[i] = [x - work[i][at] * y for x, y in zip(work[i], work[at])]
    return [row[n:] for row in work]


def failures(text: Column) -> Column:
    """Bits of the filters that a text fails by itself, all but the last one."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    distinct = F.size(F.array_distinct(words)).cast("long")
    fails = [
        F.size(words) < FEWEST_WORDS,
        100 * distinct < DISTINCT_PERCENT * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > CAPITALS_PERCENT * F.length(text),
        text.rlike(SYMBOLS),
    ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def masks(
    docs: DataFrame, key: str, text: str, part: str, labels: DataFrame, label_key: str, good: str, toxic: str
) -> DataFrame:
    """Per document: id, part, mask of all filters it fails, and whether it is good and toxic.

    Texts are compared by their SHA-256 and do not leave the first task.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    read = docs.select(
        F.col(f"`{key}`").alias("id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        failures(whole).alias("mask"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
    )
    read = materialize(read, "audit-masks")
    firsts = read.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    kinds = (
        labels.select(F.col(f"`{label_key}`").alias("id"), F.col(f"`{good}`").alias("g"), F.col(f"`{toxic}`").alias("t"))
        .groupBy("id")
        .agg(F.coalesce(F.max(F.col("g") == 1), F.lit(False)).alias("good"),
             F.coalesce(F.max(F.col("t") == 1), F.lit(False)).alias("toxic"))
    )
    repeats = F.when(F.col("id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    return (
        join_unique(join_unique(read, firsts, ["digest"], "left"), kinds, ["id"], "left")
        .select(
            "id",
            "part",
            (F.col("mask") + repeats).alias("mask"),
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
    )


def coalitions(masked: DataFrame) -> DataFrame:
    """Per part a map from each coalition (bits) to the documents it removes: all, good, toxic."""
    counted = masked.groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    hits = F.filter(
        F.sequence(F.lit(1), F.lit(TOTAL)), lambda s: (s == TOTAL) | (s.bitwiseAND(F.col("mask")) != 0)
    )
    each = counted.select("part", F.explode(hits).alias("coalition"), "n", "good", "toxic")
    sums = each.groupBy("part", "coalition").agg(
        F.sum("n").alias("all"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    entries = F.collect_list(F.struct("coalition", F.struct("all", "good", "toxic")))
    return sums.groupBy("part").agg(F.map_from_entries(entries).alias("removed"))


def _steps() -> Column:
    """All orders and steps, with the coalitions before and after, as one constant."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, i in enumerate(order, 1):
            rows.append({"filter_order": "".join(FILTERS[j] for j in order), "step": step, "filter": i,
                         "before": before, "after": before | 1 << i})
            before |= 1 << i
    schema = "array<struct<filter_order:string,step:int,filter:int,before:int,after:int>>"
    return F.from_json(F.lit(json.dumps(rows)), schema)


def audit(
    docs: DataFrame, key: str, text: str, part: str, labels: DataFrame, label_key: str, good: str, toxic: str
) -> DataFrame:
    """A row per part, order of filters and step; ``shapley`` is the share summed over all orders."""
    table = coalitions(masks(docs, key, text, part, labels, label_key, good, toxic))

    def v(coalition: Column, what: str) -> Column:
        return F.coalesce(F.col("removed")[coalition][what], F.lit(0).cast("long"))

    orders = len(list(permutations(FILTERS)))
    fair = []
    for weights in shares():
        whole = {s: w * orders for s, w in weights.items() if w}
        assert all(w.denominator == 1 for w in whole.values())
        fair.append(sum((int(w) * v(F.lit(s), "all") for s, w in whole.items()), F.lit(0).cast("long")))
    steps = table.select("part", "removed", F.array(*fair).alias("fair"), F.explode(_steps()).alias("s"))
    steps = steps.select("part", "removed", "fair", "s.*")
    own = F.expr("shiftleft(1, filter)")
    gone = lambda what: v(F.col("after"), what) - v(F.col("before"), what)
    return steps.select(
        "part",
        "filter_order",
        "step",
        (v(F.lit(TOTAL), "all") - v(F.col("after"), "all")).alias("kept"),
        gone("all").alias("removed"),
        (v(own, "all") - gone("all")).alias("redundant"),
        (v(F.lit(ALL), "all") - v(F.lit(ALL) - own, "all")).alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        F.col("fair")[F.col("filter")].alias("shapley"),
        F.substring(F.lit(FILTERS), F.col("filter") + 1, F.lit(1)).alias("filter"),
    )
