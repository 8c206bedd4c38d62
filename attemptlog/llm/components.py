"""Connected components and linking inside buckets, with DataFrame functions only.

A node is a pair of longs (n1, n2). Nothing is collected: every step writes a table below the
session's shared folder, and a join reads both sides from such tables, so that adaptive
execution can split the rows of a hot node or bucket.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.llm.common import likely_in, written
from attemptlog.operators.skew import join_unique
from attemptlog.session import materialize, release

N, A, B = ["n1", "n2"], ["a1", "a2"], ["b1", "b2"]


def components(edges: DataFrame) -> DataFrame:
    """Node (n1, n2) and root (r1, r2) of every node in ``edges`` (a1, a2, b1, b2).

    Randomised contraction: in every round each node moves to the node within two steps that
    comes first in a random order of that round, and edges follow their ends. A star or a
    clique becomes one node in a round; of a chain a constant share of the nodes vanishes, so
    it takes the logarithm of its length. The moves are put together from the last round back.
    """
    node = lambda ends: F.struct(*[F.col(c).alias(n) for c, n in zip(ends, N)])
    graph = edges.select(node(A).alias("u"), node(B).alias("v")).filter("u != v")
    graph = materialize(graph.distinct(), "graph")
    moves, step = [], 0
    while not graph.isEmpty():
        first = lambda node: F.struct(F.xxhash64(node, F.lit(step)).alias("h"), node.alias("to"))  # noqa: E731, B023
        u, v = F.col("u"), F.col("v")
        both = graph.select("u", "v").unionByName(graph.select(v.alias("u"), u.alias("v")))
        best = both.groupBy("u").agg(F.min(first(v)).alias("best"))
        near = best.select(u.alias("v"), F.least("best", first(u)).alias("best"))
        # What the neighbours see is within two steps, and includes what the node sees.
        move = both.join(materialize(near, "near"), "v").groupBy("u").agg(F.min("best").alias("best"))
        move = materialize(move.select("u", F.col("best.to").alias("to")), "moves")
        moves.append(move)
        left = graph.join(move, "u").select(F.col("to").alias("x"), "v")
        right = move.select(F.col("u").alias("v"), F.col("to").alias("y"))
        moved = left.join(right, "v").filter("x != y")
        graph = materialize(
            moved.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct(),
            "graph",
        )
        step += 1
    if not moves:
        return _rooted(graph.select("u", F.col("v").alias("to")))
    roots = moves[-1]
    for move in reversed(moves[:-1]):
        later = roots.select(F.col("u").alias("to"), F.col("to").alias("end"))
        roots = move.join(later, "to", "left").select("u", F.coalesce("end", "to").alias("to"))
    return _rooted(materialize(roots, "roots"))


def _rooted(roots: DataFrame) -> DataFrame:
    return roots.select(
        F.col("u.n1").alias("n1"), F.col("u.n2").alias("n2"),
        F.col("to.n1").alias("r1"), F.col("to.n2").alias("r2"),
    )


def link_buckets(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    settle: Callable[[DataFrame], DataFrame],
    join_up: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Links between nodes that share a bucket, and the components they make.

    ``members`` has bucket, n1, n2 (repeats allowed); ``verify`` gets candidate pairs (a1, a2,
    b1, b2), each once, and returns those that link. All pairs of a bucket count, but not all
    are written out: first every member is tried against one centre of its bucket, which
    joins up groups of near copies in linear time. What is left are pairs whose ends are in
    different components after that. ``settle`` gets the members of such buckets with their
    roots (r1, r2) and returns links (a1, a2, b1, b2) that join up whatever is linked in a
    bucket. So components are exact for the given buckets; the links returned suffice.
    ``join_up`` finds the components of links, by default ``components``.
    """
    join_up = join_up or components
    hub = members.groupBy("bucket").agg(F.min("n1").alias("c1"), F.max("n1").alias("m1"))
    hubs = materialize(hub.filter("c1 != m1").select("bucket", "c1"), "buckets")
    shared = join_unique(likely_in(members, ["bucket"], hubs), hubs, ["bucket"], "inner")
    shared = written(shared.distinct(), "members")
    found = shared
    centres = materialize(shared.filter("n1 = c1").groupBy("bucket").agg(F.min("n2").alias("c2")), "centres")
    shared = join_unique(shared, centres, ["bucket"], "inner")
    pairs = shared.filter("n1 != c1 OR n2 != c2").selectExpr(
        "n1 AS a1", "n2 AS a2", "c1 AS b1", "c2 AS b2"
    )
    tried = materialize(pairs.distinct(), "pairs")
    links = materialize(verify(tried), "links")
    release(hubs, tried)
    roots = join_up(links)

    known = shared.join(roots, ["n1", "n2"], "left").selectExpr(
        "bucket", "n1", "n2", "coalesce(r1, n1) AS r1", "coalesce(r2, n2) AS r2"
    )
    known = materialize(known, "members-rooted")
    release(found, centres)
    mixed = known.groupBy("bucket").agg(
        F.min("r1").alias("l1"), F.max("r1").alias("h1"),
        F.min("r2").alias("l2"), F.max("r2").alias("h2"),
        F.count(F.lit(1)).alias("rows"),
    )
    # A bucket of two has had its only pair tried.
    mixed = materialize(
        mixed.filter("rows > 2 AND (l1 != h1 OR l2 != h2)").select("bucket"), "buckets-mixed"
    )
    open_ = materialize(known.join(mixed, "bucket"), "members-open")
    release(known, mixed)
    more = materialize(settle(open_), "links-rest")
    release(open_)
    return joined_up(links, roots, more, join_up)


def joined_up(
    links: DataFrame, roots: DataFrame, more: DataFrame, join_up: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """All links and the roots that they make, from links with their roots and ``more`` links."""
    if more.isEmpty():
        return links, roots
    # Only the roots are joined up anew.
    at = lambda ends, to: roots.selectExpr(
        f"n1 AS {ends[0]}", f"n2 AS {ends[1]}", f"r1 AS {to}1", f"r2 AS {to}2"
    )
    between = more.join(at(A, "x"), A, "left").join(at(B, "y"), B, "left").selectExpr(
        "coalesce(x1, a1) AS a1", "coalesce(x2, a2) AS a2",
        "coalesce(y1, b1) AS b1", "coalesce(y2, b2) AS b2",
    )
    over = join_up(between)
    lifted = over.selectExpr("n1 AS r1", "n2 AS r2", "r1 AS t1", "r2 AS t2")
    old = roots.join(lifted, ["r1", "r2"], "left").selectExpr(
        "n1", "n2", "coalesce(t1, r1) AS r1", "coalesce(t2, r2) AS r2"
    )
    # Nodes that had no link before.
    new = over.join(roots, ["n1", "n2"], "left_anti").select("n1", "n2", "r1", "r2")
    return links.unionByName(more), materialize(old.unionByName(new), "roots")


def smallest(rows: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the smallest ``value`` of their group, for groups of any size."""
    rows = materialize(rows, "grouped")
    low = materialize(rows.groupBy(*group).agg(F.min(value).alias(name)), "smallest")
    return rows.join(low, group)
