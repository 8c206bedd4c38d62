"""Connected components for operators that may use numpy: edges are contracted inside tasks.

Each round takes one shuffle and writes one table. A task joins up the edges that it holds and names
each group by the node that comes first in a random order of the round. The shuffle brings
together, per node, the names it was given, no more than there were tasks; the node moves to the first
of them, and the other names become edges to it. Nodes that name no group are gone. A star
or a clique is one node after two rounds; of a chain a constant share of the nodes goes in each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.llm.common import mix64
from attemptlog.llm.components import N
from attemptlog.session import materialize

#: Edges that a task joins up at a time.
HELD = 1 << 20
_NAMED = "n1 bigint, n2 bigint, r1 bigint, r2 bigint"


def groups(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of ``n`` nodes is connected to, over edges (u, v)."""
    root = np.arange(n)
    while len(u):
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        apart = low != high
        u, v, low, high = u[apart], v[apart], low[apart], high[apart]
        np.minimum.at(root, high, low)
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further
    return root


def named(ends: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of edges (rows of u1, u2, v1, v2) and the first node of each one's group."""
    both = ends.reshape(-1, 2)
    order = mix64(mix64(both[:, 0].view(np.uint64) + np.uint64(step + 1)) ^ both[:, 1].view(np.uint64))
    place = np.lexsort((both[:, 1], both[:, 0], order))
    ordered = both[place]
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    nodes = ordered[fresh]
    number = np.empty(len(both), np.int64)
    number[place] = np.cumsum(fresh) - 1
    root = groups(number[::2], number[1::2], len(nodes))
    return nodes, nodes[root]


def contracted(edges: DataFrame, step: int) -> DataFrame:
    """(n1, n2, r1, r2): per task, every node of its edges with the node that names its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            nodes, names = named(np.concatenate(held), step)
            held.clear()
            columns = [np.ascontiguousarray(c) for c in (*nodes.T, *names.T)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["n1", "n2", "r1", "r2"])

        for batch in batches:
            if batch.num_rows:
                held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1))
            if sum(map(len, held)) >= HELD:
                yield out()
        if held:
            yield out()

    return edges.select("a1", "a2", "b1", "b2").mapInArrow(run, _NAMED)


def components(edges: DataFrame) -> DataFrame:
    """Node (n1, n2) and root (r1, r2) of every node in ``edges`` (a1, a2, b1, b2), ends distinct or not."""
    moves: list[DataFrame] = []
    graph = edges
    while True:
        step = len(moves)
        name = F.struct("r1", "r2")
        first = F.struct(F.xxhash64("r1", "r2", F.lit(step)).alias("h"), "r1", "r2")
        given = contracted(graph, step).groupBy(*N).agg(F.min(first).alias("to"), F.collect_set(name).alias("names"))
        given = materialize(given.select(*N, "to.r1", "to.r2", "names"), "moves")
        moves.append(given.select(*N, "r1", "r2"))
        several = given.filter(F.size("names") > 1)
        others = several.select(F.explode("names").alias("b"), F.col("r1").alias("a1"), F.col("r2").alias("a2"))
        graph = others.select("a1", "a2", F.col("b.r1").alias("b1"), F.col("b.r2").alias("b2")).filter("a1 != b1 OR a2 != b2")
        if several.isEmpty():
            break
    roots = moves[-1]
    for move in reversed(moves[:-1]):
        later = roots.selectExpr("n1 AS r1", "n2 AS r2", "r1 AS t1", "r2 AS t2")
        roots = move.join(later, ["r1", "r2"], "left").select(
            *N, F.coalesce("t1", "r1").alias("r1"), F.coalesce("t2", "r2").alias("r2")
        )
    return materialize(roots, "roots")
