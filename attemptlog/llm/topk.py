"""Exact top-k search by inner product (operator 1).

Vectors are dealt by hash into shards, queries into tiles. Every pair of a tile and a shard is
one group of bounded size: one matrix product, then each query's best k of the shard. The
per-query lists of a tile are merged over shards as a tree, ``FAN`` lists at a time.

Components count as whole numbers floor(64 * x) in double precision, so scores are exact: a
product whose sums could pass 2**53 is made with Python's integers, and a score that no long
can hold is an error.

Defined results: vectors that are null or hold null or non-finite components take no part,
nor do rows without an id. Rows that repeat an id with the same components count once. Only
vectors of the query's length are its candidates; those with the query's id are not. Ties go
to the smaller id. Queries without candidates give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.llm.common import map_rows
from attemptlog.session import materialize

SCALE = 64.0
TILE, SHARD, FAN = 1024, 4096, 8
EXACT = 2.0**53


def vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, dim, vec): scaled whole components as bytes of doubles, without repeats."""

    def rows(ids: pa.Array, lists: pa.Array) -> dict:
        out_id, out_dim, out = [], [], []
        values = np.asarray(lists.values.to_numpy(zero_copy_only=False), np.float64)
        starts = lists.offsets.to_numpy()
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        present = lists.is_valid().to_numpy(zero_copy_only=False)
        for i, name in enumerate(ids.to_pylist()):
            a, b = int(starts[i]), int(starts[i + 1])
            if name is None or not present[i] or bad[b] > bad[a]:
                continue
            out_id.append(name)
            out_dim.append(b - a)
            out.append(np.floor(SCALE * values[a:b]).tobytes())
        return {
            "id": pa.array(out_id, pa.int64()),
            "dim": pa.array(out_dim, pa.int32()),
            "vec": pa.array(out, pa.binary()),
        }

    plain = df.select(
        F.col(f"`{key}`").cast("long").alias("i"), F.col(f"`{vector}`").cast("array<double>").alias("v")
    )
    return map_rows(plain, ["i", "v"], "id long, dim int, vec binary", rows).distinct()


def _block(ids: pa.ChunkedArray, vectors: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and matrix of a group's rows, by id, then components."""
    rows = sorted(zip(ids.to_pylist(), vectors.to_pylist()))
    ids = np.array([i for i, _ in rows], np.int64)
    matrix = np.frombuffer(b"".join(v for _, v in rows), np.float64)
    return ids, matrix.reshape(len(rows), -1) if len(rows) else np.zeros((0, 0))


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    if not q.shape[1]:
        return np.zeros((len(q), len(x)), np.int64)
    if np.abs(q).max() * np.abs(x).max() * q.shape[1] < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in row] for row in m], object)
    exact = whole(q) @ whole(x).T
    if max(abs(v) for v in exact.ravel()) >= 1 << 63:
        raise OverflowError("a score does not fit a long")
    return exact.astype(np.int64)


def best(scored: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k highest allowed scores, the leftmost of ties."""
    low = np.iinfo(np.int64).min
    ranked = np.where(allowed, scored, low)
    if scored.shape[1] > k:
        limit = np.partition(ranked, -k, axis=1)[:, -k]
        take = (ranked >= limit[:, None]) & allowed
        for row in np.flatnonzero(take.sum(axis=1) > k):
            tied = np.flatnonzero(take[row] & (ranked[row] == limit[row]))
            above = int((ranked[row] > limit[row]).sum())
            take[row, tied[k - above :]] = False
    else:
        take = allowed
    return np.nonzero(take)


def _packed(tile: int, slot: int, dim: int, queries, which, ids, values) -> pa.Table:
    return pa.table(
        {
            "tile": pa.array([tile], pa.int32()),
            "slot": pa.array([slot], pa.int64()),
            "dim": pa.array([dim], pa.int32()),
            "queries": pa.array([queries.tobytes()], pa.binary()),
            "which": pa.array([which.astype(np.int32).tobytes()], pa.binary()),
            "ids": pa.array([ids.tobytes()], pa.binary()),
            "scores": pa.array([values.tobytes()], pa.binary()),
        }
    )


LISTS = "tile int, slot bigint, dim int, queries binary, which binary, ids binary, scores binary"


def search(df: DataFrame, key: str, vector: str, is_query, k: int) -> DataFrame:
    """Per query row: query_id, rank (from 1), vec_id, score of its k best candidates.

    ``is_query`` is a condition on the column ``id``.
    """
    base = materialize(vectors(df, key, vector), "vectors")
    queries = base.filter(is_query)
    shards = max(1, -(-base.count() // SHARD))
    tiles = max(1, -(-queries.count() // TILE))
    dealt = lambda n: F.pmod(F.xxhash64("id", "vec"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("tile", dealt(tiles)).withColumn("slot", every(shards))
    right = base.withColumn("slot", dealt(shards)).withColumn("tile", every(tiles))
    # Both come from one table; own names keep the sides of the cogroup apart.
    right = right.select(*[F.col(c).alias(f"x_{c}") for c in right.columns])
    group = ["tile", "slot", "dim"]

    def cell(of, a, b):
        tile, slot, dim = (v.as_py() for v in of)
        none = np.zeros(0, np.int64)
        if not a.num_rows or not b.num_rows:
            return _packed(tile, slot, dim, none, none, none, none).slice(0, 0)
        q_ids, q = _block(a["id"], a["vec"])
        ids, x = _block(b["x_id"], b["x_vec"])
        scored = scores(q, x)
        row, column = best(scored, q_ids[:, None] != ids[None, :], k)
        return _packed(tile, slot, dim, q_ids, row, ids[column], scored[row, column])

    lists = left.groupBy(*group).cogroup(right.groupBy(*[f"x_{c}" for c in group])).applyInArrow(cell, LISTS)

    def merged(of, table):
        tile, slot, dim = (v.as_py() for v in of)
        glue = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
        which, ids, values = glue("which", np.int32), glue("ids", np.int64), glue("scores", np.int64)
        order = np.lexsort((ids, -values.astype(object) if (values == np.iinfo(np.int64).min).any()
                            else -values, which))
        which, ids, values = which[order], ids[order], values[order]
        begin = np.searchsorted(which, which)
        keep = np.arange(len(which)) - begin < k
        named = np.frombuffer(table["queries"][0].as_py(), np.int64)
        return _packed(tile, slot, dim, named, which[keep], ids[keep], values[keep])

    slots = shards
    while True:
        slots = -(-slots // FAN)
        up = lists.withColumn("slot", F.floor(F.col("slot") / FAN))
        lists = up.groupBy(*group).applyInArrow(merged, LISTS)
        if slots == 1:
            break

    def unpacked(queries, which, ids, scores) -> dict:
        glue = lambda column, kind: np.frombuffer(b"".join(column.to_pylist()), kind)
        parts = [
            (np.frombuffer(q, np.int64)[np.frombuffer(w, np.int32)], np.frombuffer(w, np.int32))
            for q, w in zip(queries.to_pylist(), which.to_pylist())
        ]
        ranks = [np.arange(len(w)) - np.searchsorted(w, w) + 1 for _, w in parts]
        joined = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
        return {
            "query_id": pa.array(joined([q for q, _ in parts]), pa.int64()),
            "rank": pa.array(joined(ranks), pa.int32()),
            "vec_id": pa.array(glue(ids, np.int64)),
            "score": pa.array(glue(scores, np.int64)),
        }

    names = ["queries", "which", "ids", "scores"]
    return map_rows(lists, names, "query_id bigint, rank int, vec_id bigint, score bigint", unpacked)
