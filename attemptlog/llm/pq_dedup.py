"""Embedding near-duplicates with product quantisation (operator 8).

Equal vectors of a label are one class. An index is fitted on a sample of bounded size:
coarse centroids, and codes for parts of the residuals. Every class is put into the inverted
list of its nearest centroid, with the code of its residual and the exact length of what the
code leaves out.

A vector probes every list that can hold a neighbour within the radius r of the threshold: a
neighbour lies on the far side of the plane between two centroids, so a list whose plane is
farther away than r holds none. In a list, table look-ups give the distance from the query to
the coded vectors; by the triangle inequality a neighbour's is at most r plus its coding
error. Both rules lose nothing; what passes is ranked by its exact cosine. Lists are cut into
blocks, and every pair of a block of queries and a block of members is a group of bounded
size. A group writes out, for each vector, the number of its links and one link to the root
of its neighbours in the group, never the pairs.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows
without a label or an id, link with nothing and are their own component. Vectors of different
lengths never link. Rows that repeat an id are vectors of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.llm.common import map_rows
from attemptlog.llm.components import components, smallest
from attemptlog.session import materialize

#: Values (rows times length) of the sample that the index is fitted on.
SAMPLE_VALUES = 1 << 21
#: Members a coarse list should have, and the most lists.
LIST_ROWS, MAX_LISTS = 4096, 4096
PARTS, CODES, ROUNDS = 16, 64, 6
BLOCK, CHUNK = 2048, 256
SLACK = 1e-9


def prepared(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """id, label, dim, vec (bytes of doubles, scaled by a power of two; null where unusable)."""

    def rows(ids: pa.Array, lists: pa.Array, labels: pa.Array) -> dict:
        dims, out = [], []
        values = np.asarray(lists.values.to_numpy(zero_copy_only=False), np.float64) + 0.0
        starts = lists.offsets.to_numpy()
        usable = (ids.is_valid().to_numpy(False) & labels.is_valid().to_numpy(False)
                  & lists.is_valid().to_numpy(False))
        for i, good in enumerate(usable):
            v = values[starts[i] : starts[i + 1]]
            most = np.abs(v).max(initial=0.0)
            good = good and np.isfinite(v).all() and most > 0
            dims.append(len(v) if good else None)
            out.append((v * 2.0 ** -np.frexp(most)[1]).tobytes() if good else None)
        return {"id": ids, "label": labels, "dim": pa.array(dims, pa.int32()), "vec": pa.array(out, pa.binary())}

    plain = df.select(
        F.col(f"`{key}`").cast("long").alias("i"),
        F.col(f"`{vector}`").cast("array<double>").alias("v"),
        F.col(f"`{label}`").alias("l"),
    )
    schema = f"id long, label {dict(df.dtypes)[label]}, dim int, vec binary"
    named = map_rows(plain, ["i", "v", "l"], schema, rows)
    same = ["label", "dim", "vec"]
    return named.withColumns(
        {"n1": F.xxhash64(*same), "n2": F.xxhash64(F.lit("second"), *same)}
    )


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        at = nearest(x, centroids)
        counts = np.bincount(at, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, x)
        some = counts > 0
        centroids[some] = sums[some] / counts[some, None]
    return centroids


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, (rows, centroids)."""
    d = (x**2).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + (centroids**2).sum(axis=1)
    return np.maximum(d, 0)


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    step = max(1, (1 << 21) // len(centroids))
    parts = [distances(x[i : i + step], centroids).argmin(axis=1) for i in range(0, len(x), step)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


class Index:
    """Coarse centroids and the code books of the residuals' parts, for one length."""

    def __init__(self, dim: int, sample: np.ndarray, lists: int):
        rng = np.random.default_rng(dim)
        self.cuts = np.linspace(0, dim, min(PARTS, dim) + 1).astype(int)
        if not len(sample):
            sample = np.zeros((1, dim))
        self.centroids = kmeans(sample, max(1, min(lists, len(sample) // 8)), rng)
        few = sample[: CODES * 128]
        left = few - self.centroids[nearest(few, self.centroids)]
        self.books = [
            kmeans(np.ascontiguousarray(left[:, a:b]), CODES, rng)
            for a, b in zip(self.cuts[:-1], self.cuts[1:])
        ]
        self.apart = np.sqrt(distances(self.centroids, self.centroids))

    def parts(self, x: np.ndarray):
        return [np.ascontiguousarray(x[:, a:b]) for a, b in zip(self.cuts[:-1], self.cuts[1:])]

    def assign(self, unit: np.ndarray, radius: float):
        """List, code, coding error and lists to probe of each vector."""
        d = distances(unit, self.centroids)
        own = d.argmin(axis=1)
        left = unit - self.centroids[own]
        codes = np.stack([nearest(p, b) for p, b in zip(self.parts(left), self.books)], axis=1)
        coded = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        error = np.sqrt(((left - coded) ** 2).sum(axis=1))
        behind = d - d[np.arange(len(d)), own][:, None]
        probe = behind <= 2 * self.apart[own] * (radius + SLACK) + SLACK
        return own, codes.astype(np.uint8), error, [np.flatnonzero(p) for p in probe]

    def looked_up(self, unit: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances from ``unit`` to coded members of list ``at``, from tables."""
        total = np.zeros((len(unit), len(codes)))
        for i, part in enumerate(self.parts(unit - self.centroids[at])):
            total += distances(part, self.books[i])[:, codes[:, i]]
        return total


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x**2).sum(axis=1))[:, None]


def fit(classes: DataFrame) -> dict[int, Index]:
    """An index per vector length, from the sample of the first vectors by hash."""
    longest = classes.agg(F.max("dim")).first()[0]
    if longest is None:
        return {}
    lists = min(MAX_LISTS, max(1, classes.count() // LIST_ROWS))
    rows = classes.select("dim", "vec").orderBy("n1", "n2").limit(max(1, SAMPLE_VALUES // longest))
    table = rows.toArrow()
    dims = table["dim"].to_numpy()
    out = {}
    for dim in sorted(set(dims.tolist())):
        own = table.filter(pa.array(dims == dim))
        out[dim] = Index(dim, _units(_matrix(own["vec"], dim)), lists)
    return out


def indexed(classes: DataFrame, indexes: dict[int, Index], radius: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            for dim in sorted(set(batch["dim"].to_pylist())):
                own = batch.filter(pa.array(batch["dim"].to_numpy() == dim))
                # A length that the sample lacks has one list, and codes that say nothing.
                index = indexes.get(dim) or Index(dim, np.zeros((0, dim)), 1)
                at, codes, error, probes = index.assign(_units(_matrix(own["vec"], dim)), radius)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[own[c] for c in ("n1", "n2", "label", "dim", "copies", "vec")],
                        pa.array(at, pa.int32()),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(error),
                        pa.array(probes, pa.list_(pa.int32())),
                    ],
                    names=["n1", "n2", "label", "dim", "copies", "vec", "list", "code", "error", "probes"],
                )

    label = dict(classes.dtypes)["label"]
    chosen = classes.select("n1", "n2", "label", "dim", "copies", "vec")
    return chosen.mapInArrow(
        run,
        f"n1 long, n2 long, label {label}, dim int, copies long, vec binary, list int, code binary,"
        " error double, probes array<int>",
    )


def _roots(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``count`` nodes."""
    root = np.arange(count)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def linked(df: DataFrame, indexes: dict[int, Index], threshold: float) -> DataFrame:
    """(n1, n2, links, r1, r2): per group of blocks and vector, its links and its root there."""
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    key = ["label", "dim", "list"]
    asks = df.withColumn("list", F.explode("probes")).select(*key, "n1", "n2", "vec")
    blocks = lambda name: F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name)
    sizes = materialize(
        df.groupBy(*key).agg(blocks("shards")).join(asks.groupBy(*key).agg(blocks("tiles")), key), "lists"
    )
    dealt = lambda n: F.pmod(F.xxhash64("n1", "n2"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asks.join(sizes, key).withColumn("tile", dealt("tiles")).withColumn("shard", every("shards"))
    left = left.drop("shards", "tiles")
    right = df.join(sizes, key).withColumn("shard", dealt("shards")).withColumn("tile", every("tiles"))
    right = right.select(*[F.col(c).alias(f"y_{c}") for c in
                           (*key, "tile", "shard", "n1", "n2", "vec", "code", "error", "copies")])
    group = [*key, "tile", "shard"]

    def cell(of, a, b):
        none = np.zeros(0, np.int64)
        out = lambda n1, n2, links, r1, r2: pa.table(
            {"n1": n1, "n2": n2, "links": links, "r1": r1, "r2": r2}
        )
        if not a.num_rows or not b.num_rows:
            return out(none, none, none, none, none)
        dim, at = of[1].as_py(), of[2].as_py()
        index = indexes.get(dim) or Index(dim, np.zeros((0, dim)), 1)
        x, y = _units(_matrix(a["vec"], dim)), _units(_matrix(b["y_vec"], dim))
        codes = np.frombuffer(b"".join(b["y_code"].to_pylist()), np.uint8).reshape(len(y), -1)
        reach = (radius + b["y_error"].to_numpy() + SLACK) ** 2 + SLACK
        names = np.stack([np.concatenate([a[c].to_numpy(), b[f"y_{c}"].to_numpy()]) for c in ("n1", "n2")], 1)
        nodes, of_row = np.unique(names, axis=0, return_inverse=True)
        of_row = of_row.reshape(-1)
        in_x, in_y = of_row[: len(x)], of_row[len(x) :]
        copies, links, ends = b["y_copies"].to_numpy(), np.zeros(len(x), np.int64), []
        for low in range(0, len(x), CHUNK):
            part = slice(low, low + CHUNK)
            i, j = np.nonzero(index.looked_up(x[part], at, codes) <= reach)
            i = i + low
            apart = in_x[i] != in_y[j]
            i, j = i[apart], j[apart]
            # The exact cosine decides; pairs in pieces, so that dense blocks stay small.
            for p in range(0, len(i), 1 << 16):
                pi, pj = i[p : p + (1 << 16)], j[p : p + (1 << 16)]
                near = np.einsum("ij,ij->i", x[pi], y[pj]) >= threshold
                pi, pj = pi[near], pj[near]
                np.add.at(links, pi, copies[pj])
                if len(pi):
                    root = _roots(len(nodes), in_x[pi], in_y[pj])
                    moved = np.flatnonzero(root != np.arange(len(nodes)))
                    ends.append((moved, root[moved]))
        if not ends:
            return out(none, none, none, none, none)
        root = _roots(len(nodes), *[np.concatenate([e[k] for e in ends]) for k in (0, 1)])
        asked = np.flatnonzero(links > 0)
        # Links are counted once, at the asking vector; every end of one gets its root.
        total = np.zeros(len(nodes), np.int64)
        np.add.at(total, in_x[asked], links[asked])
        told = np.flatnonzero((root != np.arange(len(nodes))) | (total > 0))
        return out(nodes[told, 0], nodes[told, 1], total[told], nodes[root[told], 0], nodes[root[told], 1])

    made = left.groupBy(*group).cogroup(right.groupBy(*[f"y_{c}" for c in group]))
    return made.applyInArrow(cell, "n1 long, n2 long, links long, r1 long, r2 long")


def near_duplicates(df: DataFrame, key: str, vector: str, label: str, threshold: float) -> DataFrame:
    """Per row: key, n_links, component_id, kept."""
    rows = materialize(prepared(df, key, vector, label), "vectors")
    some = rows.filter("vec IS NOT NULL")
    same = ["n1", "n2", "label", "dim", "vec"]
    classes = materialize(
        some.groupBy(*same).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes"
    )
    indexes = fit(classes)
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    index = materialize(indexed(classes, indexes, radius), "index")
    found = materialize(linked(index, indexes, threshold), "found")
    roots = components(
        found.selectExpr("n1 AS a1", "n2 AS a2", "r1 AS b1", "r2 AS b2").filter("a1 != b1 OR a2 != b2")
    )
    rooted = smallest(classes.select("n1", "n2", "id").join(roots, ["n1", "n2"]), ["r1", "r2"], "id", "least")
    counts = found.groupBy("n1", "n2").agg(F.sum("links").alias("links"))
    named = (
        classes.select("n1", "n2", "id", "copies")
        .join(counts, ["n1", "n2"], "left")
        .join(rooted.select("n1", "n2", "least"), ["n1", "n2"], "left")
        .select(
            "n1", "n2",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("least", "id").alias("component_id"),
        )
    )
    joined = some.select("id", "n1", "n2").join(materialize(named, "named"), ["n1", "n2"])
    alone = rows.filter("vec IS NULL").select("id", F.lit(0).cast("long").alias("n_links"),
                                              F.col("id").alias("component_id"))
    return joined.select("id", "n_links", "component_id").unionByName(alone).select(
        F.col("id").alias(key), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
