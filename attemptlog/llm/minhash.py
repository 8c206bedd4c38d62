"""MinHash near-duplicates with sequential Bayesian verification (operator 3).

A document's set holds its distinct shingles of five words (A-Z as a-z), as 64-bit hashes;
with fewer words the whole sequence is the one shingle. Documents of equal word sequence are
one node. Signatures of ``HASHES`` minima are cut into ``BANDS`` bands of ``ROWS``; nodes that
agree in a band are candidates. A pair at the threshold escapes all bands with a chance of
less than 1e-6.

Candidates are compared batch by batch. With m of n minima equal, the similarity has the
posterior Beta(m + 1, n - m + 1) under a flat prior; a pair is pruned as soon as its chance
to reach the threshold is below ``MISS``. Pairs that survive all batches are verified on the
full sets, so links are never wrong. Inside a bucket not all pairs are made: see
``components.link_buckets``.

Defined results: a null or wordless text has an empty set and is linked with nothing, and so
is a row without an id, whose component is null and which is kept. Rows that repeat an id are
rows of their own. Repeated texts of any number make one node.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.llm import contraction
from attemptlog.llm.common import WordHasher, constants, likely_in, map_rows, mix64, texts_of
from attemptlog.llm.components import link_buckets, smallest
from attemptlog.session import materialize

SHINGLE = 5
ROWS, BANDS = 5, 24
HASHES, BATCH = 128, 16
MISS = 1e-6
#: Shingles whose minima are taken at a time, and members of a bucket compared in a group.
CHUNK, BLOCK = 512, 1024
_MULTIPLY = constants(HASHES, 101).astype(np.uint32) | np.uint32(1)
_ADD = (constants(HASHES, 202) >> np.uint64(32)).astype(np.uint32)
_BAND = constants(ROWS, 303)


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's word hashes."""
    if not len(words):
        return words
    size = min(SHINGLE, len(words))
    count = len(words) - size + 1
    # Shorter sequences are told apart from five words by their length.
    total = np.full(count, np.uint64(size * 0x9E3779B97F4A7C15 % (1 << 64)))
    for i in range(size):
        total = mix64(total * np.uint64(0xD6E8FEB86659FD93) + words[i : i + count])
    return np.unique(total)


def signature(items: np.ndarray) -> np.ndarray:
    """Minima of ``HASHES`` multiply-add hashes of the items' upper halves."""
    upper = (items >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(upper), CHUNK):
        part = upper[None, i : i + CHUNK] * _MULTIPLY[:, None]
        part += _ADD[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return low


def bands(signatures: np.ndarray) -> np.ndarray:
    """Bucket of every band: (rows, BANDS)."""
    cut = signatures[:, : ROWS * BANDS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), cut.shape[:2]).copy()
    for i in range(ROWS):
        keys = mix64(keys * _BAND[i] + cut[:, :, i])
    return keys


def _each_set(column: pa.Array):
    """Digest halves and shingle set of every text, one at a time."""
    words, bounds = _HASHER(*texts_of(column))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own = words[a:b]
        digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
        yield np.frombuffer(digest, np.int64), shingles(own)


_HASHER = WordHasher()


def signatures(df: DataFrame, key: str, text: str) -> DataFrame:
    """doc, n1, n2 (digest of the words), n_shingles, sig, buckets; empty sets have no sig."""

    def rows(ids: pa.Array, column: pa.Array) -> dict:
        digests, sizes, sigs = [], [], []
        for digest, items in _each_set(column):
            digests.append(digest)
            sizes.append(len(items))
            sigs.append(signature(items) if len(items) and ids[len(sigs)].is_valid else None)
        some = [s for s in sigs if s is not None]
        made = iter(bands(np.array(some)).view(np.int64) if some else [])
        halves = np.array(digests, np.int64).reshape(-1, 2)
        return {
            "doc": ids,
            "n1": pa.array(np.ascontiguousarray(halves[:, 0])),
            "n2": pa.array(np.ascontiguousarray(halves[:, 1])),
            "n_shingles": pa.array(sizes, pa.int64()),
            "sig": pa.array([None if s is None else s.tobytes() for s in sigs], pa.binary()),
            "buckets": pa.array([None if s is None else next(made) for s in sigs], pa.list_(pa.int64())),
        }

    plain = df.select(F.col(f"`{key}`").cast("long").alias("d"), F.col(f"`{text}`").alias("t"))
    schema = "doc long, n1 long, n2 long, n_shingles long, sig binary, buckets array<long>"
    return map_rows(plain, ["d", "t"], schema, rows)


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(n, m) per batch: with fewer than m of n equal, P(similarity >= threshold) < miss.

    P(Beta(m + 1, n - m + 1) >= t) is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def survivors(
    x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, steps: list[tuple[int, int]]
) -> np.ndarray:
    """Positions of the pairs (x[i], y[j]) of signatures that no batch rules out."""
    alive, matches, done = np.arange(len(i)), np.zeros(len(i), np.int64), 0
    for n, least in steps:
        matches += (x[i[alive], done:n] == y[j[alive], done:n]).sum(axis=1)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], n
    return alive


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


PAIR = "a1 long, a2 long, b1 long, b2 long"
ENDS = ["a1", "a2", "b1", "b2"]


def node_signatures(signed_docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Signature and buckets of each of ``nodes``, once."""
    wanted = nodes.select("n1", "n2").distinct()
    near = likely_in(signed_docs.select("n1", "n2", "sig", "buckets"), ["n1", "n2"], wanted)
    first = [F.first(c).alias(c) for c in ("sig", "buckets")]
    return near.filter("sig IS NOT NULL").groupBy("n1", "n2").agg(*first)


def node_sets(ends: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(n1, n2, items): the full sets of the nodes in ``ends``, from their texts.

    ``nodes`` names a document of each node; its text is read again.
    """
    wanted = materialize(nodes.join(ends.select("n1", "n2").distinct(), ["n1", "n2"]), "wanted")

    def full(n1, n2, column) -> dict:
        # A repeated id may have other texts; only the node's own counts.
        ids = zip(n1.to_pylist(), n2.to_pylist())
        made = [
            items.tobytes() if tuple(digest.tolist()) == own else None
            for own, (digest, items) in zip(ids, _each_set(column))
        ]
        return {"n1": n1, "n2": n2, "items": pa.array(made, pa.binary())}

    read = likely_in(texts, ["doc"], wanted.select("doc")).join(wanted, "doc")
    sets = map_rows(read, ["n1", "n2", "text"], "n1 long, n2 long, items binary", full)
    return materialize(sets.filter("items IS NOT NULL"), "sets")


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct items."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def prune(pairs: DataFrame, signed_docs: DataFrame, threshold: float) -> DataFrame:
    """Pairs that no batch of their signatures rules out."""
    steps = least_matches(threshold)

    def rows(a1, a2, b1, b2, left, right) -> dict:
        each = np.arange(len(a1))
        take = pa.array(survivors(_matrix(left), _matrix(right), each, each, steps))
        return {"a1": a1.take(take), "a2": a2.take(take), "b1": b1.take(take), "b2": b2.take(take)}

    ends = pairs.selectExpr("a1 AS n1", "a2 AS n2").union(pairs.selectExpr("b1", "b2"))
    sigs = materialize(node_signatures(signed_docs, ends), "node-signatures")
    left = sigs.selectExpr("n1 AS a1", "n2 AS a2", "sig AS x")
    right = sigs.selectExpr("n1 AS b1", "n2 AS b2", "sig AS y")
    both = pairs.join(left, ["a1", "a2"]).join(right, ["b1", "b2"])
    return map_rows(both, [*ENDS, "x", "y"], PAIR, rows)


def settle(
    members: DataFrame, signed_docs: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int
) -> DataFrame:
    """Links that join up the different roots of each bucket, wherever its members link.

    A bucket is cut into blocks; each pair of blocks is a group of bounded size. It compares
    signatures batch by batch, then verifies the survivors on the full sets, the most alike
    first, and leaves out pairs that links found there have joined already. A pair that
    shares several buckets is compared in the first of them.
    """
    steps = least_matches(percent / 100)
    blocks = F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")
    sized = materialize(members.groupBy("bucket").agg(blocks), "bucket-blocks")
    sigs = node_signatures(signed_docs, members)
    known = materialize(sigs.join(node_sets(members, nodes, texts), ["n1", "n2"]), "open-nodes")
    own = F.pmod(F.xxhash64("n1", "n2"), F.col("blocks"))
    pair = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.struct(F.least("own", other).alias("low"), F.greatest("own", other).alias("high")),
    )
    cells = (
        members.join(sized, "bucket")
        .withColumn("own", own)
        .withColumn("cell", F.explode(pair))
        .join(known, ["n1", "n2"])
        .select("bucket", "cell.low", "cell.high", "own", "n1", "n2", "r1", "r2", "sig", "buckets", "items")
    )

    def compare(of, table):
        bucket, low, high = (v.as_py() for v in of)
        block, sig = table["own"].to_numpy(), _matrix(table["sig"])
        buckets = np.stack(table["buckets"].to_numpy())
        earlier = buckets[:, : int(np.argmax(buckets[0] == bucket))]
        names = np.stack([table["r1"].to_numpy(), table["r2"].to_numpy()], axis=1)
        root = np.unique(names, axis=0, return_inverse=True)[1].reshape(-1)
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        found = []
        for part in np.array_split(left, -(-len(left) // 128)) if len(left) else []:
            apart = root[part, None] != root[right]
            if low == high:
                apart &= part[:, None] < right
            i, j = np.nonzero(apart)
            i, j = part[i], right[j]
            keep = survivors(sig, sig, i, j, steps)
            i, j = i[keep], j[keep]
            fresh = ~(earlier[i] == earlier[j]).any(axis=1)
            i, j = i[fresh], j[fresh]
            found.append(np.stack([i, j, (sig[i] == sig[j]).sum(axis=1)]))
        pairs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        pairs = pairs[:, np.argsort(-pairs[2], kind="stable")]
        leader = list(range(int(root.max(initial=-1)) + 1))
        items = [np.frombuffer(v, np.uint64) for v in table["items"].to_pylist()] if pairs.size else []
        linked = []
        for i, j in pairs[:2].T.tolist():
            a, b = root[i], root[j]
            while leader[a] != a:
                a = leader[a]
            while leader[b] != b:
                b = leader[b]
            if a != b and alike(items[i], items[j], percent):
                leader[max(a, b)] = min(a, b)
                linked.append((i, j))
        i, j = np.array(linked, np.int64).reshape(-1, 2).T
        n1, n2 = table["n1"].to_numpy(), table["n2"].to_numpy()
        return pa.table({"a1": n1[i], "a2": n2[i], "b1": n1[j], "b2": n2[j]})

    return cells.groupBy("bucket", "low", "high").applyInArrow(compare, PAIR)


def confirm(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union on the full sets."""
    ends = pairs.selectExpr("a1 AS n1", "a2 AS n2").union(pairs.selectExpr("b1", "b2"))
    sets = node_sets(ends, nodes, texts)

    def rows(a1, a2, b1, b2, left, right) -> dict:
        of = lambda v: np.frombuffer(v.as_buffer(), np.uint64)
        keep = [at for at, (x, y) in enumerate(zip(left, right)) if alike(of(x), of(y), percent)]
        take = pa.array(keep, pa.int64())
        return {"a1": a1.take(take), "a2": a2.take(take), "b1": b1.take(take), "b2": b2.take(take)}

    left = sets.selectExpr("n1 AS a1", "n2 AS a2", "items AS x")
    right = sets.selectExpr("n1 AS b1", "n2 AS b2", "items AS y")
    both = pairs.join(left, ["a1", "a2"]).join(right, ["b1", "b2"])
    return map_rows(both, [*ENDS, "x", "y"], PAIR, rows).distinct()


def near_duplicates(df: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """Per row: key, n_shingles, component_id, kept."""
    texts = df.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    signed_docs = materialize(signatures(texts, "doc", "text"), "signatures")
    some = signed_docs.filter("sig IS NOT NULL")
    nodes = materialize(some.groupBy("n1", "n2").agg(F.min("doc").alias("doc")), "nodes")
    threshold = percent / 100

    def verify(pairs: DataFrame) -> DataFrame:
        likely = materialize(prune(pairs, signed_docs, threshold), "likely")
        return confirm(likely, nodes, texts, percent)

    members = some.select(F.explode("buckets").alias("bucket"), "n1", "n2")
    _, roots = link_buckets(
        members, verify, lambda open_: settle(open_, signed_docs, nodes, texts, percent), contraction.components
    )
    rooted = nodes.join(roots, ["n1", "n2"])
    rooted = smallest(rooted, ["r1", "r2"], "doc", "least").select("n1", "n2", "least")
    named = nodes.join(rooted, ["n1", "n2"], "left").select(
        "n1", "n2", F.coalesce("least", "doc").alias("least")
    )
    # Rows without a set meet no node, and are not sent to look for one.
    alone = signed_docs.filter("sig IS NULL").withColumn("least", F.col("doc"))
    out = some.select("doc", "n1", "n2", "n_shingles").join(materialize(named, "named"), ["n1", "n2"])
    columns = ["doc", "n_shingles", "least"]
    return out.select(columns).unionByName(alone.select(columns)).select(
        F.col("doc").alias(key), "n_shingles", F.col("least").alias("component_id"),
        F.col("doc").eqNullSafe(F.col("least")).alias("kept"),
    )
