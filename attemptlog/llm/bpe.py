"""Byte-level BPE encoding and decoding (operator 4).

A text is cut by the tokenizer's pattern; inside each piece the pair of neighbouring parts
with the lowest rank merges first, the leftmost of equals. A segment tree over the piece's
byte positions stores the lowest pair rank below every node, so finding the leftmost
minimum and the three point updates of a merge take logarithmic time, and a piece of a
hundred thousand letters is no special case.

Defined results: a null or empty text has no ids and decodes to no bytes; null ids decode to
no bytes. Only the columns asked for are read, so further columns and repeated or missing
row ids do not matter: one row out for each row in.
"""

from __future__ import annotations

import base64
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.llm.common import map_rows

NO_PAIR = 1 << 60
#: Pieces a worker remembers in each of two generations; results do not depend on it.
REMEMBERED = 250_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file (base64, blank, rank on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}


class PairTree:
    """Lowest pair rank over byte positions; ties go to the left."""

    def __init__(self, ranks: list[int]):
        size = 1
        while size < len(ranks):
            size *= 2
        self.size = size
        self.tree = tree = [NO_PAIR] * size + ranks + [NO_PAIR] * (size - len(ranks))
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left <= right else right

    def put(self, at: int, rank: int) -> None:
        tree, node = self.tree, at + self.size
        tree[node] = rank
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            low = left if left <= right else right
            if tree[node] == low:
                return
            tree[node] = low
            node >>= 1

    def leftmost(self) -> int:
        """Position of the lowest rank, or -1 if no pair is left."""
        tree, node = self.tree, 1
        low = tree[1]
        if low == NO_PAIR:
            return -1
        while node < self.size:
            node *= 2
            if tree[node] != low:
                node += 1
        return node - self.size


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    get = ranks.get
    tree = PairTree([get(piece[i : i + 2], NO_PAIR) for i in range(n - 1)] + [NO_PAIR])
    end = list(range(1, n + 1))  # of the live part that starts at a position
    start = list(range(-1, n - 1))  # of the live part before it
    while (at := tree.leftmost()) >= 0:
        gone = end[at]
        end[at] = stop = end[gone]
        tree.put(gone, NO_PAIR)
        if stop < n:
            start[stop] = at
            tree.put(at, get(piece[at : end[stop]], NO_PAIR))
        else:
            tree.put(at, NO_PAIR)
        if (before := start[at]) >= 0:
            tree.put(before, get(piece[before:stop], NO_PAIR))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


class Pieces(dict):
    """Piece to its ids as int32 bytes, merged when first met.

    A full generation becomes the old one, and pieces still in use come back from it, so
    that frequent pieces outlive the many that occur once.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("i", merge(piece.encode(), self.ranks)).tobytes()
        if len(ids) < 400:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Tokenizer:
    """Ranks and pattern, sent to the workers with their tables built on arrival."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern

    def __reduce__(self):
        return _on_worker, (self.ranks, self.pattern)

    def prepare(self) -> Tokenizer:
        self.pieces = Pieces(self.ranks)
        self.find = regex.compile(self.pattern).findall
        top = max(self.ranks.values(), default=-1) + 1
        tokens = [b""] * top
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.firsts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.known = np.zeros(top, bool)
        self.known[list(self.ranks.values())] = True
        return self

    def ids(self, text: str | None) -> np.ndarray:
        piece = self.pieces.__getitem__
        return np.frombuffer(b"".join(map(piece, self.find(text))) if text else b"", np.int32)

    def text(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a run of ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id that the vocabulary does not have")
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.firsts[ids] - (ends - lengths), lengths)
        return self.bytes[np.arange(len(shift)) + shift]


_READY: dict = {}


def _on_worker(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    key = (len(ranks), hash(frozenset(ranks.items())), pattern)
    if key not in _READY:
        _READY.clear()
        _READY[key] = Tokenizer(ranks, pattern).prepare()
    return _READY[key]


def _lists(ids: list[np.ndarray]) -> pa.Array:
    bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, pa.int32()))


def encode(df: DataFrame, keep: list[str], text: str, path: str, pattern: str) -> DataFrame:
    """Columns ``keep`` and ``ids`` (array of int) of every row's whole ``text``."""
    tokenizer = Tokenizer(load_ranks(path), pattern)

    def rows(column: pa.Array, *kept: pa.Array) -> dict:
        ids = [tokenizer.ids(t) for t in column.to_pylist()]
        return {f"k{i}": k for i, k in enumerate(kept)} | {"ids": _lists(ids)}

    return _run(df, [text, *keep], keep, "ids array<int>", rows)


def decode(df: DataFrame, keep: list[str], ids: str, path: str) -> DataFrame:
    """Columns ``keep`` and ``decoded`` (binary) of every row's ``ids``."""
    tokenizer = Tokenizer(load_ranks(path), "")

    def rows(column: pa.Array, *kept: pa.Array) -> dict:
        lists = [np.asarray(x.values, np.int64) if x.is_valid else [] for x in column]
        out = [tokenizer.text(np.asarray(x, np.int64)).tobytes() for x in lists]
        return {f"k{i}": k for i, k in enumerate(kept)} | {"decoded": pa.array(out, pa.binary())}

    return _run(df, [ids, *keep], keep, "decoded binary", rows)


def _run(df, columns, keep, made, rows) -> DataFrame:
    types = dict(df.dtypes)
    named = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    fields = [f"k{i} {types[c]}" for i, c in enumerate(keep)]
    out = map_rows(
        df.select(*named), [f"c{i}" for i in range(len(columns))], ", ".join([*fields, made]), rows
    )
    results = [field.split()[0] for field in made.split(", ")]
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *results)


def round_trip(df: DataFrame, key: str, text: str, path: str, pattern: str) -> DataFrame:
    """Per row: key, ``ids`` of the text and ``decoded`` bytes of the ids.

    As ``encode`` and then ``decode``, in one step: two would need two Python workers in every task.
    """
    tokenizer = Tokenizer(load_ranks(path), pattern)

    def rows(column: pa.Array, *kept: pa.Array) -> dict:
        ids = [tokenizer.ids(t) for t in column.to_pylist()]
        decoded = pa.array([tokenizer.text(x.astype(np.int64)).tobytes() for x in ids], pa.binary())
        return {f"k{i}": k for i, k in enumerate(kept)} | {"ids": _lists(ids), "decoded": decoded}

    return _run(df, [text, key], [key], "ids array<int>, decoded binary", rows)


def digests(
    df: DataFrame, key: str, text: str, path: str, pattern: str, keep_ids: bool = False
) -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256, and the ids if they are to be kept."""
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return round_trip(df, key, text, path, pattern).select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *(["ids"] if keep_ids else []),
    )
