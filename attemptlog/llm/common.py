"""Helpers of the corpus operators: table reads, Arrow batches, word hashing."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attemptlog.session import materialize

#: Bytes of text that a task turns into numpy arrays at a time.
SLICE_BYTES = 1 << 20
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds.astype(np.int64) - int(bounds[0])


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes, a longer row alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def map_rows(
    df: DataFrame, columns: list[str], schema: str, rows: Callable[..., dict]
) -> DataFrame:
    """Batches of ``columns`` through ``rows``, which returns arrays for ``schema``.

    ``rows`` gets one Arrow array per column; rows are handed over in pieces of bounded
    bytes, so that very long texts do not meet in one piece.
    """
    chosen = df.select(*columns)

    def run(batches):
        for batch in batches:
            for piece in bounded(batch):
                made = rows(*piece.columns)
                yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    return chosen.mapInArrow(run, schema)


def bounded(batch: pa.RecordBatch, size: int = 8 * SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most about ``size`` bytes, by the mean size of its rows."""
    if not batch.num_rows:
        return
    each = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
    for first in range(0, batch.num_rows, each):
        yield batch.slice(first, each)


#: Words of the bitmap below: 16 million bits, 4 MB as rows of two longs.
BITMAP_WORDS = 1 << 18


def likely_in(df: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose keys are in ``wanted``, and few others.

    A bitmap of fixed size, one bit per hash of a wanted key, is broadcast, so that the join
    that follows shuffles little of a wide table. Where it fills up it only filters less.
    """
    hashed = F.xxhash64(*keys)
    word = F.pmod(hashed, F.lit(BITMAP_WORDS)).cast("int")
    bit = F.shiftrightunsigned(hashed, 58).cast("int")
    flag = F.expr("shiftleft(1L, _bit)")
    bitmap = (
        wanted.select(word.alias("_word"), bit.alias("_bit"))
        .groupBy("_word")
        .agg(F.bit_or(flag).alias("_bits"))
    )
    marked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), word.alias("_word"),
                       bit.alias("_bit"))
    found = marked.join(F.broadcast(bitmap), "_word").filter(flag.bitwiseAND(F.col("_bits")) != 0)
    return found.select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def written(df: DataFrame, name: str) -> DataFrame:
    """``materialize``, then let go of the shuffle files that the writing needed.

    Spark removes them when the driver has collected the frames; a driver with a large heap
    may not do so for long. What has just ended may still be in use for a moment, hence the second time.
    """
    out = materialize(df, name)
    for _ in range(2):
        gc.collect()
        df.sparkSession._jvm.System.gc()
        time.sleep(0.2)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_STEP) + np.uint64(seed)
    return mix64(steps) | np.uint64(1)


class WordHasher:
    """64-bit hashes of all words (runs without ASCII white space) of texts, in order.

    A-Z count as a-z. A word's hash sums a random number per byte times a power of an
    odd base, taken from running sums, so no word becomes a Python object. Two different
    words have equal hashes with a chance of about 2**-60.
    """

    def __init__(self, seed: int = 17):
        values = constants(256, seed)
        values[65:91] = values[97:123]
        self.values = values
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.base = int(constants(1, seed + 1)[0]) | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                table = np.full(n, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def _segment(self, data: np.ndarray, starts_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        self._reach(n)
        word = ~self.space[data]
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = word[:-1]
        before[starts_at[starts_at < n]] = False
        first = np.flatnonzero(word & ~before)
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = word[1:]
        cut = starts_at[(starts_at > 0) & (starts_at <= n)] - 1
        after[cut] = False
        last = np.flatnonzero(word & ~after) + 1
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.values[data] * self.powers[:n], out=sums[1:])
        return mix64((sums[last] - sums[first]) * self.inverses[first]), first

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and the offsets of the rows in them."""
        parts, counts = [], np.zeros(len(offsets) - 1, np.int64)
        for a, b in slices(offsets):
            low, high = int(offsets[a]), int(offsets[b])
            while low < high:
                # Only a single long row is cut, at white space.
                end = high if high - low <= SLICE_BYTES or b > a + 1 else self._cut(data, low, high)
                hashes, first = self._segment(data[low:end], offsets[a : b + 1] - low)
                parts.append(hashes)
                rows = np.searchsorted(offsets[a + 1 : b], first + low, "right")
                counts[a:b] += np.bincount(rows, minlength=b - a)
                low = end
        bounds = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=bounds[1:])
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), bounds

    def _cut(self, data: np.ndarray, low: int, high: int) -> int:
        at = low + SLICE_BYTES
        while at < high:
            gaps = np.flatnonzero(self.space[data[at : at + SLICE_BYTES]])
            if len(gaps):
                return at + int(gaps[0])
            at += SLICE_BYTES
        return high


def signed(x: np.ndarray) -> pa.Array:
    """64-bit patterns as a column of longs."""
    return pa.array(x.view(np.int64))
