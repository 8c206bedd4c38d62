"""Quality classifier by co-training (operator 5).

Two views of a document: its text content (shares of bytes and hashed byte pairs, letter
case, repeated words) and its page metadata (source, language, length, and the page's layout:
lines, their lengths, blank and repeated ones). A logistic classifier is fitted to each view
on labelled documents. In every round both classifiers score all other documents, in tasks, and
each hands the labels it is most confident of to the other, which is fitted again. At the end both
views are calibrated, and combined, on labelled documents that no classifier was fitted on, and
the combination scores all documents. The sample of labels has at most so many of each kind; for
calibration they are weighted by kind, so that its rate is that of all usable labels.

What reaches the driver is bounded: features of at most ``LABELLED`` labelled documents, the first by a
hash of their id, and of ``HANDED`` documents, or fewer, a round and classifier; an id that several rows share
sends one of them. All rows are scored, in every round and at the end, by their whole texts.

Defined results: a null or blank text scores 0 and is rejected. Labels that contradict each
other, and null labels, teach nothing. Without labels of both kinds every other document
scores 1. Null metadata is a value of its own. Each row gives one row; repeated and null ids
are scored like others.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from attemptlog.llm.common import bounded, likely_in, slices, texts_of
from attemptlog.session import materialize

LABELLED, HANDED = 4096, 256
#: Of fewer documents than SHARE times HANDED one in SHARE is handed over in a round.
SHARE = 64
ROUNDS, HELD = 3, 5
#: A classifier is sure of a label beyond this many logits.
SURE = 2.0
#: Parts of the documents that are ranked on their own before all are.
PARTS = 32
KEEP = 0.5
#: Bytes of rows that a task makes views of at a time. Text views are made of an eighth of it, in arrays of longs.
PIECE = 1 << 21
PAIRS, SOURCES, LANGS, LENGTHS = 512, 64, 16, 24
TEXT_SIZE, PAGE_SIZE = 128 + PAIRS + 6, SOURCES + LANGS + LENGTHS + 6
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _shares(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text view of a slice of rows, and whether a row has any word."""
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(offsets))
    size = np.maximum(np.diff(offsets), 1)[:, None]
    out = np.zeros((rows, TEXT_SIZE), np.float32)
    small = np.minimum(data, 127).astype(np.int64)
    out[:, :128] = np.bincount(row * 128 + small, minlength=rows * 128).reshape(rows, 128)
    pair = (data[:-1].astype(np.int64) * 131 + data[1:]) * 2654435761 % (1 << 32) * PAIRS >> 32
    same = row[:-1] == row[1:]
    counted = np.bincount(row[:-1][same] * PAIRS + pair[same], minlength=rows * PAIRS)
    out[:, 128 : 128 + PAIRS] = counted.reshape(rows, PAIRS)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (row[1:] != row[:-1])
    total = lambda flags: np.bincount(row[flags], minlength=rows)
    words = total(begins)
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    digit = (data >= 48) & (data <= 57)
    mark = inside & ~upper & ~lower & ~digit & (data < 128)
    out /= np.sqrt(size)  # shares, on a scale where rare bytes still count
    out /= np.sqrt(size)
    np.sqrt(out, out=out)
    letters = np.maximum(total(upper) + total(lower), 1)
    some = np.maximum(words, 1)
    stats = [total(upper) / letters, total(digit) / size[:, 0], total(mark) / size[:, 0],
             total(inside) / some / 10, total(mark) / some, total(data >= 128) / size[:, 0]]
    out[:, 128 + PAIRS :] = np.stack(stats, axis=1)
    return out, words > 0


def text_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = texts_of(column)
    parts = [_shares(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets, PIECE // 8)]
    if not parts:
        return np.zeros((0, TEXT_SIZE), np.float32), np.zeros(0, bool)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def page_view(text: pa.Array, source: pa.Array, lang: pa.Array, length: pa.Array) -> np.ndarray:
    rows = len(text)
    out = np.zeros((rows, PAGE_SIZE), np.float32)
    at = np.arange(rows)
    bucket = lambda v, n: 0 if v is None else 1 + zlib.crc32(str(v).encode()) % (n - 1)
    out[at, [bucket(v, SOURCES) for v in source.to_pylist()]] = 1
    out[at, [SOURCES + bucket(v, LANGS) for v in lang.to_pylist()]] = 1
    size = [0 if v is None else 1 + min(LENGTHS - 2, max(0, int(v)).bit_length()) for v in length.to_pylist()]
    out[at, [SOURCES + LANGS + v for v in size]] = 1
    for i, body in enumerate(text.to_pylist()):
        lines = (body or "").split("\n")
        lengths = np.array([len(x) for x in lines])
        full = max(1, int((lengths > 0).sum()))
        out[i, SOURCES + LANGS + LENGTHS :] = (
            np.log1p(len(lines)) / 5,
            np.log1p(lengths.sum() / full) / 7,
            np.log1p(lengths.max()) / 10,
            (lengths == 0).mean(),
            1 - len(set(lines)) / len(lines),
            lengths.std() / (lengths.mean() + 1) / 3,
        )
    return out


class Logistic:
    """Logistic regression on standardised features, by Newton-like steps with momentum."""

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 300, decay: float = 1e-3) -> Logistic:
        self.mean = x.mean(axis=0)
        self.scale = np.maximum(x.std(axis=0), 0.02)
        z = (x - self.mean) / self.scale
        # Both kinds weigh the same while fitting; calibration restores their rates.
        weight = np.where(y, 0.5 / max(y.sum(), 1), 0.5 / max((~y).sum(), 1))
        w, b, v, vb = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1]), 0.0
        rate = 4.0 / max(1.0, float((weight[:, None] * z**2).sum()))
        for _ in range(steps):
            miss = weight * (1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30))) - y)
            v = 0.9 * v - rate * (z.T @ miss + decay * w)
            vb = 0.9 * vb - 0.5 * miss.sum()
            w, b = w + v, b + vb
        self.w, self.b = w, b
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.w + self.b, -30, 30)


def calibrate(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Non-negative weights of the views' logits and a bias, by likelihood of weighted rows."""
    weight = weight / weight.sum()
    n = logits.shape[1]
    w, b = np.full(n, 1.0 / n), 0.0
    # Targets short of 0 and 1, so that separable labels keep finite weights.
    good, bad = y.sum(), (~y).sum()
    target = np.where(y, (good + 1) / (good + 2), 1 / (bad + 2))
    for _ in range(2000):
        miss = 1 / (1 + np.exp(-(logits @ w + b))) - target
        w = np.maximum(w - 0.02 * (logits.T @ (weight * miss)), 0)
        b -= 0.1 * (weight * miss).sum()
    return w, b


@dataclass
class Picked:
    """Documents that a classifier is sure of: both views of each, and its label."""

    views: list[np.ndarray]
    labels: np.ndarray


def most(kind: bool, rate: float, documents: int) -> int:
    """How many labels of a kind a classifier hands over in a round, by the rate of good ones."""
    return int(round(min(HANDED, documents // SHARE) * (rate if kind else 1 - rate)))


class Unlabelled:
    """Documents held as arrays; ``Documents`` does the same in tasks."""

    def __init__(self, views: list[np.ndarray]):
        self.views, self.free = views, [np.ones(len(views[0]), bool) for _ in views]

    def pick(self, models: list[Logistic], rate: float) -> list[Picked]:
        """Per classifier the documents whose labels it hands over, which the other never got before."""
        out = []
        for i, model in enumerate(models):
            logits = model.logits(self.views[i])
            rows, labels = [], []
            for kind in (False, True):
                sure = logits if kind else -logits
                open_ = np.flatnonzero(self.free[i] & (sure > SURE))
                best = open_[np.argsort(-sure[open_], kind="stable")][: most(kind, rate, len(logits))]
                rows.append(best)
                labels.append(np.full(len(best), kind))
            rows = np.concatenate(rows)
            self.free[i][rows] = False
            out.append(Picked([v[rows] for v in self.views], np.concatenate(labels)))
        return out


class CoTrained:
    """Both views' classifiers and the calibrated combination.

    ``pool`` has the other documents: arrays, or something that picks. ``weight`` has, per label,
    how many usable labels of its kind it stands for.
    """

    def __init__(self, views: list[np.ndarray], y: np.ndarray, pool, weight: np.ndarray | None = None):
        pool = Unlabelled(pool) if isinstance(pool, list) else pool
        weight = np.ones(len(y)) if weight is None else weight
        held = np.zeros(len(y), bool)
        for kind in (True, False):
            held[np.flatnonzero(y == kind)[::HELD]] = True
        if min(y[held].sum(), (~y[held]).sum(), y[~held].sum(), (~y[~held]).sum()) < 1:
            held[:] = False  # too few to set any aside
        own = [[v[~held]] for v in views]
        labels = [[y[~held]], [y[~held]]]
        rate = np.average(y, weights=weight)
        fit = lambda i: Logistic().fit(np.concatenate(own[i]), np.concatenate(labels[i]))
        models = [fit(0), fit(1)]
        for _ in range(ROUNDS):
            for i, picked in enumerate(pool.pick(models, rate)):
                own[1 - i].append(picked.views[1 - i])
                labels[1 - i].append(picked.labels)
            models = [fit(0), fit(1)]
        use = held if held.any() else ~held
        logits = np.stack([m.logits(v[use]) for m, v in zip(models, views)], axis=1)
        self.models = models
        self.single = [calibrate(logits[:, i : i + 1], y[use], weight[use]) for i in (0, 1)]
        self.joint = calibrate(logits, y[use], weight[use])

    def scores(self, views: list[np.ndarray]) -> list[np.ndarray]:
        """Calibrated probabilities of good quality: text, page, both."""
        logits = np.stack([m.logits(v) for m, v in zip(self.models, views)], axis=1)
        squash = lambda x, w, b: 1 / (1 + np.exp(-(x @ w + b)))
        return [*(squash(logits[:, i : i + 1], *self.single[i]) for i in (0, 1)), squash(logits, *self.joint)]


def _plain(docs: DataFrame, key: str) -> DataFrame:
    """doc, text, source, lang, length; metadata columns may be missing."""
    columns = {"source": "source", "lang": "lang", "n_chars": "length"}
    given = [
        (F.col(f"`{c}`") if c in docs.columns else F.lit(None)).cast("long" if c == "n_chars" else "string").alias(n)
        for c, n in columns.items()
    ]
    return docs.select(F.col(f"`{key}`").alias("doc"), F.col("text"), *given)


def _views(batch) -> tuple[list[np.ndarray], np.ndarray]:
    text, some = text_view(batch["text"])
    return [text, page_view(*(batch[c] for c in ("text", "source", "lang", "length")))], some


def _packed(matrix: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in matrix.astype(np.float16)]


def _unpacked(table: pa.Table, column: str, width: int) -> np.ndarray:
    rows = [np.frombuffer(v, np.float16) for v in table[column].to_pylist()]
    return np.array(rows, np.float32).reshape(len(rows), width)


def _sampled(plain: DataFrame, ids: DataFrame) -> pa.Table:
    """Features of one row of each document named in ``ids``, a table of bounded size."""

    def run(batches):
        # At most as many as there are ids.
        first: dict = {}
        for batch in batches:
            for piece in bounded(batch, PIECE):
                (text, page), some = _views(piece)
                for doc, t, p, has in zip(piece["doc"].to_pylist(), _packed(text), _packed(page), some):
                    if has and (doc not in first or (t, p) < first[doc]):
                        first[doc] = t, p
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(first), kind), *[pa.array([v[i] for v in first.values()], pa.binary()) for i in (0, 1)]],
            names=["doc", "t", "p"],
        )

    near = likely_in(plain.filter("doc IS NOT NULL"), ["doc"], ids.select("doc"))
    chosen = near.join(F.broadcast(ids), "doc", "left_semi").select("doc", "text", "source", "lang", "length")
    kind = to_arrow_type(chosen.schema["doc"].dataType)
    made = chosen.mapInArrow(run, f"doc {dict(plain.dtypes)['doc']}, t binary, p binary")
    made = made.groupBy("doc").agg(F.min(F.struct("t", "p")).alias("v")).select("doc", "v.t", "v.p")
    return made.orderBy(F.xxhash64("doc"), "doc").toArrow()


class Documents:
    """All documents but some, scored in tasks."""

    def __init__(self, plain: DataFrame, known: set):
        self.plain = plain.filter("doc IS NOT NULL")
        self.gone = [set(known), set(known)]
        self.documents = max(0, self.plain.count() - len(known))

    def pick(self, models: list[Logistic], rate: float) -> list[Picked]:
        """As ``Unlabelled.pick``; of an id that several rows share the surest row counts.

        A task keeps no more than may be handed over, and so do parts of all documents, so that
        the last ranking has few rows. Of equally sure ones the first by a hash of the id come first.
        """
        gone = self.gone
        numbers = {(i, kind): most(kind, rate, self.documents) for i in (0, 1) for kind in (False, True)}

        def run(batches):
            best: dict[tuple, dict] = {key: {} for key in numbers}
            for batch in batches:
                for piece in bounded(batch, PIECE):
                    views, some = _views(piece)
                    docs = piece["doc"].to_pylist()
                    for i, model in enumerate(models):
                        logits = model.logits(views[i])
                        for kind in (False, True):
                            sure = logits if kind else -logits
                            held = best[i, kind]
                            for at in np.flatnonzero(some & (sure > SURE)).tolist():
                                doc = docs[at]
                                row = (-float(sure[at]), zlib.crc32(str(doc).encode()), *(views[v][at].astype(np.float16).tobytes() for v in (0, 1)))
                                if doc not in gone[i] and (doc not in held or row < held[doc]):
                                    held[doc] = row
                            n = numbers[i, kind]
                            if len(held) > 2 * n:
                                best[i, kind] = dict(sorted(held.items(), key=lambda x: (x[1][:2], str(x[0])))[:n])
            rows = [(i, kind, doc, *row) for (i, kind), held in best.items() for doc, row in held.items()]
            columns = list(zip(*rows)) if rows else [()] * 7
            types = [pa.int32(), pa.bool_(), doc_type, pa.float64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

        names = ["view", "good", "doc", "doubt", "tie", "t", "p"]
        doc_type = to_arrow_type(self.plain.schema["doc"].dataType)
        kind = dict(self.plain.dtypes)["doc"]
        schema = f"view int, good boolean, doc {kind}, doubt double, tie long, t binary, p binary"
        found = self.plain.select("doc", "text", "source", "lang", "length").mapInArrow(run, schema)
        found = found.groupBy("view", "good", "doc").agg(F.min(F.struct("doubt", "tie", "t", "p")).alias("v"))
        found = found.select("view", "good", "doc", "v.*", F.pmod("v.tie", F.lit(PARTS)).alias("part"))
        limit = F.lit(0)
        for (i, good), n in numbers.items():
            limit = F.when((F.col("view") == i) & (F.col("good") == good), n).otherwise(limit)
        for group in (["view", "good", "part"], ["view", "good"]):
            order = Window.partitionBy(*group).orderBy("doubt", "tie", F.col("doc").cast("string"))
            found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= HANDED)
        table = found.filter(F.col("rank") <= limit).orderBy("view", "good", "rank").toArrow()
        out = []
        view = np.array(table["view"].to_pylist(), int)
        for i in (0, 1):
            own = table.filter(pa.array(view == i))
            self.gone[i] |= set(own["doc"].to_pylist())
            views = [_unpacked(own, c, n) for c, n in (("t", TEXT_SIZE), ("p", PAGE_SIZE))]
            out.append(Picked(views, np.array(own["good"].to_pylist(), bool)))
        return out


def train(docs: DataFrame, key: str, labels: DataFrame, label_key: str, label: str) -> CoTrained | None:
    """Classifiers fitted on a bounded sample, or None without labels of both kinds."""
    plain = _plain(docs, key)
    first = lambda df, n: df.orderBy(F.xxhash64("doc"), "doc").limit(n)
    told = (
        labels.select(F.col(label_key).alias("doc"), (F.col(label) > 0).alias("good"))
        .filter("doc IS NOT NULL AND good IS NOT NULL")
        .groupBy("doc")
        .agg(F.min("good").alias("good"), F.max("good").alias("most"))
        .filter("good = most")
        .select("doc", "good")
    )
    told = told.join(plain.select("doc"), "doc", "left_semi")
    # Labels first: a bounded sample of each kind, so that a rare kind is not lost.
    told = materialize(told, "labels-told")
    known = first(told.filter("good"), LABELLED * 3 // 4).unionByName(first(told.filter("NOT good"), LABELLED // 4))
    known = known.toArrow()
    # What a label of the sample stands for, so that the sample has the rate of all labels.
    usable = {r["good"]: r["count"] for r in told.groupBy("good").count().collect()}
    taken = np.array(known["good"].to_pylist(), bool)
    stands = {kind: usable.get(kind, 0) / max(int((taken == kind).sum()), 1) for kind in (True, False)}
    known = docs.sparkSession.createDataFrame(known)
    sample = _sampled(plain, known)
    good = {r["doc"]: r["good"] for r in known.collect()}
    y = np.array([good[d] for d in sample["doc"].to_pylist()], bool)
    if not y.any() or y.all():
        return None
    weight = np.where(y, stands[True], stands[False])
    views = [_unpacked(sample, c, n) for c, n in (("t", TEXT_SIZE), ("p", PAGE_SIZE))]
    return CoTrained(views, y, Documents(plain, set(good)), weight)


def classify(docs: DataFrame, key: str, labels: DataFrame, label_key: str, label: str) -> DataFrame:
    """Per row: key, text_score, page_score, score (0 to 1, good quality), kept."""
    plain = _plain(docs, key)
    return _scored(plain, train(docs, key, labels, label_key, label)).withColumnRenamed("doc", key)


def _scored(plain: DataFrame, model: CoTrained | None) -> DataFrame:
    def run(batches):
        for batch in batches:
            for piece in bounded(batch, PIECE):
                views, some = _views(piece)
                made = model.scores(views) if model else [np.ones(len(some))] * 3
                made = [np.where(some, m, 0.0) for m in made]
                yield pa.RecordBatch.from_arrays(
                    [piece["doc"], *map(pa.array, made), pa.array(some & (made[2] >= KEEP))],
                    names=["doc", "text_score", "page_score", "score", "kept"],
                )

    kind = dict(plain.dtypes)["doc"]
    return plain.mapInArrow(
        run, f"doc {kind}, text_score double, page_score double, score double, kept boolean"
    )


def accepted(docs: DataFrame, key: str, labels: DataFrame, label_key: str, label: str) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns as they are."""
    model = train(docs, key, labels, label_key, label)
    names = docs.columns
    shaped = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    at = {c: f"c{i}" for i, c in enumerate(names)}

    def run(batches):
        for batch in batches:
            for piece in bounded(batch, PIECE):
                empty = pa.nulls(piece.num_rows, pa.string())
                get = lambda c: piece[at[c]] if c in at else empty  # noqa: E731, B023
                text, some = text_view(get("text"))
                page = page_view(get("text"), get("source"), get("lang"), get("n_chars"))
                good = model.scores([text, page])[2] >= KEEP if model else np.ones(len(some), bool)
                yield piece.filter(pa.array(some & good))

    out = shaped.mapInArrow(run, shaped.schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
