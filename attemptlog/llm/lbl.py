"""Scoring with a log-bilinear neural language model (operator 6).

Words (A-Z as a-z) are counted over all training texts. The model has tables of fixed size: a row for
each of the ``WORDS`` most frequent words, one for the end of a text, and ``GROUPS`` rows that all other
words share by hash, unseen ones included. It predicts a word from the two before it: the
context vector is a weighted sum of their vectors, an outcome's score its product with the outcome's
vector plus a bias. It is trained with noise-contrastive estimation on all training texts: in
each of ``ROUNDS`` rounds every task starts from the same parameters, makes one pass over its
texts in mini-batches, and hands back its parameters, which are averaged as a tree, by tokens. The
tokens of a mini-batch share their noise; ``TOGETHER`` of them change the parameters at once.

Token log-probabilities are normalised in two levels: outcomes are in classes, of neighbours by
frequency, which are trained as outcomes of their own; an outcome's probability is that of its class
among the classes times its own among the members of the class, by batched matrix products. Classes
hold a sum of 1 of square roots of frequencies, which makes the fewest products. A context's score of a
class is a sum over its two words, so the exponentials are products from two tables, made once a task. A word of a group
has the probability of the group times its share (count + 1) in it, one share standing for
unseen words.

The counts of the ``KNOWN`` most frequent words go to the tasks as arrays; counts of rarer words
are joined by shuffles. Words are 64-bit hashes throughout.

Defined results: a null or empty text has one token, its end. Rows without an id are not held
out; each row gives one row, repeated ids included. Without training texts every token is
unseen: the base score is 0 per token (1 of 1), the model is untrained but normalised.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attemptlog.llm.common import WordHasher, bounded, texts_of, written
from attemptlog.session import materialize

WORDS, GROUPS, KNOWN = 1 << 14, 1 << 12, 1 << 18
#: A word needs so many occurrences for a row of its own.
LEAST = 5
#: Ids: the end of a text, then the words, then the groups.
END, FIRST = 0, 1
#: The end of a text among the word hashes.
END_HASH = 1
SIZE, BATCH, NOISE, ROUNDS, RATE, FAN = 16, 256, 32, 1, 0.1, 8
#: Mini-batches, each with noise of its own, that change the parameters at once.
TOGETHER = 4
#: Sums of exponentials that a float holds with all its digits; others are taken anew, from their largest.
HELD_SUMS = (1e-30, 1e30)
#: Scores that are worked out at a time.
CELLS = 1 << 17
#: Distinct words a task holds before it writes counts out.
HELD = 1 << 21
_HASHER = WordHasher()


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, and the texts' offsets."""
    words, bounds = _HASHER(*texts_of(column))
    rows = np.arange(len(bounds) - 1)
    out = np.full(len(words) + len(rows), END_HASH, np.uint64)
    place = np.arange(len(words)) + np.repeat(rows, np.diff(bounds))
    out[place] = words
    return out, bounds + np.arange(len(bounds))


def held_out(key: Column) -> Column:
    remainder = F.crc32(key.cast("string").cast("binary")) % 7
    return F.coalesce(remainder == 2, F.lit(False))


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) of all training tokens."""

    def run(batches):
        held, size = [], 0
        pack = lambda h, n: pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(n)], names=["word", "n"]
        )

        def summed(parts):
            words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return words, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)

        for batch in batches:
            for piece in bounded(batch):
                found, n = np.unique(tokens(piece["text"])[0], return_counts=True)
                held.append((found, n))
                size += len(found)
                if size > HELD:
                    held = [summed(held)]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield pack(*held[0])
                        held, size = [], 0
        if held:
            yield pack(*summed(held))

    made = training.select("text").mapInArrow(run, "word long, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n"))


def group_of(hashes: np.ndarray, groups: int) -> np.ndarray:
    """The group that a word is in unless it has a row of its own."""
    return (hashes >> np.uint64(24)).astype(np.int64) % groups


class Known:
    """Counts of the most frequent words, by hash, and the model's id of the first ones."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        words = words.view(np.uint64)
        order = np.lexsort((words, -counts))
        ids = np.full(len(words), -1, np.int32)
        frequent = order[(words[order] != END_HASH) & (counts[order] >= LEAST)][:WORDS]
        ids[frequent] = np.arange(FIRST, FIRST + len(frequent))
        by = np.argsort(words)
        self.words, self.counts, self.ids = words[by], counts[by], ids[by]
        small = np.flatnonzero(self.ids >= 0)
        self.model_words, self.model_ids = self.words[small], self.ids[small]
        #: The first group's id, and how many there are.
        self.groups, self.n_groups = FIRST + len(frequent), GROUPS

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Position of each word, -1 where it is not known."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def model(self, hashes: np.ndarray) -> np.ndarray:
        """The model's ids."""
        ids = self.groups + group_of(hashes, self.n_groups)
        if len(self.model_words):
            at = np.minimum(np.searchsorted(self.model_words, hashes), len(self.model_words) - 1)
            ids = np.where(self.model_words[at] == hashes, self.model_ids[at], ids)
        return np.where(hashes == END_HASH, END, ids)


def most_frequent(counts: DataFrame) -> Known:
    """``KNOWN`` words or fewer; a histogram finds the count above which they are."""
    step = F.floor(F.log2("n") * 16).cast("int")
    histogram = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    least, words = None, 0
    for row in sorted(histogram, key=lambda r: -r["step"]):
        words += row["words"]
        if words > KNOWN:
            break
        least = row["step"]
    if least is None:
        return Known(np.zeros(0, np.int64), np.zeros(0, np.int64))
    top = counts.filter(step >= least).select("word", "n").toArrow()
    return Known(top["word"].to_numpy(), top["n"].to_numpy())


def group_counts(counts: DataFrame, known: Known) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and words of each group, without the words that have a row of their own."""
    group = F.pmod(F.shiftrightunsigned("word", 24), F.lit(GROUPS)).alias("g")
    every = counts.filter(F.col("word") != END_HASH).groupBy(group)
    table = every.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).toArrow()
    out = []
    own = known.ids >= 0
    for name, less in (("n", known.counts[own]), ("words", np.ones(int(own.sum()), np.int64))):
        total = np.zeros(GROUPS, np.int64)
        total[table["g"].to_numpy()] = table[name].to_numpy()
        out.append(total - np.bincount(group_of(known.words[own], GROUPS), less, GROUPS).astype(np.int64))
    return out[0], out[1]


class Model:
    """Input vectors, output vectors with their biases, and the weights of the two context places.

    Outputs are the words and after them their classes, which are ranges of words.
    """

    def __init__(self, unigram: np.ndarray, classes: bool = False):
        rng = np.random.default_rng(7)
        self.n = n = len(unigram)
        self.noise = unigram
        self.class_of = self.first = self.tables = None
        if classes:
            room = np.floor(np.cumsum(np.sqrt(unigram)))
            self.first = np.flatnonzero(np.diff(room, prepend=-1.0))
            self.class_of = np.repeat(np.arange(len(self.first)), np.diff(self.first, append=n))
            self.noise = np.concatenate([unigram, np.add.reduceat(unigram, self.first)])
        self.r = (rng.normal(size=(n, SIZE)) * 0.1).astype(np.float32)
        vectors = rng.normal(size=(len(self.noise), SIZE)) * 0.1
        self.o = np.concatenate([vectors, np.log(self.noise)[:, None]], axis=1).astype(np.float32)
        self.c = np.array([[1.0], [0.5]], np.float32) * np.ones((2, SIZE), np.float32)

    @property
    def q(self) -> np.ndarray:
        return self.o[:, :SIZE]

    @q.setter
    def q(self, vectors: np.ndarray) -> None:
        self.o[:, :SIZE] = vectors

    @property
    def b(self) -> np.ndarray:
        return self.o[:, SIZE]

    def get(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in (self.r, self.o, self.c)])

    def put(self, flat: np.ndarray) -> Model:
        at = 0
        for name in ("r", "o", "c"):
            shape = getattr(self, name).shape
            n = int(np.prod(shape))
            setattr(self, name, flat[at : at + n].reshape(shape).astype(np.float32))
            at += n
        return self

    def context(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.r.take(one, axis=0) * self.c[0] + self.r.take(two, axis=0) * self.c[1]

    def biased(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Context vectors and a 1, which the bias is multiplied by."""
        h = np.ones((len(one), SIZE + 1), np.float32)
        h[:, :SIZE] = self.context(one, two)
        return h

    def sums(self, h: np.ndarray, low: int, high: int) -> np.ndarray:
        """Logarithm of the sum over a range of outputs, for every context vector with its 1."""
        outputs = np.ascontiguousarray(self.o[low:high].T)
        out = np.empty(len(h))
        for i in range(0, len(h), step := max(256, CELLS // (high - low))):
            part = h[i : i + step]
            scored = part @ outputs
            with np.errstate(over="ignore"):
                total = np.exp(scored, out=scored) @ np.ones(high - low, np.float32)
            far = np.flatnonzero(~((total > HELD_SUMS[0]) & (total < HELD_SUMS[1])))
            total[far] = 1
            out[i : i + step] = np.log(total)
            if len(far):
                scored = part[far] @ outputs
                top = scored.max(axis=1)
                scored -= top[:, None]
                out[i + far] = np.log(np.exp(scored).sum(axis=1)) + top
        return out

    def normalisers(self) -> np.ndarray:
        """Logarithm of the sum over all words, for every context (one, two)."""
        everyone = np.arange(self.n)
        return np.stack([self.sums(self.biased(np.full(self.n, one), everyone), 0, self.n) for one in everyone])

    def class_sums(self, one: np.ndarray, two: np.ndarray, h: np.ndarray) -> np.ndarray:
        """As ``sums`` over the classes: a class's exponential is a product, of one for each context word."""
        if self.tables is None:
            self.tables = []
            for weights, bias in ((self.c[0], self.b[self.n :]), (self.c[1], 0)):
                scored = (self.r * weights) @ self.q[self.n :].T + bias
                top = scored.max(axis=1)
                scored -= top[:, None]
                self.tables.append((np.exp(scored, out=scored), top))
        (first, first_top), (second, second_top) = self.tables
        total = np.empty(len(one), np.float32)
        for i in range(0, len(one), step := max(256, CELLS // len(self.first))):
            s = slice(i, i + step)
            np.einsum("ij,ij->i", first.take(one[s], axis=0), second.take(two[s], axis=0), out=total[s])
        far = np.flatnonzero(total <= HELD_SUMS[0])
        total[far] = 1
        out = np.log(total) + first_top.take(one) + second_top.take(two).astype(np.float64)
        out[far] = self.sums(h[far], self.n, len(self.o))
        return out

    def logs(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural logarithms of the words' probabilities: of the class, and within it."""
        of = self.class_of.take(word)
        order = np.argsort(of.astype(np.uint16), kind="stable")
        word, of, one, two = (x.take(order) for x in (word, of, one, two))
        h = self.biased(one, two)
        product = lambda at: np.einsum("ij,ij->i", h, self.o.take(at, axis=0))
        found = (product(word) + product(self.n + of)).astype(np.float64) - self.class_sums(one, two, h)
        cuts = np.searchsorted(of, np.arange(len(self.first) + 1))
        ends = np.append(self.first[1:], self.n)
        for c in np.flatnonzero(np.diff(cuts)):
            s = slice(cuts[c], cuts[c + 1])
            found[s] -= self.sums(h[s], self.first[c], ends[c])
        out = np.empty(len(word))
        out[order] = found
        return out


def examples(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each token and the one before that; before a text there are ends."""
    one, two = np.empty_like(ids), np.empty_like(ids)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    one[bounds[:-1]] = END
    two[bounds[:-1]] = END
    after = bounds[:-1] + 1
    two[after[after < bounds[1:]]] = END
    return one, two


def less_sigmoid(x: np.ndarray) -> np.ndarray:
    """Less the sigmoid of ``x``, in its place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= -0.5
    return x


class Trainer:
    """Mini-batches of noise-contrastive estimation with a step size per parameter."""

    def __init__(self, model: Model, seed: int):
        self.model, self.rng = model, np.random.default_rng(seed)
        self.seen = [np.full_like(p, 1e-2) for p in (model.r, model.o, model.c)]
        self.cumulated = np.cumsum(model.noise[: model.n])
        self.level = np.log(NOISE * model.noise).astype(np.float32)

    def step(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        """Learn from all tokens: from whole mini-batches together, then from the rest."""
        whole = len(word) - len(word) % BATCH
        for s, parts in ((slice(0, whole), whole // BATCH), (slice(whole, None), 1)):
            if len(word[s]):
                self._step(word[s], one[s], two[s], parts)

    def _outputs(self, words: np.ndarray) -> np.ndarray:
        """Words and, after them, their classes, which are outcomes of their own."""
        m = self.model
        if m.class_of is None:
            return words
        # The classes of noise words are noise for the classes.
        return np.concatenate([words, m.n + m.class_of.take(words)], axis=-1)

    def _step(self, word: np.ndarray, one: np.ndarray, two: np.ndarray, parts: int) -> None:
        m, size, wide = self.model, len(word), SIZE + 1
        m.tables = None
        noise = np.searchsorted(self.cumulated, self.rng.random((parts, NOISE)) * self.cumulated[-1])
        fake_at, real_at = self._outputs(np.minimum(noise, m.n - 1)), self._outputs(word)
        both = np.concatenate([one, two])
        first, second = m.r.take(both, axis=0).reshape(2, size, SIZE)
        h = np.ones((size, wide), np.float32)
        h[:, :SIZE] = first * m.c[0] + second * m.c[1]
        by_part = h.reshape(parts, -1, wide)
        others = m.o.take(fake_at, axis=0)
        # Less the sigmoid of what the model gives the noise.
        fake = by_part @ others.transpose(0, 2, 1)
        fake -= self.level.take(fake_at)[:, None]
        less_sigmoid(fake)
        target = m.o.take(real_at, axis=0).reshape(-1, size, wide)
        real = self.level.take(real_at).reshape(-1, size) - np.einsum("ij,kij->ki", h, target)
        real = -less_sigmoid(real)
        to_h = (fake @ others).reshape(size, wide) + np.einsum("ki,kij->ij", real, target)
        scale = np.float32(1 / math.sqrt(size))
        to_h = to_h[:, :SIZE] * scale
        h *= scale
        outputs = np.empty((len(real_at) + fake_at.size, wide), np.float32)
        np.multiply(real[:, :, None], h, out=outputs[: len(real_at)].reshape(-1, size, wide))
        np.matmul(fake.transpose(0, 2, 1), by_part, out=outputs[len(real_at) :].reshape(parts, -1, wide))
        c = np.stack([np.einsum("ij,ij->j", to_h, first), np.einsum("ij,ij->j", to_h, second)])
        inputs = (to_h * m.c[:, None]).reshape(-1, SIZE)
        # Fewer changes for as many tokens are longer ones.
        rate = np.float32(RATE * parts**0.25)
        # Only rows with a gradient change.
        self._change(m.r, self.seen[0], *self._spread(both, inputs), rate)
        self._change(m.o, self.seen[1], *self._spread(np.concatenate([real_at, fake_at.ravel()]), outputs), rate)
        self._change(m.c, self.seen[2], np.arange(2), c, rate)

    @staticmethod
    def _change(table: np.ndarray, seen: np.ndarray, at: np.ndarray, gradient: np.ndarray, rate: np.float32) -> None:
        total = gradient**2 + seen.take(at, axis=0)
        seen[at] = total
        table[at] = table.take(at, axis=0) + rate * gradient / np.sqrt(total)

    @staticmethod
    def _spread(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words in ``at``, and the sums of ``rows`` by word."""
        # Numbers of two bytes are sorted by counting.
        order = np.argsort(at.astype(np.min_scalar_type(at.max())), kind="stable")
        at = at.take(order)
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        return at.take(starts), np.add.reduceat(rows.take(order, axis=0), starts, axis=0)


def train(training: DataFrame, known: Known, unigram: np.ndarray) -> Model:
    """The averaged model after ``ROUNDS`` passes over all training texts."""
    model = Model(unigram, classes=True)
    for turn in range(ROUNDS):
        start = model.get()

        def run(batches, start=start, turn=turn):
            part = TaskContext.get().partitionId()
            own = Trainer(Model(unigram, classes=True).put(start), turn * 1_000_003 + part)
            total = 0
            for batch in batches:
                for piece in bounded(batch):
                    hashes, bounds = tokens(piece["text"])
                    ids = known.model(hashes)
                    one, two = examples(ids, bounds)
                    order = own.rng.permutation(len(ids))
                    ids, one, two = (x.take(order) for x in (ids, one, two))
                    for i in range(0, len(ids), together := BATCH * TOGETHER):
                        s = slice(i, i + together)
                        own.step(ids[s], one[s], two[s])
                    total += len(ids)
            if total:
                flat = own.model.get()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int64()), pa.array([total], pa.int64()),
                     pa.array([flat.tobytes()], pa.binary())],
                    names=["slot", "total", "flat"],
                )

        def summed(of, table):
            totals, flat = table["total"].to_pylist(), 0.0
            for share, one in zip(totals, table["flat"]):
                flat = flat + np.frombuffer(one.as_buffer(), np.float32) * (share / sum(totals))
            flat = flat.astype(np.float32)
            return pa.table(
                {"slot": pa.array([of[0].as_py()], pa.int64()),
                 "total": pa.array([sum(totals)], pa.int64()),
                 "flat": pa.array([flat.tobytes()], pa.binary())}
            )

        schema = "slot long, total long, flat binary"
        # The tasks' models go to the first sums at once, and their shuffle goes after it.
        parts = training.select("text").mapInArrow(run, schema).withColumn("slot", F.floor(F.col("slot") / FAN))
        parts = written(parts.groupBy("slot").applyInArrow(summed, schema), "models")
        last = parts.agg(F.max("slot")).first()[0]
        if last is None:
            return model
        while last:
            last //= FAN
            up = parts.withColumn("slot", F.floor(F.col("slot") / FAN))
            parts = up.groupBy("slot").applyInArrow(summed, schema)
        row = parts.first()
        model = Model(unigram, classes=True).put(np.frombuffer(row["flat"], np.float32))
    return model


def score(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = df.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    docs = docs.withColumn("held_out", held_out(F.col("doc")))
    training = docs.filter(~F.col("held_out"))
    counts = materialize(word_counts(training), "word-counts")
    row = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, distinct = row[0] or 0, row[1]
    known = most_frequent(counts)
    group_tokens, group_words = group_counts(counts, known)
    unigram = np.ones(known.groups + GROUPS)
    unigram[known.groups :] += group_tokens
    unigram[END] += known.counts[known.words == END_HASH].sum()
    own = known.ids >= 0
    unigram[known.ids[own]] += known.counts[own]
    unigram /= unigram.sum()
    model = train(training, known, unigram)
    base_room = math.log10(total + distinct + 1)
    # Of the group that a word is in; nothing for a row of its own.
    room = np.concatenate([np.zeros(known.groups), np.log10(group_tokens + group_words + 1.0)])

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        logs = np.concatenate([np.log10(known.counts + 1.0), [0.0]])
        for batch in batches:
            for piece in bounded(batch):
                hashes, bounds = tokens(piece["text"])
                place, ids = known.place(hashes), known.model(hashes)
                one, two = examples(ids, bounds)
                natural = np.empty(len(ids))
                for i in range(0, len(ids), 1 << 16):
                    s = slice(i, i + (1 << 16))
                    natural[s] = model.logs(ids[s], one[s], two[s])
                frequent = logs[place]
                shared = ids >= known.groups
                model_log = natural / math.log(10) + np.where(shared, frequent - room[ids], 0.0)
                sums = lambda x: np.add.reduceat(x, bounds[:-1]) if len(bounds) > 1 else x
                rare = place < 0
                rows = len(bounds) - 1
                row_of = np.repeat(np.arange(rows), np.diff(bounds))
                at = np.concatenate([[0], np.cumsum(np.bincount(row_of[rare], minlength=rows))])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((part << 36) + seq + np.arange(rows)),
                        piece["doc"],
                        piece["held_out"],
                        pa.array(np.diff(bounds)),
                        pa.array(sums((~rare).astype(np.int64))),
                        pa.array(sums(frequent) - np.diff(bounds) * base_room),
                        pa.array(sums(model_log)),
                        pa.ListArray.from_arrays(
                            pa.array(at.astype(np.int32)), pa.array(hashes[rare].view(np.int64))
                        ),
                    ],
                    names=["row", "doc", "held_out", "n_tokens", "n_known", "base", "model", "rare"],
                )
                seq += rows

    kind = dict(docs.dtypes)["doc"]
    scored = docs.select("doc", "held_out", "text").mapInArrow(
        run,
        f"row long, doc {kind}, held_out boolean, n_tokens long, n_known long, base double,"
        " model double, rare array<long>",
    )
    scored = materialize(scored, "scored")
    # Words that the arrays lack: a count of a training word, or none.
    rare = scored.select("row", F.explode("rare").alias("word")).groupBy("row", "word").count()
    found = rare.join(counts, "word")
    added = found.groupBy("row").agg(
        F.sum("count").alias("more"), F.sum(F.col("count") * F.log10(F.col("n") + 1)).alias("logs")
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.join(added, "row", "left").select(
        F.col("doc").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )
