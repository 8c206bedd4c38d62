import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from attemptlog.llm import lbl
from test_lbl import check


def test_tables_do_not_grow_with_the_words():
    """The most frequent words have rows of their own, all others share those of the groups."""
    rng = np.random.default_rng(3)
    words = np.unique(rng.integers(2, 1 << 60, 60_000))
    counts = rng.integers(1, 40, len(words))
    known = lbl.Known(words, counts)
    own = known.ids >= lbl.FIRST
    assert own.sum() == lbl.WORDS and known.groups == lbl.FIRST + lbl.WORDS
    assert known.counts[own].min() >= known.counts[~own].max()
    unseen = rng.integers(2, 1 << 60, 1000).astype(np.uint64)
    ids = known.model(np.concatenate([words.view(np.uint64), unseen]))
    assert (ids > lbl.END).all() and ids.max() < known.groups + lbl.GROUPS
    assert len(np.unique(ids)) > 0.9 * (lbl.WORDS + lbl.GROUPS)


TEXTS = [(1, "the cat sat"), (2, "the dog sat on the cat"), (3, "a b c d e f g h"), (4, None), (5, "the unseen cat zzz"),
         (6, "dog dog dog"), (7, "on the the the a"), (None, "b c")]


def test_scores_by_brute_force(spark, monkeypatch):
    """Loops over context, class and word, for a model as it is before training."""
    monkeypatch.setattr(lbl, "WORDS", 5)
    monkeypatch.setattr(lbl, "GROUPS", 3)
    seen = {}

    def untrained(training, known, unigram):
        seen["known"], seen["model"] = known, lbl.Model(unigram, classes=True)
        seen["model"].r *= 5
        seen["model"].q *= 5
        return seen["model"]

    monkeypatch.setattr(lbl, "train", untrained)
    rows = TEXTS + [(i, "the cat and the dog sat on a mat") for i in range(10, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), round(r.score, 5)) for r in lbl.score(df, "doc_id", "text").collect())

    model, known = seen["model"], seen["known"]
    split = lambda t: [lbl.tokens(pa.array([w]))[0][0] for w in (t or "").split()]
    count = {}
    for doc, text in rows:
        if doc is None or zlib.crc32(str(doc).encode()) % 7 != 2:
            for h in split(text):
                count[h] = count.get(h, 0) + 1
    own = {int(w) for w, i in zip(known.words, known.ids) if i >= lbl.FIRST}
    assert len(own) == 5 and len(count) > 8
    ends = [*model.first[1:], model.n]

    def probability(h, id_, one, two):
        v = model.r[one].astype(float) * model.c[0] + model.r[two].astype(float) * model.c[1]
        score = lambda at: math.exp(float(v @ model.q[at].astype(float)) + float(model.b[at]))
        c = next(k for k, end in enumerate(ends) if id_ < end)
        p = score(model.n + c) / sum(score(model.n + k) for k in range(len(ends)))
        p *= score(id_) / sum(score(i) for i in range(model.first[c], ends[c]))
        if id_ >= known.groups:
            of = [w for w in count if int(w) not in own and lbl.group_of(np.array([w], np.uint64), 3)[0] == id_ - known.groups]
            p *= (count.get(h, 0) + 1) / (sum(count[w] + 1 for w in of) + 1)
        return p

    want = []
    for doc, text in rows:
        hashes = split(text)
        ids = [*known.model(np.array(hashes, np.uint64)).tolist(), lbl.END] if hashes else [lbl.END]
        one, two, total = lbl.END, lbl.END, 0.0
        for h, i in zip([*hashes, None], ids):
            total += math.log10(probability(h, i, one, two))
            one, two = i, one
        want.append((str(doc), round(total, 5)))
    assert [d for d, _ in got] == [d for d, _ in sorted(want)]
    assert all(abs(x - y) < 1e-3 for (_, x), (_, y) in zip(got, sorted(want)))


def test_words_of_all_classes_sum_to_one():
    unigram = np.random.default_rng(4).pareto(1.0, 500) + 0.01
    model = lbl.Model(np.sort(unigram)[::-1] / unigram.sum(), classes=True)
    assert len(model.first) > 3
    model.r *= 9
    for one, two in ((0, 1), (7, 300), (499, 2)):
        logs = model.logs(np.arange(500), np.full(500, one), np.full(500, two))
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_rare_words_are_learnt_as_targets_and_contexts():
    rng = np.random.default_rng(5)
    n = 2000
    model = lbl.Model(np.full(n, 1 / n), classes=True)
    trainer = lbl.Trainer(model, 1)
    for _ in range(600):
        one = rng.integers(1500, 1520, 512)
        trainer.step(one + 100, one, rng.integers(0, n, 512))
    one = np.arange(1500, 1520)
    assert model.logs(one + 100, one, np.full(20, 3)).mean() > np.log(1 / n) + 3


def test_words_beyond_the_arrays_are_joined(spark, sf, monkeypatch):
    monkeypatch.setattr(lbl, "KNOWN", 50)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(lbl.score(docs, "doc_id", "text").collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_classes_cost_no_exponentials_per_token(monkeypatch):
    """Sums over the classes come from tables, also where their scores lie very far apart."""
    unigram = np.arange(1, 501) ** 2.0
    for stretch in (9, 900):
        model = lbl.Model(np.sort(unigram)[::-1] / unigram.sum(), classes=True)
        model.r *= stretch
        rng = np.random.default_rng(5)
        one, two = rng.integers(0, 500, (2, 2000))
        h = model.biased(one, two).astype(float)
        scored = h @ model.o[model.n :].T.astype(float)
        top = scored.max(axis=1)
        want = np.log(np.exp(scored - top[:, None]).sum(axis=1)) + top
        asked, plain = [], lbl.Model.sums
        monkeypatch.setattr(lbl.Model, "sums", lambda m, h, low, high: asked.append(len(h)) or plain(m, h, low, high))  # noqa: B023
        assert np.allclose(model.class_sums(one, two, h.astype(np.float32)), want, rtol=1e-4, atol=1e-4)
        monkeypatch.setattr(lbl.Model, "sums", plain)
        assert (sum(asked) == 0) == (stretch == 9)


def test_mini_batches_change_the_parameters_together(monkeypatch):
    """Every token is learnt from, with the noise of its mini-batch; what is left over makes one more change."""
    model = lbl.Model(np.full(600, 1 / 600), classes=True)
    trainer = lbl.Trainer(model, 1)
    calls, plain = [], trainer._step
    monkeypatch.setattr(trainer, "_step", lambda w, o, t, parts: calls.append((len(w), parts)) or plain(w, o, t, parts))
    word = np.arange(lbl.BATCH * lbl.TOGETHER + 5) % 600
    before = model.o.copy()
    trainer.step(word, word, word)
    assert calls == [(lbl.BATCH * lbl.TOGETHER, lbl.TOGETHER), (5, 1)]
    assert (model.o != before).any(axis=1).all()
