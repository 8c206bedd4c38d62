import collections
import math
import re
import zlib

import numpy as np
import pytest

from attemptlog.llm import lbl

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    texts = [(d, [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), "\n"]) for d, t in rows]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = collections.Counter(w for d, ws in texts if not out(d) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    return sorted(
        (
            (d, out(d), len(ws), sum(w in counts for w in ws), total,
             sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws))
            for d, ws in texts
        ),
        key=repr,
    )


def check(out, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out), key=repr)
    want = brute(rows)
    plain = lambda rs: sorted((tuple(r[:5]) + (round(r[5], 6),) for r in rs), key=repr)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("known", [1 << 18, 50])
def test_base_and_gain_on_held_out_texts(spark, sf, monkeypatch, known):
    monkeypatch.setattr(lbl, "KNOWN", known)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = lbl.score(docs, "doc_id", "text").collect()
    check(out, [(r.doc_id, r.text) for r in docs.collect()])
    if known > 1000:
        held = [r for r in out if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, "A b A"), (None, "a c"), (3, "  \n"), (4, "x " * 30000), (5, "q" * 70000),
            *[(i, "the cat sat on the mat É") for i in range(10, 40)]]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, score int")
    out = lbl.score(df, "doc_id", "text").collect()
    check(out, rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)


def test_no_training_texts_and_no_rows(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    df = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")
    out = lbl.score(df, "doc_id", "text").collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in out} == {(0, 0, 0.0)}
    assert lbl.score(df.limit(0), "doc_id", "text").collect() == []


def test_probabilities_sum_to_one():
    model = lbl.Model(np.full(12, 1 / 12))
    model.r *= 9
    normal = model.normalisers()
    for one in range(12):
        for two in range(12):
            scored = model.context(np.array([one]), np.array([two])) @ model.q.T + model.b
            assert np.exp(scored - normal[one, two]).sum() == pytest.approx(1, abs=1e-5)


def test_training_learns_what_follows():
    rng = np.random.default_rng(1)
    unigram = np.full(10, 0.1)
    model = lbl.Model(unigram)
    trainer = lbl.Trainer(model, 1)
    for _ in range(300):
        two, one = rng.integers(0, 10, (2, 512))
        trainer.step((one + 1) % 10, one, two)
    scored = model.context(np.arange(10), np.full(10, 3)) @ model.q.T + model.b
    assert (scored.argmax(axis=1) == (np.arange(10) + 1) % 10).all()
