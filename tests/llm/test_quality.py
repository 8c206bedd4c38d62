import numpy as np
import pytest

from attemptlog.llm import quality


def test_held_out_accuracy(spark, monkeypatch):
    monkeypatch.setattr(quality, "LABELLED", 200)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = {r.doc_id: r for r in quality.classify(docs, "doc_id", labels, "doc_id", "quality").collect()}
    assert len(out) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    right = np.mean([out[d].kept == bool(q) for d, q in truth.items()])
    lost = np.mean([not out[d].kept for d, q in truth.items() if q])
    caught = np.mean([not out[d].kept for d, q in truth.items() if not q])
    assert right > 0.95 and lost < 0.03 and caught > 0.8, (right, lost, caught)
    kept = quality.accepted(docs, "doc_id", labels, "doc_id", "quality")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, r in out.items() if r.kept)


def test_pseudo_labels_help_the_weak_view():
    """The second view is learnt from the first one's labels."""
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.7
    one = np.stack([y + 0.2 * rng.normal(size=4000), rng.normal(size=4000)], axis=1)
    two = np.concatenate([(y[:, None] + 1.0 * rng.normal(size=(4000, 1))), rng.normal(size=(4000, 30))], axis=1)
    views = lambda a, b: [v[a:b].astype(np.float32) for v in (one, two)]
    model = quality.CoTrained(views(0, 60), y[:60], views(60, 2000))
    both = model.scores(views(2000, 4000))[2]
    assert ((both > 0.5) == y[2000:]).mean() > 0.95


def test_rounds_in_tasks_equal_rounds_over_arrays(spark, monkeypatch):
    """Documents picked by the tasks against the same picks by plain sorting."""
    monkeypatch.setattr(quality, "HANDED", 12)
    monkeypatch.setattr(quality, "SHARE", 1)
    monkeypatch.setattr(quality, "PARTS", 3)
    rng = np.random.default_rng(6)
    good, bad = [f"plain{i}" for i in range(40)], [f"B!{i}$" for i in range(40)]
    texts = [" ".join(rng.choice(bad if i % 4 == 0 else good, 6 + i % 9)) for i in range(240)]
    docs = [(i, t, "s" if i % 5 else "t", "en", len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, n_chars long").repartition(5)
    known = list(range(60))
    plain = quality._plain(df, "doc_id")
    batch = plain.filter("doc < 60").orderBy("doc").toArrow().combine_chunks().to_batches()[0]
    views, _ = quality._views(batch)
    half = lambda vs: [v.astype(np.float16).astype(np.float32) for v in vs]
    y = np.array([i % 4 != 0 for i in known])
    tasks = quality.CoTrained(half(views), y, quality.Documents(plain, set(known)))
    rest = plain.filter("doc >= 60").orderBy("doc").toArrow().combine_chunks().to_batches()[0]
    others, _ = quality._views(rest)

    class Plain(quality.Unlabelled):
        """As sure ones are picked by exact features, ties by the tasks' order."""

        def pick(self, models, rate):
            out = super().pick(models, rate)
            for p in out:
                p.views = half(p.views)
            return out

    arrays = quality.CoTrained(half(views), y, Plain(others))
    for a, b in zip(tasks.scores(others), arrays.scores(others)):
        assert np.abs(a - b).max() < 0.02
    assert ((tasks.scores(others)[2] > 0.5) == (np.arange(60, 240) % 4 != 0)).mean() > 0.95


def test_picks_are_distinct_and_bounded(spark, monkeypatch):
    """One id has most rows: it is handed over once, and never twice."""
    monkeypatch.setattr(quality, "HANDED", 10)
    monkeypatch.setattr(quality, "SHARE", 1)
    rows = [(7, f"Plain words here {i % 3}.", "s", "en", 17) for i in range(5000)]
    rows += [(100 + i, f"Plain words here {i}.", "s", "en", 17) for i in range(200)]
    rows += [(400 + i, f"BAD!! $$$ {i} %%%", "t", "en", 13) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").repartition(6)
    plain = quality._plain(df, "doc_id")
    batch = plain.filter("doc IN (100, 101, 102, 103, 400, 401, 402, 403)").orderBy("doc").toArrow().combine_chunks().to_batches()[0]
    views, _ = quality._views(batch)
    y = np.array([True] * 4 + [False] * 4)
    models = [quality.Logistic().fit(v, y) for v in views]
    pool = quality.Documents(plain, {100, 101, 102, 103, 400, 401, 402, 403})
    before = [set(g) for g in pool.gone]
    seen = [[], []]
    for _ in range(3):
        picked = pool.pick(models, 0.6)
        for i, p in enumerate(picked):
            assert len(p.labels) == 10 and p.labels.sum() == 6
            new = pool.gone[i] - before[i]
            assert len(new) == 10
            before[i] = set(pool.gone[i])
            seen[i].append(new)
    assert all(not (a & b) for s in seen for k, a in enumerate(s) for b in s[:k])


def test_an_id_of_many_rows_sends_one(spark, monkeypatch):
    monkeypatch.setattr(quality, "LABELLED", 40)
    rows = [(1, f"Plain words {i}", "s", "en", 9) for i in range(20_000)]
    rows += [(i, "Plain words here.", "s", "en", 17) for i in range(10, 40)] + [(i, "BAD!! $$$ %%%", "t", "en", 13) for i in range(40, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    ids = spark.createDataFrame([(1,), (10,), (45,)], "doc long")
    assert quality._sampled(quality._plain(df, "doc_id"), ids).num_rows == 3
    labels = spark.createDataFrame([(1, 1)] + [(i, int(i < 40)) for i in range(10, 60)], "doc_id long, quality int")
    out = quality.classify(df, "doc_id", labels, "doc_id", "quality")
    assert out.count() == len(rows) and out.filter("doc_id >= 40 AND kept").count() == 0


def test_odd_rows(spark):
    rows = [(None, "a b", None, None, None), (1, None, "s", "en", 3), (1, "", "s", None, 0), (2, " \n", None, "x", -5),
            (3, "word " * 20000, "s", "en", None), *[(i, "Plain words here.", "s", "en", 17) for i in range(10, 40)],
            *[(i, "BAD!! $$$ %%%", "t", "en", 13) for i in range(40, 60)]]
    df = spark.createDataFrame([(*r, True) for r in rows],
                               "doc_id long, text string, source string, lang string, n_chars long, kept boolean")
    told = [(i, 1) for i in range(10, 40)] + [(i, 0) for i in range(40, 60)]
    told += [(3, None), (None, 1), (10, 1), (11, 0), (999, 0)]
    labels = spark.createDataFrame(told, "doc_id long, quality int")
    out = quality.classify(df, "doc_id", labels, "doc_id", "quality").collect()
    assert len(out) == len(rows)
    assert all(r.score == 0 and not r.kept for r in out if r.doc_id in (1, 2))
    assert all(r.kept == (r.doc_id < 40) for r in out if (r.doc_id or 0) >= 10)
    assert all(0 <= s <= 1 for r in out for s in (r.score, r.text_score, r.page_score))
    assert quality.accepted(df, "doc_id", labels, "doc_id", "quality").columns == df.columns
    for none in (labels.limit(0), labels.filter("quality = 1")):
        plain = quality.classify(df, "doc_id", none, "doc_id", "quality").collect()
        assert {r.score for r in plain} == {0.0, 1.0}
    assert quality.classify(df.limit(0), "doc_id", labels, "doc_id", "quality").collect() == []


def test_views_do_not_depend_on_slices():
    import pyarrow as pa

    texts = ["Aa bb", "", None, "ÄÖ 12 !!", "x" * 50]
    whole, some = quality.text_view(pa.array(texts))
    for i, text in enumerate(texts):
        own, has = quality.text_view(pa.array([text], pa.string()))
        assert own[0] == pytest.approx(whole[i], abs=1e-6) and has[0] == some[i]


def test_views_of_a_batch_take_little_memory():
    """A batch of 8 MB, as a task gets it, in pieces."""
    import tracemalloc

    import pyarrow as pa

    text = pa.array(["Some words, of 12 letters. " * 120] * 2600)
    model = quality.Logistic()
    model.mean, model.scale, model.w, model.b = np.zeros(1), np.ones(1), np.ones(quality.TEXT_SIZE), 0.0

    def run(batches):
        for batch in batches:
            views, _ = quality._views(batch)
            yield model.logits(views[0])

    none = pa.nulls(len(text), pa.string())
    batch = pa.RecordBatch.from_arrays([text, none, none, none], names=["text", "source", "lang", "length"])
    tracemalloc.start()
    try:
        rows = sum(len(x) for x in run(quality.bounded(batch, quality.PIECE)))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(text) and most < 30e6, most
