import re
from fractions import Fraction

import pytest

from attemptlog.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Shares by weight, limits taken off until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(order), Fraction(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: Fraction(3 * sizes[s]) for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    return target


def check(rows, out):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    target = brute_targets(sizes)
    want = sorted(((d, len(WORD.findall(t or "")), sizes[s]) for d, t, s in rows), key=repr)
    assert sorted(((r.doc_id, r.size, r.source_size) for r in out), key=repr) == want
    assert all(0 <= r.taken <= 3 * r.size for r in out)
    near = sorted((float(target[s]) for _, _, s in rows))
    assert sorted(r.target for r in out) == pytest.approx(near)
    taken = {}
    for r in out:
        taken[r.target, r.source_size] = taken.get((r.target, r.source_size), 0) + r.taken
    return taken


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    run = lambda: mixing.mix(docs, "doc_id", "text", "source").collect()
    out = run()
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    for (target, _), taken in check(rows, out).items():
        assert taken == pytest.approx(target, rel=0.02, abs=20)
    assert sorted(out) == sorted(run())


def test_limits_and_odd_rows(spark):
    rows = [(i, "w " * 40, "big") for i in range(300)]
    rows += [(1000, "a b c d e", "b"), (1001, "x", None), (1001, "x", None), (1002, None, "c"),
             (1003, "", "c"), (None, "p q", "é"), (1004, " \t ", "big"), (7, "w " * 3000, "\U0001f600")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, k int")
    out = mixing.mix(df, "doc_id", "text", "source").collect()
    for (target, size), taken in check(rows, out).items():
        assert taken == pytest.approx(target, rel=0.05, abs=8)
    assert {r.taken for r in out if r.doc_id == 1000} == {15}


def test_no_rows_and_no_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    out = mixing.mix(df, "doc_id", "text", "source").collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in out] == [(0, 0, 0.0, 0)] * 2
    assert mixing.mix(df.limit(0), "doc_id", "text", "source").collect() == []


def test_slots_are_even_and_complete(spark):
    sources = spark.createDataFrame(
        [("a", 100, 5e4), ("b", 100, 1e5), (None, 50, 1e5)], "source string, source_size long, target double"
    ).selectExpr("source", "struct(source is null as missing, source as name) as key", "source_size", "target")
    rows = mixing.slots(sources, 250_000, 10).collect()
    assert sorted(r.slot for r in rows) == list(range(25_000))
    for sk, share in (("=a", 0.2), ("=b", 0.4), ("", 0.4)):
        own = sorted((r.slot, r.k) for r in rows if r.sk == sk)
        assert [k for _, k in own] == list(range(len(own)))
        # Evenly spread: every prefix of the schedule holds its share.
        for n in (50, 500, 5000, 25_000):
            assert abs(sum(slot < n for slot, _ in own) - share * n) < 12


def test_mixed_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = mixing.mixed_rows(docs, "doc_id", "text", "source")
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(WORD.findall(r.text))
    want = {r.doc_id: r.taken for r in mixing.mix(docs, "doc_id", "text", "source").collect()}
    total = sum(want.values())
    assert sum(got.values()) == pytest.approx(total, rel=0.01)
    assert set(got) == {d for d, taken in want.items() if taken}
