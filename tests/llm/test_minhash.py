import random
import re

import numpy as np
import pytest

from attemptlog.llm import components, minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and None not in (rows[i][0], rows[j][0]):
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * len(sets[i] | sets[j]):
                    root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted(
        ((doc, len(sets[i]), low.get(find(i)), doc == low.get(find(i))) for i, (doc, _) in enumerate(rows)),
        key=repr,
    )


def planted(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, n = [], 0
    for size in (1, 2, 4, 5, 6, 30, 80, 200, 1000):
        for _ in range(4):
            base = rng.choices(vocabulary, k=size)
            rows.append((n, " ".join(base)))
            n += 1
            for changes in (0, 1, 2, 4, 8):
                copy = list(base)
                for at in rng.sample(range(size), min(changes, size)):
                    copy[at] = "changed%d" % rng.randrange(99999)
                rows.append((n, "\n".join(copy).upper() if changes % 2 else " ".join(copy)))
                n += 1
    # A chain whose ends are far apart, and a large group of near copies.
    chain = rng.choices(vocabulary, k=300)
    for _ in range(20):
        rows.append((n, " ".join(chain)))
        n += 1
        chain = chain[4:] + rng.choices(vocabulary, k=4)
    base = rng.choices(vocabulary, k=60)
    for _ in range(80):
        copy = list(base)
        for at in rng.sample(range(60), rng.choice((0, 1, 1, 2))):
            copy[at] = "x%d" % rng.randrange(99999)
        rows.append((n, " ".join(copy)))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, None), (None, rows[0][1]), (None, None),
             (n + 4, "ÀB c"), (n + 5, "àb c"), (5, "a b"), (5, "zz " * 40), (n + 6, "long " + "q" * 30000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_planted(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = planted()
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, kept double")
    got = sorted(map(tuple, minhash.near_duplicates(df, "doc_id", "text", 85).collect()), key=repr)
    want = brute(rows)
    assert [g for g in got if g[0] != 5] == [w for w in want if w[0] != 5]


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(map(tuple, minhash.near_duplicates(docs, "doc_id", "text", 85).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df, "doc_id", "text", 85).collect() == []


def test_bounds_prune_only_the_unlikely():
    """At the threshold no more than the stated chance is lost in any batch."""
    rng = np.random.default_rng(0)
    equal = rng.random((20000, minhash.HASHES)) < 0.85
    for n, least in minhash.least_matches(0.85):
        assert (equal[:, :n].sum(axis=1) < least).mean() < 1e-3
    assert (1 - 0.85**minhash.ROWS) ** minhash.BANDS < 1e-6


def test_components_of_chains_and_stars(spark):
    edges = [(0, i, 0, i + 1) for i in range(200)] + [(1, 0, 1, i) for i in range(1, 300)]
    edges += [(2, 5, 3, 5), (4, 1, 4, 1)]
    df = spark.createDataFrame(edges, "a1 long, a2 long, b1 long, b2 long")
    roots = {(r.n1, r.n2): (r.r1, r.r2) for r in components.components(df).collect()}
    assert len({roots[0, i] for i in range(201)}) == 1
    assert len({roots[1, i] for i in range(300)}) == 1
    assert len(set(roots.values())) == 3
