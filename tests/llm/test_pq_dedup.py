import duckdb
import numpy as np
import pytest

from attemptlog.llm import pq_dedup
from attemptlog.llm.registry import ORACLE, QUERIES


def brute(rows, threshold=0.98):
    n = len(rows)
    good = [i for i, (d, v, lab) in enumerate(rows) if d is not None and lab is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v) and any(x for x in v)]
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], np.float64) for k in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    low = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((r[0], links[i], low.get(find(i)), r[0] == low.get(find(i))) for i, r in enumerate(rows)), key=repr)


def planted():
    rng = np.random.default_rng(5)
    rows = []
    centres = rng.normal(size=(40, 16))
    for c, centre in enumerate(centres):
        for scale in (0.0, 0.02, 0.05, 0.05, 0.08, 0.1, 0.3, 1.0):
            rows.append((len(rows), [float(x) for x in centre + scale * rng.normal(size=16)], c % 3))
    base = rng.normal(size=16)
    rows += [(len(rows) + i, [float(x) for x in base + 0.03 * rng.normal(size=16)], 7) for i in range(150)]
    rows += [(len(rows) + i, [float(x) for x in base], 7) for i in range(60)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [None] * 16, 1), (n + 3, [float("nan")] * 16, 1),
             (n + 4, rows[0][1], None), (None, rows[0][1], 0), (n + 5, [2 * x for x in rows[0][1]], 0),
             (n + 6, [1.0, 2.0], 0), (n + 7, [1.0, 2.001], 0), (n + 8, [], 0), (n + 9, [-x for x in rows[0][1]], 0),
             (n + 10, [1e300, 1e300], 0), (n + 11, [float("inf"), 1.0], 0), (n + 12, [-0.0, 5.0], 0)]
    return rows


@pytest.mark.parametrize("block,list_rows", [(2048, 1024), (16, 8)])
def test_planted(spark, monkeypatch, block, list_rows):
    monkeypatch.setattr(pq_dedup, "BLOCK", block)
    monkeypatch.setattr(pq_dedup, "LIST_ROWS", list_rows)
    rows = planted()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, n1 string")
    got = pq_dedup.near_duplicates(df, "vec_id", "embedding", "label", 0.98).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert pq_dedup.near_duplicates(df, "vec_id", "embedding", "label", 0.98).collect() == []


def test_given_vectors(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(ORACLE["op8_pq_dedup"]).fetchall()
    assert sorted(map(tuple, QUERIES["op8_pq_dedup"](spark, sf).collect())) == sorted(want)
