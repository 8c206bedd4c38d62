import duckdb
import numpy as np
import pytest

from attemptlog.llm import topk
from attemptlog.llm.registry import ORACLE, QUERIES


def brute(rows, k):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good[i, tuple(int(np.floor(64.0 * x)) for x in v)] = None
    out = []
    for q, a in good:
        if q % 20:
            continue
        found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("tile,shard", [(1024, 4096), (3, 7)])
def test_odd_rows(spark, monkeypatch, tile, shard):
    monkeypatch.setattr(topk, "TILE", tile)
    monkeypatch.setattr(topk, "SHARD", shard)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 4], "x") for i in range(90)]
    rows += [(100, None, ""), (120, [None, 1.0, 1.0, 1.0], ""), (140, [float("nan")] * 4, ""),
             (160, [float("inf")] * 4, ""), (180, [1.0], ""), (200, [], ""), (220, [], ""),
             (None, [1.0] * 4, ""), rows[20], rows[21], (300, [1.0e7] * 4, ""), (301, [-1.1e7] * 4, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    out = topk.search(df, "vec_id", "embedding", "id % 20 = 0", 5)
    rows = [(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v, _ in rows]
    assert sorted(map(tuple, out.collect())) == brute(rows, 5)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(df, "vec_id", "embedding", "id % 20 = 0", 20).collect() == []


def test_score_beyond_a_long(spark):
    df = spark.createDataFrame([(0, [1e30]), (1, [1e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fit a long"):
        topk.search(df, "vec_id", "embedding", "id % 20 = 0", 20).collect()


def test_given_vectors(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(ORACLE["op1_top_k"]).fetchall()
    assert sorted(map(tuple, QUERIES["op1_top_k"](spark, sf).collect())) == sorted(want)
