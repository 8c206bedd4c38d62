import re

import corpus_pipeline as pipeline

from attemptlog.llm import minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stored(spark, df, folder, name):
    df.write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, made = docs.columns, []
    for i, (_, stage) in enumerate(pipeline.STAGES):
        before = docs
        docs = stored(spark, stage(spark, docs, sf), tmp_path, i)
        made.append((before, docs))
        if i < len(pipeline.STAGES) - 1:
            assert docs.columns == columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in made[0][1].select("doc_id").collect()}
    good = [d for d, q in labels.items() if q]
    assert sum(d in kept for d in good) / len(good) > 0.98
    bad = [d for d, q in labels.items() if not q]
    assert sum(d in kept for d in bad) / len(bad) < 0.1

    lines = [x for r in made[1][1].collect() for x in r.text.split("\n") if x.strip()]
    assert len(lines) == len({" ".join(x.lower().split()) for x in lines})
    assert made[1][0].count() == made[1][1].count()

    found = minhash.near_duplicates(made[2][0], "doc_id", "text", pipeline.SIMILAR)
    want = sorted(r.doc_id for r in found.collect() if r.kept)
    assert sorted(r.doc_id for r in made[2][1].collect()) == want

    words = [sum(len(WORD.findall(r.text)) for r in df.collect()) for df in made[3]]
    assert abs(words[1] / words[0] - 1) < 0.01
    assert made[4][0].count() == made[4][1].count()


def test_run(spark, sf):
    out = pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert out.count() > 0


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "a b c", "en", "s", 5),
            (3, "One line here.\nAnd one more.", "en", "s", 28), (3, "One line here.\nAnd one more.", "en", "s", 28)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for given, name in ((docs, "odd"), (docs.limit(0), "empty")):
        for i, (_, stage) in enumerate(pipeline.STAGES):
            given = stored(spark, stage(spark, given, "/root/testdata/sf0.001"), tmp_path, f"{name}{i}")
        assert given.columns[0] == "doc_id"
