import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken

from attemptlog.llm import bpe
from attemptlog.llm.registry import RANKS


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


TEXTS = [
    None, "", " ", "\n\n\n", "Hello world", "aaaaaaaaaaaaaaaaaaaaa", "It's  a\ttest  　 x",
    "größe ñandú 日本語 \U0001f600\U0001f600", "<|endoftext|>", "ab" * 4000, "x" * 30001,
    " leading and trailing ", "12345 6789", "a\x00b",
]


def test_same_ids_as_the_library(spark, library):
    rows = [(i if i % 3 else 0, t, "extra") for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.round_trip(df, "doc_id", "text", RANKS, public_tokenizers.PATTERN).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows]
    key = lambda r: (r[0], list(r[1]), bytes(r[2]))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_digests_and_empty_table(spark, library):
    df = spark.createDataFrame([(1, "Hello  world"), (None, None)], "doc_id long, text string")
    run = lambda d: bpe.digests(d, "doc_id", "text", RANKS, public_tokenizers.PATTERN)
    out = {r.doc_id: r for r in run(df).collect()}
    ids = library.encode_ordinary("Hello  world")
    assert out[1].n_tokens == len(ids)
    assert out[1].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert out[1].decoded_sha256 == hashlib.sha256(b"Hello  world").hexdigest()
    assert out[None].n_tokens == 0
    assert run(df.limit(0)).collect() == []


def test_given_documents(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = bpe.encode(docs, ["doc_id"], "text", RANKS, public_tokenizers.PATTERN)
    got = {r.doc_id: list(r.ids) for r in out.collect()}
    assert got == {r.doc_id: library.encode_ordinary(r.text or "") for r in docs.collect()}


def test_unknown_id(spark):
    df = spark.createDataFrame([([99999999],)], "ids array<int>")
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(df, [], "ids", RANKS).collect()


def test_one_python_step_encodes_and_decodes(spark):
    """Two steps keep two workers for every task, with the tables of both, as long as the pipeline runs."""
    df = spark.createDataFrame([(1, "Hello  world")], "doc_id long, text string")
    made = bpe.digests(df, "doc_id", "text", RANKS, public_tokenizers.PATTERN, keep_ids=True)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1, plan
