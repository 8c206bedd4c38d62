import re
from fractions import Fraction
from itertools import permutations

import duckdb


from attemptlog.llm import filter_audit
from attemptlog.llm.registry import ORACLE, QUERIES



def fails(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return {
        f
        for f, failed in zip(
            "ABCD",
            (len(words) < 50, 100 * len(set(words)) < 65 * len(words),
             100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), any(c in "#$%&*|" for c in text)),
        )
        if failed
    }


def brute(docs, labels):
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    rows = []
    for i, text, part in docs:
        failed = fails(text or "")
        if i is not None and i > first[text or ""]:
            failed.add("E")
        good = any(x == i and q == 1 for x, q, _ in labels if i is not None)
        toxic = any(x == i and t == 1 for x, _, t in labels if i is not None)
        rows.append((part or "", failed, good, toxic))
    out = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        share = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                share[f] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), sum(f in r[1] for r in mine) - len(gone),
                              sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone), f))
        out += [(*s[:9], share[s[9]], s[9]) for s in steps]
    return sorted(out)


def run(spark, docs, labels):
    docs = spark.createDataFrame([(*d, 5, "x") for d in docs], "doc_id long, text string, source string, mask int, digest string")
    labels = spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int, good int")
    out = filter_audit.audit(docs, "doc_id", "text", "source", labels, "doc_id", "quality", "toxic")
    return sorted(tuple(r) for r in out.collect())


def test_odd_rows(spark):
    many = " ".join(f"w{i}" for i in range(60))
    docs = [(1, many, "a"), (2, many, "b"), (2, many, "b"), (3, "short", "a"), (4, "", "a"), (5, None, "a"), (None, None, "a"),
            (None, many, "b"), (6, many + " #", "b"), (7, "x " * 100, "b"), (8, "ABC " * 80, None), (9, "É ß " * 49 + "z", ""),
            (10, "word " * 200_000, "b"), (-1, "\x1c \x0b\x00", "a"), (11, "A" + "b" * 19, "a"), (12, "A" + "b" * 18, "a")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (4, 1, 1), (5, 0, 0), (8, None, 1), (None, 1, 1), (99, 1, 1), (8, 0, 1)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_empty(spark):
    assert run(spark, [], []) == []
    assert len(run(spark, [(1, "a", "s")], [])) == 600


def test_a_third_are_copies(spark):
    docs = [(i, "same text" if i % 3 else f"text {i} $", f"s{i % 2}") for i in range(3000)]
    assert run(spark, docs, [(5, 1, 0), (6, 1, 1)]) == brute(docs, [(5, 1, 0), (6, 1, 1)])


def test_shares_are_means_over_orders():
    """The fit's weights against those of the mean over all orders."""
    want = [dict() for _ in filter_audit.FILTERS]
    orders = list(permutations(range(5)))
    for order in orders:
        before = 0
        for i in order:
            for s, sign in ((before | 1 << i, 1), (before, -1)):
                want[i][s] = want[i].get(s, 0) + Fraction(sign, len(orders))
            before |= 1 << i
    got = filter_audit.shares()
    for i in range(5):
        assert {s: w for s, w in got[i].items() if w} == {s: w for s, w in want[i].items() if w and s}


def test_given_documents(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    result = con.execute(ORACLE["op11_filter_audit"])
    names = [d[0] for d in result.description]
    got = QUERIES["op11_filter_audit"](spark, sf)
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(result.fetchall())
