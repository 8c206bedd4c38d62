"""Truth tables of the stage, status, gate and JSON rules."""

import pytest
from pyspark.sql import functions as F

from attemptlog.functions import documents as doc
from attemptlog.functions import stages as st
from attemptlog.operators import quality

from conftest import rows

RESUME = ["B4", "B4", "B4", "B4", "B7", "B8", "B9", "B1"]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_stage_rules(spark):
    stages = [*st.STAGES, None, "other"]
    df = column(spark, stages).select(
        "x",
        st.resume_stage(F.col("x")),
        st.resume_stage(F.col("x"), fallback="B4"),
        st.skip_queueitem(F.col("x")),
        st.stage_rank(F.col("x")),
        st.stage_at(st.stage_rank(F.col("x"))),
    )
    got = {r[0]: tuple(r)[1:] for r in df.collect()}
    for i, stage in enumerate(st.STAGES):
        v6 = "B4" if RESUME[i] == "B1" else RESUME[i]
        assert got[stage] == (RESUME[i], v6, i > 0, i + 1, stage)
    assert got[None] == ("B1", "B4", False, None, None)
    assert got["other"] == ("B1", "B4", True, None, None)


def test_status_text(spark):
    codes = [*range(0, 12), None, -(2**31), 2**31 - 1]
    df = column(spark, codes, "int").select("x", st.status_description(F.col("x")))
    for code, text in df.collect():
        assert text == st.STATUS_TEXT.get(code, st.UNKNOWN_STATUS_TEXT)
    texts = ["9", " 9", "x", "", None, "99999999999"]
    df = column(spark, texts).select("x", st.status_description(F.col("x")))
    got = dict(df.collect())
    assert got["9"] == got[" 9"] == "Processing failed"
    assert {got["x"], got[""], got[None], got["99999999999"]} == {st.UNKNOWN_STATUS_TEXT}


def test_status_names_and_codes_are_inverse(spark):
    df = column(spark, list(range(0, 12)), "int").select(
        "x", st.status_code_of(st.status_name_of(F.col("x")))
    )
    assert dict(df.collect()) == {i: i if 1 <= i <= 10 else None for i in range(0, 12)}


def test_tracking_status(spark):
    df = spark.createDataFrame(
        [(9, "c"), (10, None), (7, None), (1, "c"), (1, None), (None, None)],
        "code int, case string",
    ).select(st.tracking_status(F.col("code"), F.col("case")))
    assert [r[0] for r in df.collect()] == [
        "Failed", "Failed", "Completed", "Completed", "InProgress", "InProgress",
    ]


@pytest.mark.parametrize(
    "item, owner, regarding, failed",
    [
        ("Email", "AAB OPS", None, None),
        ("email ", "aab ops", None, None),
        (" Email", "AAB OPS", None, "A2"),
        ("Phone", "AAB OPS", None, "A2"),
        (None, "AAB OPS", None, "A2"),
        ("Email", "x", None, "A3"),
        ("Email", None, "r", "A3"),
        ("Email", "AAB OPS", "r", "A4"),
    ],
)
def test_gates(spark, item, owner, regarding, failed):
    df = spark.createDataFrame([(item, owner, regarding)], "a string, b string, c string")
    assert df.select(st.gate_failure(F.col("a"), F.col("b"), F.col("c"))).first()[0] == failed


@pytest.mark.parametrize("resume", ["B1", "B4", "B7", "B8", "B9"])
def test_carry_forward(spark, resume):
    names = list(st.CARRY)
    df = spark.createDataFrame(
        [tuple("x" for _ in names) + (resume,)], ", ".join(f"{n} string" for n in names + ["r"])
    )
    got = df.withColumns(st.carry_forward(F.col("r"))).first().asDict()
    kept = {n for n in names if got[n] is not None}
    classified = {
        "agent_subject", "agent_case_priority", "agent_case_description", "agent_response",
        "agent_confidence_score",
    }
    want = set()
    if resume in ("B7", "B8", "B9"):
        want |= classified
    if resume in ("B8", "B9"):
        want.add("agent_action_flag")
    if resume == "B9":
        want.add("crm_case_payload")
    assert kept == want


JSON_TEXTS = {
    '{"a":1}': True,
    '{"a":{"b":[1,2]}}': True,
    "[1,2]": True,
    "[]": True,
    "{}": True,
    ' {"a":1} ': True,
    '{"a":1,"a":2}': True,
    '{"a":1} x': False,
    '{"a":1},{"b":2}': False,
    '{"a":1}],[{"b":2}': False,
    '{"a":1': False,
    "{a:1}": False,
    '"text"': False,
    "12": False,
    "true": False,
    "null": False,
    "": False,
    "not json": False,
}


def test_is_json(spark):
    df = column(spark, [*JSON_TEXTS, None]).select("x", doc.is_json(F.col("x")))
    assert dict(df.collect()) == {**JSON_TEXTS, None: None}


def test_json_value(spark):
    cases = {
        '{"p":"text"}': "text",
        '{"p":12}': "12",
        '{"p":1.5}': "1.5",
        '{"p":true}': "true",
        '{"p":null}': None,
        '{"p":{"q":1}}': None,
        '{"p":[1]}': None,
        '{"p":"{brace"}': "{brace",
        '{"q":1}': None,
        '{"p":"x"} tail': None,
        "not json": None,
        '{"p":"' + "y" * 4001 + '"}': None,
        '{"p":"' + "y" * 4000 + '"}': "y" * 4000,
        None: None,
    }
    df = column(spark, list(cases)).select("x", doc.json_value(F.col("x"), "$.p"))
    assert dict(df.collect()) == cases


SINGLE = (
    '{"failed_stage": "B.6_invoke_agent_workflow", "error_code": "E17", "error_message": "m",'
    ' "http_status": 418, "occurred_at": "2031-02-03T04:05:06Z", "attempt_number": 5}'
)
MANY = (
    '{"attempts": [{"attempt": 8, "failed_stage": "B6_invoke_agent_workflow", "error_code": "E1",'
    ' "occurred_at": "2031-02-03T01:00:00Z"}, {"attempt": 9, "failed_stage":'
    ' "B9_post_case_creation", "error_code": "E2", "occurred_at": "2031-02-03T02:30:00Z"}]}'
)


def test_details_of_both_shapes(spark):
    df = spark.createDataFrame(
        [(1, SINGLE), (2, MANY), (3, "not json"), (4, None)], "id int, status_details string"
    )
    got = [
        (r["id"], r["attempt"], r["failed_stage"], r["http_status"], str(r["occurred_at"]))
        for r in doc.status_details_rows(df, "id").orderBy("id", "attempt").collect()
    ]
    assert got == [
        (1, 5, "B6_invoke_agent_workflow", 418, "2031-02-03 04:05:06"),
        (2, 8, "B6_invoke_agent_workflow", None, "2031-02-03 01:00:00"),
        (2, 9, "B9_post_case_creation", None, "2031-02-03 02:30:00"),
    ]
    stage = df.select("id", doc.failed_stage(F.col("status_details")))
    assert dict(stage.collect()) == {1: "B.6_invoke_agent_workflow", 2: None, 3: None, 4: None}
    corrupt = doc.details_typed(df).select("id", "details._corrupt")
    assert dict(corrupt.collect())[3] == "not json"


def test_checks_pass_on_unknown(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, 2, "Bogus"), (3, 4, "Failed")], "id int, p int, s string"
    )
    rules = [quality.priority_rule("p"), quality.status_rule("s")]
    got = rows(quality.violations(df, "id", rules).select("rule", "key", "value"))
    assert got == [("chk_priority", "3", "4"), ("chk_status", "2", "Bogus")]
    good, bad = quality.quarantine(df, rules)
    assert [r[0] for r in good.collect()] == [1]
    assert {r["id"]: r["broken"] for r in bad.collect()} == {2: ["chk_status"], 3: ["chk_priority"]}


def test_unique_counts_nulls_as_one_value(spark):
    df = column(spark, ["a", "b", None])
    assert quality.duplicate_keys(df, ["x"]).count() == 0
    df = column(spark, ["a", "a", None, None])
    assert rows(quality.duplicate_keys(df, ["x"])) == [("a", 2), (None, 2)]


def test_foreign_key_ignores_null(spark):
    child = column(spark, ["a", "b", None])
    assert rows(quality.missing_parent(child, column(spark, ["a"]), "x")) == [("b",)]


def test_length_counts_utf16(spark):
    texts = {"a" * 4: True, "é" * 4: True, "a" * 5: False, "😀😀": True, "😀😀a": False, None: True}
    df = column(spark, list(texts))
    broken = {r["value"] for r in quality.violations(df, "x", [quality.length_rule("x", 4)]).collect()}
    assert broken == {t for t, ok in texts.items() if not ok}
    numbers = column(spark, [9.9999, -9.9999, 10.0, 9.99996, None], "double")
    rule = quality.decimal_rule("x", 5, 4)
    assert quality.violations(numbers, "x", [rule]).count() == 2


def test_sequence_breaks(spark):
    log = spark.createDataFrame(
        [
            ("a1", "a", 1, None), ("a2", "a", 2, "a1"), ("a4", "a", 4, "a2"),
            ("b1", "b", 1, "zz"), ("c2", "c", 2, None), ("d1", "d", 1, None), ("d2", "d", 2, "x"),
        ],
        "email_instance_id string, activity_id string, attempt_number int,"
        " previous_email_instance_id string",
    )
    got = {r["email_instance_id"]: r["problem"] for r in quality.sequence_breaks(log).collect()}
    assert got == {"a4": "gap", "b1": "lineage", "c2": "gap", "d2": "lineage"}


def test_raw_content_columns(spark):
    df = spark.createDataFrame([], "a string, Body_HTML string, sender_email string")
    assert quality.raw_content_columns(df) == ["Body_HTML", "sender_email"]


def test_names_compare_without_case_and_trailing_blanks(spark):
    names = ["Failed", "FAILED ", "failed", " Failed", "Fail", None]
    df = column(spark, names)
    broken = quality.violations(df, "x", [quality.status_rule("x")])
    assert {r["value"] for r in broken.collect()} == {" Failed", "Fail"}
    codes = dict(df.select("x", st.status_code_of(F.col("x"))).collect())
    assert codes == {n: 9 if n in names[:3] else None for n in names}
    stages = column(spark, ["b7_DECISION  ", "other", None])
    got = dict(stages.select("x", st.canonical_name(F.col("x"), st.STAGES)).collect())
    assert got == {"b7_DECISION  ": "B7_decision", "other": "other", None: None}
