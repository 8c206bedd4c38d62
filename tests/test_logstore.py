"""The stored log: what is skipped, what is not shuffled, what a repeated or broken-off job leaves."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from attemptlog.functions.stages import STAGES
from attemptlog.operators import latest, lookups, quality
from attemptlog.plans import folds, logstore
from attemptlog.plans.b1_write import request_prior
from attemptlog.plans.logstore import LogStore, open_store
from attemptlog.plans.status_view import status_view
from attemptlog.sources import derived, tables
from attemptlog.sources.schemas import EMAIL_INSTANCE

from conftest import final_plan, rows

FIELDS = {"agent_subject": "case_subject", "agent_case_priority": "case_priority"}


def attempts(spark, made):
    """Rows from (id, activity, attempt, previous, day, status)."""
    df = spark.createDataFrame(
        made, "email_instance_id string, activity_id string, attempt_number int,"
        " previous_email_instance_id string, day int, status_code int",
    )
    day = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(day)")
    return df.withColumn("created_date_time", day).withColumn("modified_date_time", day).drop("day")


def stage_events(spark, made):
    df = spark.createDataFrame(made, "email_instance_id string, stage_rank int, day int")
    return df.withColumn("event_time", F.expr("timestamp_ntz'2024-02-01' + make_dt_interval(day)")).drop("day")


@pytest.fixture(scope="module")
def log(spark, sf):
    return tables.conform(derived.attempts(spark, sf), EMAIL_INSTANCE)


@pytest.fixture(scope="module")
def store(spark, log):
    made = open_store(spark, "store", 4)
    made.append(log, "0001")
    return made


def rows_read(df):
    """Rows that the scan gave out, after row groups and pages were skipped."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def day_folders(store):
    return {str(f): sorted(x.name for x in f.iterdir()) for f in pathlib.Path(store.path.removeprefix("file:")).glob("rows/*/created_day=*")}


def test_ids_reach_the_files(spark, store, log):
    asked = spark.createDataFrame([(" 7-2024-01-05 ",), ("none",)], "activity_id string")
    found = store.attempts_of(asked)
    plan = final_plan(found)
    assert "PushedFilters: [In(activity_id, [" in plan or "EqualTo(activity_id" in plan
    assert "LeftSemi" not in plan and "Join" not in plan
    total = log.count()
    assert rows(found) == rows(log.filter("activity_id = '7-2024-01-05'"))
    assert 0 < rows_read(found) < total / 4
    one = latest.top_one(store.log(), "7-2024-01-05")
    assert "EqualTo(activity_id,7-2024-01-05)" in final_plan(one)


def test_bloom_filters_skip_what_bounds_do_not(spark, tmp_path):
    made = LogStore(spark, str(tmp_path), 2)
    made.append(attempts(spark, [(f"id{i * 2:07d}", f"a{i * 2:07d}", 1, None, 1, 1) for i in range(40_000)]), "1")
    assert rows_read(made.log().filter("email_instance_id = 'id0020001'")) == 0
    assert rows_read(made.log().filter("email_instance_id = 'id0020000'")) > 0
    plain = str(tmp_path / "plain")
    made.log().write.parquet(plain)
    assert rows_read(spark.read.parquet(plain).filter("email_instance_id = 'id0020001'")) > 0


def test_lists_beyond_the_short_one_are_joined(spark, store, log):
    failed = log.filter("status_code = 9")
    assert failed.count() > lookups.SHORT
    assert rows(store.retries_of(failed)) == rows(lookups.lineage_lookup(log, failed))
    assert rows(store.retries_of(failed.limit(0))) == []
    pairs = log.select("banker_subject", "activity_id").limit(5)
    assert rows(store.failed_of(pairs)) == rows(lookups.subject_filter(log, pairs))
    assert rows(store.failed_of(log)) == rows(lookups.subject_filter(log, log))


def test_correlations_reach_the_files(spark, sf, tmp_path):
    path = str(tmp_path / "t")
    derived.tracking(derived.latest_rows(spark, sf)).write.parquet(path)
    tracked = spark.read.parquet(path)
    asked = tracked.select("CorrelationId").limit(3)
    found = lookups.correlation_lookup(tracked, asked, lookups.SHORT)
    assert found.count() == 3 and "PushedFilters: [In(CorrelationId, [" in final_plan(found)


def test_latest_is_found_without_a_shuffle(spark, sf, store, log):
    assert "Exchange" not in final_plan(store.status_view())
    assert rows(store.status_view()) == rows(status_view(log).select(*store.status_view().columns))
    requests = derived.requests(spark, sf)
    prior = store.request_prior(requests)
    scan = final_plan(prior).split("latest_")[0].rsplit("LeftSemi", 1)[1]
    assert "Exchange" not in scan.split("+- ")[1:][0]
    assert rows(prior) == rows(request_prior(requests, log).select(*prior.columns))


def moved(rnd, known, n):
    return [(rnd.choice(known), rnd.randrange(1, 9), rnd.randrange(5)) for _ in range(n)]


def test_any_sequence_of_batches(spark, tmp_path):
    """Appends, folds, repeats and merges in random order against the whole log recomputed."""
    rnd = random.Random(4)
    store = LogStore(spark, str(tmp_path), 3)
    whole, batches, events, last = None, {}, None, {}
    for step in range(9):
        name = f"{step:03d}"
        if step in (3, 6):
            new = stage_events(spark, moved(rnd, [f"id-{a}-{n}" for a, n in last.items()], 6))
            store.fold(new, name)
            whole = spark.createDataFrame(folds.stage_fold(whole, new).select(*EMAIL_INSTANCE.names).collect(), whole.schema)
        elif step == 5:
            store.append(batches["001"], "001")
        elif step == 7:
            store.compact_latest()
        else:
            made = []
            for a in rnd.sample([f"act{i}" for i in range(12)], 6):
                n = last[a] = last.get(a, 0) + 1
                made.append((f"ID-{a}-{n}", f" {a.upper()}", n, f"id-{a}-{n - 1}" if n > 1 else None, rnd.randrange(9), 1))
            batches[name] = attempts(spark, made)
            store.append(batches[name], name)
            added = tables.conform(tables.canonical(batches[name]), EMAIL_INSTANCE)
            added = spark.createDataFrame(added.collect(), EMAIL_INSTANCE_OPEN)
            whole = added if whole is None else whole.unionByName(added)
        assert rows(store.log()) == rows(whole.select(*EMAIL_INSTANCE.names))
        assert rows(store.latest()) == rows(latest.latest_attempt(whole).select(*EMAIL_INSTANCE.names))
    spark.sql(f"DROP TABLE {store.table}")
    again = LogStore(spark, str(tmp_path), 3)
    assert rows(again.latest()) == rows(store.latest()) == rows(latest.latest_attempt(whole).select(*EMAIL_INSTANCE.names))


EMAIL_INSTANCE_OPEN = type(EMAIL_INSTANCE)([type(f)(f.name, f.dataType) for f in EMAIL_INSTANCE.fields])


@pytest.mark.parametrize("broken", ["rename", "_write_keys", "_add_latest"])
def test_a_job_that_breaks_off_is_completed(spark, tmp_path, monkeypatch, broken):
    made = attempts(spark, [(f"i{n}", "a", n, f"i{n - 1}" if n > 1 else None, n, 1) for n in range(1, 6)])
    store = LogStore(spark, str(tmp_path), 2)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(logstore if broken == "rename" else LogStore, broken, fail)
        with pytest.raises(OSError):
            store.append(made, "1")
    for _ in range(2):
        store.append(made, "1")
        assert store.log().count() == 5 and store.latest().count() == 1
        assert store.rejected().count() == 0 and store._keys("id").count() == 5


def test_keys_are_checked_before_the_append(spark, tmp_path):
    store = LogStore(spark, str(tmp_path), 2)
    store.append(attempts(spark, [("a1", "a", 1, None, 1, 1), ("b1", "b", 1, None, 2, 1)]), "1")
    second = [("A1 ", "c", 1, None, 3, 1), ("a9", "A", 1, None, 3, 1), ("a2", "a", 2, "a1", 3, 1), ("a3", "a", 3, "a2", 3, 1),
              ("b2", "b", 2, "zz", 3, 1), ("d1", "d", 1, None, 3, 1), ("d1", "d", 2, None, 3, 1), ("e1", "e", 1, None, 3, 77),
              (None, "f", 1, None, 3, 1), ("f2", "f", None, None, 3, 1)]
    rules = [quality.Rule("chk_code", "status_code", F.col("status_code") <= 12)]
    for _ in range(2):
        store.append(attempts(spark, second), "2", rules)
    got = {(r.email_instance_id, r.attempt_number): r.broken for r in store.rejected().collect()}
    assert got == {("a1", 1): "chk_pk", ("a9", 1): "chk_activity_attempt", ("b2", 2): "chk_fk_previous", ("d1", 1): "chk_pk",
                   ("d1", 2): "chk_pk", ("e1", 1): "chk_code", (None, 1): "chk_not_null", ("f2", None): "chk_not_null"}
    assert sorted(r.email_instance_id for r in store.log().collect()) == ["a1", "a2", "a3", "b1"]
    items = spark.createDataFrame([("q1", " A"), ("q2", "x"), ("q3", None)], "queue_item_id string, activity_id string")
    assert [r.queue_item_id for r in store.without_parent(items).collect()] == ["q2"]


def test_the_log_is_not_read_for_its_keys(spark, store):
    new = attempts(spark, [("new", "new", 1, None, 1, 1)])
    files = store._judged(tables.conform(new, EMAIL_INSTANCE), "0002", []).inputFiles()
    # Its id is looked for as an id and as its own parent's; its place as a place.
    assert files and all("/keys/" in f for f in files)


def test_changes_open_only_their_days(spark, sf, log, tmp_path):
    store = LogStore(spark, str(tmp_path), 4)
    store.append(log, "1")
    before = day_folders(store)
    touched = log.filter("created_date_time >= '2024-01-03' AND created_date_time < '2024-01-04' AND status_code < 9").limit(3)
    ids = [r.email_instance_id for r in touched.collect()]
    events = stage_events(spark, [(i, 8, 1) for i in ids])
    days = store.days_of("id", events.select(F.col("email_instance_id").alias("key")))
    assert [str(d) for d in days] == ["2024-01-03"]
    scan = store._of_days(days)
    scan.collect()
    read = scan._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics()
    assert read.apply("numPartitions").value() == 1 < len(before)
    for _ in range(2):
        store.fold(events, "2")
        after = day_folders(store)
        assert [f for f in before if before[f] != after[f]] == [f for f in before if f.endswith("created_day=2024-01-03")]
    assert rows(store.log()) == rows(folds.stage_fold(log, events))
    assert store.latest().filter(F.col("last_completed_stage") == STAGES[-1]).count() >= sum(
        r.email_instance_id in ids for r in latest.latest_attempt(log).collect()
    )
    store.fold(stage_events(spark, [("none", 3, 1)]), "3")
    assert day_folders(store) == after


def test_a_change_that_breaks_off_is_completed(spark, log, tmp_path, monkeypatch):
    store = LogStore(spark, str(tmp_path), 4)
    store.append(log, "1")
    cases = derived.case_snapshot(log.withColumn("email_instance_id", F.col("email_instance_id").cast("long")))
    want = folds.feedback_flags(log, cases, FIELDS).select(*EMAIL_INSTANCE.names)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(LogStore, "_write_days", fail)
        with pytest.raises(OSError):
            store.flag_feedback(cases, FIELDS, "2")
    assert rows(store.log()) == rows(log)
    for _ in range(2):
        store.flag_feedback(cases, FIELDS, "2")
        assert rows(store.log()) == rows(want)
        assert rows(store.latest()) == rows(latest.latest_attempt(want))


def test_batches_need_a_name(spark, store, log):
    for name in ("", "_x", "a/b", "a=b", "it's"):
        with pytest.raises(ValueError):
            store.append(log, name)


def test_numeric_names_stay_text(spark, tmp_path):
    store = LogStore(spark, str(tmp_path), 2)
    for n in (1, 2):
        store.append(attempts(spark, [(f"i{n}", "a", n, None, 1, 1)]), f"{n:03d}")
    assert {r.batch for r in store._rows().collect()} == {"001", "002"}
    assert store.latest().first().email_instance_id == "i2"


def test_empty_batch(spark, tmp_path):
    store = LogStore(spark, str(tmp_path), 2)
    store.append(attempts(spark, []), "1")
    assert store.log().count() == store.latest().count() == store.rejected().count() == 0


def test_rows_are_worked_out_once(spark, log, tmp_path):
    """Judging, storing and indexing a batch do not compute its rows again and again."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    many = log.mapInArrow(counted, log.schema)
    LogStore(spark, str(tmp_path), 2).append(many, "1")
    assert seen.value == log.count()


def test_a_batch_that_is_done_is_left_alone(spark, tmp_path):
    """Also after a merge, whose rows lie under the name of the last batch."""
    store = LogStore(spark, str(tmp_path), 2)
    batches = {n: attempts(spark, [(f"i{n}", f"a{n}", 1, None, 1, 1)]) for n in ("1", "2")}
    for n, made in batches.items():
        store.append(made, n)
    store.compact_latest()
    before = sorted(pathlib.Path(tmp_path).glob("latest/*/*"))
    store.append(batches["2"], "2")
    assert sorted(pathlib.Path(tmp_path).glob("latest/*/*")) == before
    assert sorted(r.activity_id for r in store.latest().collect()) == ["a1", "a2"]


def test_latest_rows_are_shuffled_once(spark, log, tmp_path, monkeypatch):
    """The ranking's shuffle is the one that the buckets need."""
    plans = []
    monkeypatch.setattr(LogStore, "_overwrite_latest", lambda self, rows, batch: plans.append(final_plan(rows)))
    own = spark.conf.get("spark.sql.shuffle.partitions")
    LogStore(spark, str(tmp_path), 3).append(log, "1")
    assert plans[0].count("Exchange ") == 1 and "hashpartitioning(activity_id" in plans[0]
    assert ", 3)" in plans[0].split("hashpartitioning(activity_id")[1].split("\n")[0]
    assert spark.conf.get("spark.sql.shuffle.partitions") == own


def test_keys_are_written_where_their_rows_are(spark, log, tmp_path):
    """No shuffle: every task that reads rows writes their keys, sorted; a shuffle had joined these few up."""
    store = LogStore(spark, str(tmp_path), 2)
    good = log.withColumn("created_day", F.to_date("created_date_time"))
    good.repartition(3).write.parquet(str(tmp_path / "good"))
    read = spark.read.parquet(str(tmp_path / "good"))
    store._write_keys(read, "1")
    files = list(pathlib.Path(tmp_path).glob("keys/batch=1/kind=id/*.parquet"))
    assert len(files) == read.rdd.getNumPartitions() > 1
    for f in files:
        keys = [r.key for r in spark.read.parquet(str(f)).collect()]
        assert keys == sorted(keys)
    assert store._keys("id").count() == log.count()
    assert rows(store._keys("activity").select("key").distinct()) == rows(log.select("activity_id").distinct())


def test_repeats_do_not_make_a_list_long(spark, store, log):
    one = log.select("activity_id").limit(3)
    many = one.crossJoin(spark.range(2_000)).select("activity_id")
    found = store.attempts_of(many)
    assert "Join" not in final_plan(found) and rows(found) == rows(store.attempts_of(one))


def test_rows_are_written_apart_only_if_some_are_broken(spark, log, tmp_path, monkeypatch):
    kept = []
    own = logstore.materialize
    monkeypatch.setattr(logstore, "materialize", lambda df, name: kept.append(name) or own(df, name))
    store = LogStore(spark, str(tmp_path), 2)
    store.append(log, "1")
    assert "judged" not in kept and store.log().count() == log.count() and store.rejected().count() == 0
    store.append(log.limit(5), "2")
    assert "judged" in kept and store.log().count() == log.count() and store.rejected().count() == 5


def test_a_change_that_is_stored_moves_no_rows(spark, log, tmp_path, monkeypatch):
    store = LogStore(spark, str(tmp_path), 2)
    store.append(log, "1")
    cases = derived.case_snapshot(log.withColumn("email_instance_id", F.col("email_instance_id").cast("long")))
    events = stage_events(spark, [(r.email_instance_id, 8, 1) for r in log.limit(3).collect()])
    store.flag_feedback(cases, FIELDS, "2")
    store.fold(events, "3")
    want = rows(store.log())
    kept = []
    own = logstore.materialize
    monkeypatch.setattr(logstore, "materialize", lambda df, name: kept.append(name) or own(df, name))
    store.flag_feedback(cases, FIELDS, "4")
    store.fold(events, "5")
    assert kept == [] and rows(store.log()) == want
