"""Streams over several files: batches, restarts, late rows and duplicates."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from attemptlog.plans.b1_write import WRITTEN, b1_write
from attemptlog.session import shared_dir
from attemptlog.sources import derived
from attemptlog.streaming import alarms as progress_alarms
from attemptlog.streaming import intake, progress
from attemptlog.streaming import tables as streams

from conftest import final_plan, rows


@pytest.fixture(scope="module")
def split_dir(spark, sf, tmp_path_factory):
    """``events`` in four files, in time order."""
    folder = tmp_path_factory.mktemp("split")
    ordered = spark.read.parquet(f"{sf}/events.parquet").repartitionByRange(4, "ts")
    ordered.sortWithinPartitions("ts").write.parquet(str(folder / "events.parquet"))
    parts = sorted((folder / "events.parquet").glob("part-*"))
    for i, part in enumerate(parts):
        part.rename(folder / f"events{i}.parquet")
        (folder / f"events{i}.parquet").touch()
    assert len(parts) == 4
    return str(folder)


def keyed(stream):
    return stream.withColumn("activity_id", F.expr(derived.ACTIVITY))


def test_batches_of_requests_equal_one_batch(spark, sf, split_dir):
    log = derived.attempts(spark, sf)
    folder = progress.open_log(log, "attempts", buckets=4)
    asked = derived.request_columns(keyed(streams.event_stream(spark, split_dir, 1)))
    got = progress.write_attempts(asked, folder, buckets=4)
    assert streams.read_rows(spark, folder).select(streams.BATCH).distinct().count() > 3
    stored = progress.log_rows(log)
    want = b1_write(stored, derived.requests(spark, sf))
    assert rows(got.select(*WRITTEN)) == rows(want.select(*WRITTEN))
    # A second start finds nothing new.
    assert rows(progress.write_attempts(asked, folder, buckets=4).select(*WRITTEN)) == rows(
        want.select(*WRITTEN)
    )


def test_repeating_a_batch_adds_nothing(spark, sf):
    log = derived.attempts(spark, sf)
    folder = progress.open_log(log, "attempts", buckets=4)
    new = b1_write(progress.log_rows(log), derived.requests(spark, sf))
    filled = new.withColumns(
        {c: F.lit("2024-01-01").cast("timestamp_ntz") for c in ("created_date_time",)}
    )
    for _ in range(2):
        progress.store_batch(filled, folder, 0, 4)
    stored = streams.read_rows(spark, folder).filter("batch_id = 0")
    assert stored.count() == new.count()


def test_stage_progress_over_batches(spark, sf, split_dir):
    live = derived.attempt_columns(
        keyed(streams.event_stream(spark, split_dir, 1)).filter("event_type <> 'view'")
    )
    got = progress.fold_stages(derived.stage_events(live), "fold")
    moves = derived.stage_events(derived.attempt_rows(spark, sf))
    want = moves.groupBy("email_instance_id").agg(F.max("stage_rank"), F.max("event_time"))
    assert rows(got) == rows(want)


def test_windows_over_batches(spark, sf, split_dir):
    live = derived.attempt_columns(
        keyed(streams.event_stream(spark, split_dir, 1)).filter("event_type <> 'view'")
    )
    got = streams.collect_updated(
        progress.status_windows(live, "1 day"), "w", ["window_start", "window_end", "status_code"]
    )
    day = F.date_trunc("day", "created_date_time").cast("timestamp_ntz")
    want = derived.attempt_rows(spark, sf).groupBy(day, "status_code").count()
    assert rows(got.select("window_start", "status_code", "attempts")) == rows(want)


def messages(spark, tmp_path, batches):
    """One JSON file per batch, read one at a time."""
    for i, batch in enumerate(batches):
        lines = [
            f'{{"message_id":"{m}","enqueued_date_time":"2024-01-01T{at}","body":"{b}"}}\n'
            for m, at, b in batch
        ]
        (tmp_path / f"m{i}.json").write_text("".join(lines))
        stamp = 1_700_000_000 + i
        import os

        os.utime(tmp_path / f"m{i}.json", (stamp, stamp))
    return (
        spark.readStream.schema("message_id STRING, enqueued_date_time TIMESTAMP_NTZ, body STRING")
        .option("maxFilesPerTrigger", 1)
        .json(str(tmp_path))
    )


def test_duplicates_within_the_delay_are_dropped(spark, tmp_path):
    stream = messages(
        spark,
        tmp_path,
        [
            [("a", "10:00:00", "1"), ("a", "10:00:05", "2"), ("b", "10:00:00", "3")],
            [("a", "10:30:00", "4"), ("c", "10:40:00", "5")],
            [("a", "12:00:00", "6"), ("b", "10:59:00", "7")],
        ],
    )
    kept = intake.dedupe(stream, ["message_id"], "enqueued_date_time", "1 hour", "dedupe")
    assert sorted(r["body"] for r in kept.collect()) == ["1", "3", "5", "6"]


def test_late_rows_are_marked_not_lost(spark, tmp_path):
    stream = messages(
        spark,
        tmp_path,
        [
            [("a", "10:00:00", ""), ("b", "08:00:00", "")],
            [("c", "09:30:00", ""), ("d", "08:59:59", ""), ("e", "12:00:00", "")],
            [("f", "10:59:00", ""), ("g", "11:30:00", "")],
        ],
    )
    split = intake.split_late(stream, "enqueued_date_time", "1 hour", "late")
    assert {r["message_id"]: r["late"] for r in split.collect()} == {
        "a": False, "b": False, "c": False, "d": True, "e": False, "f": True, "g": False,
    }


def test_intake_of_json_files(spark, tmp_path):
    bodies = {
        '{\\"activity_id\\":\\"A\\",\\"subject\\":\\"s\\"}': ("a", True),
        '{\\"test\\":\\"payload\\"}': (None, False),
        "garbage": (None, False),
    }
    (tmp_path / "m.json").write_text(
        "".join(
            f'{{"message_id":"{i}","enqueued_date_time":"2024-01-01T00:00:00","body":"{b}"}}\n'
            for i, b in enumerate(bodies)
        )
    )
    read = intake.intake_source(intake.message_files(spark, str(tmp_path)))
    got = {r["message_id"]: (r["activity_id"], r["accepted"])
           for r in streams.collect_appended(read, "intake").collect()}
    assert got == {str(i): want for i, want in enumerate(bodies.values())}


def test_orphans_over_bucket_borders(spark, tmp_path):
    base = datetime.datetime(2024, 1, 1)

    def at(hours):
        return base + datetime.timedelta(hours=hours)

    asked = [(1, "a", at(0.5)), (2, "a", at(5.9)), (3, "b", at(5.9)), (4, "c", at(1)), (9, "z", at(99))]
    answers = [("a", at(6.4)), ("b", at(12)), ("c", at(0.5)), ("z", at(99))]
    spark.createDataFrame(asked, "message_id int, activity_id string, message_time timestamp_ntz"
                          ).write.parquet(str(tmp_path / "asked"))
    spark.createDataFrame(answers, "activity_id string, attempt_time timestamp_ntz"
                          ).write.parquet(str(tmp_path / "answers"))

    def stream(name):
        path = str(tmp_path / name)
        return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)

    found = progress.orphans(stream("asked"), stream("answers"), hours=6, delay="1 hour")
    got = {r["message_id"]: r["open"] for r in found.collect()}
    assert got == {3: False, 4: False}


def test_bursts_do_not_depend_on_batches(spark, tmp_path):
    base = datetime.datetime(2024, 1, 1)
    minutes = [0, 30, 100, 170, 300, 310, 1000]
    events = [(k, base + datetime.timedelta(minutes=m), m) for k in ("a", "b") for m in minutes]
    df = spark.createDataFrame(events, "activity_id string, ts timestamp_ntz, m int")
    wants = None
    for parts in (1, 3, 7):
        folder = shared_dir(spark, "bursts")
        for live in streams.arriving(df, F.col("m") % parts, parts, "bursts-in"):
            found = progress.sessions(live, "75 minutes", folder=folder)
        got = rows(found)
        assert wants is None or got == wants
        wants = got
    assert {(r[3], r[4]) for r in wants if r[0] == "a"} == {(4, False), (2, False), (1, True)}


def test_a_busy_activity_is_folded_before_the_shuffle(spark):
    """Half of all events are of one activity; what travels is its pieces, per map task."""
    events = spark.range(0, 200_000, 1, 4).selectExpr(
        "IF(id % 2 = 0, 'hot', 'a' || id) AS activity_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id % 36000) AS ts",
    )
    width = streams.micros(spark, "2 hours")
    pieces = progress.in_pieces(events, "activity_id", "ts", width, [])
    assert pieces.filter("activity_id = 'hot'").agg(F.sum("events"), F.count("*")).first() == (100_000, 5)
    plan = final_plan(pieces)
    assert "SessionWindow" not in plan and plan.index("HashAggregate") < plan.index("Exchange hashpartitioning")
    sent = pieces.groupBy("activity_id").count().filter("activity_id = 'hot'").first()["count"]
    assert sent == 5


def test_runs_of_many_pieces(spark, monkeypatch):
    """Runs over levels of pieces equal those found one by one."""
    monkeypatch.setattr(progress, "PIECES_TOGETHER", (16, 4))
    rnd = random.Random(9)
    base = datetime.datetime(2024, 1, 1)
    events = [(k, base + datetime.timedelta(minutes=rnd.randrange(20_000)), i) for k in ("a", None) for i in range(300)]
    df = spark.createDataFrame(events, "activity_id string, ts timestamp_ntz, m int")
    folder = shared_dir(spark, "bursts")
    for live in streams.arriving(df, F.col("m") % 3, 3, "bursts-in"):
        found = progress.sessions(live, "45 minutes", folder=folder)
    want = []
    for key in ("a", None):
        times, gap = sorted(t for k, t, _ in events if k == key), datetime.timedelta(minutes=45)
        run = [times[0]]
        for t in times[1:]:
            if t - run[-1] >= gap:
                want.append((key, run[0], run[-1] + gap, len(run)))
                run = []
            run.append(t)
        want.append((key, run[0], run[-1] + gap, len(run)))
    assert rows(found.drop("open")) == sorted(want, key=repr)


def test_only_hours_in_reach_are_opened(spark, tmp_path):
    """A file that cannot be read lies in an hour that no batch asks for."""
    folder = str(tmp_path / "kept")
    given = tmp_path / "in"
    given.mkdir()
    stream = messages(spark, given, [[("a", "01:00:00", "1")]])
    first = intake.dedupe(stream, ["message_id"], "enqueued_date_time", "1 hour", "dedupe", folder)
    assert first.count() == 1
    (hour,) = (tmp_path / "kept" / "seen").glob("hour=*")
    for part in hour.rglob("*.parquet"):
        part.write_bytes(b"broken")
    stream = messages(spark, given, [[("a", "01:00:00", "1")], [("a", "04:00:00", "2"), ("a", "04:30:00", "3")]])
    again = intake.dedupe(stream, ["message_id"], "enqueued_date_time", "1 hour", "dedupe", folder)
    assert sorted(r["body"] for r in again.collect()) == ["1", "2"]


def repeats_by_hand(made, reach):
    """Bodies that stay: the message just before it of its id lies further back than ``reach``."""
    last, kept = {}, []
    for at, m, body in sorted(made):
        if m is None or m not in last or at - last[m] > reach:
            kept.append(body)
        if m is not None:
            last[m] = at
    return sorted(kept)


@pytest.mark.parametrize("batches", [1, 2, 6])
def test_repeats_do_not_depend_on_batches(spark, tmp_path, batches):
    rnd = random.Random(11)
    base = datetime.datetime(2024, 1, 1)
    seconds = sorted(rnd.sample(range(40_000), 240))
    made = [(base + datetime.timedelta(seconds=s), rnd.choice(["hot", "hot", f"m{i % 9}", None]), f"b{i}") for i, s in enumerate(seconds)]
    df = spark.createDataFrame([(m, t, b, i) for i, (t, m, b) in enumerate(made)],
                               "message_id string, enqueued_date_time timestamp_ntz, body string, i int")
    folder = str(tmp_path / "kept")
    for live in streams.arriving(df, F.floor(F.col("i") * batches / len(made)).cast("int"), batches, "in"):
        kept = intake.dedupe(live, ["message_id"], "enqueued_date_time", "20 minutes", "dedupe", folder)
    assert sorted(r["body"] for r in kept.collect()) == repeats_by_hand(made, datetime.timedelta(minutes=20))


def test_orphans_are_given_out_by_the_join(spark, tmp_path):
    base = datetime.datetime(2024, 1, 1)

    def at(hours):
        return base + datetime.timedelta(hours=hours)

    asked = [(1, "a", at(0.5)), (2, "a", at(5.9)), (3, "b", at(5.9)), (4, "c", at(1)), (5, "d", at(98)), (6, "e", at(97)),
             (7, None, at(3)), (9, "z", at(99))]
    answers = [("a", at(6.4)), ("b", at(12)), ("c", at(0.5)), ("e", at(98)), ("z", at(99))]
    spark.createDataFrame(asked, "message_id int, activity_id string, message_time timestamp_ntz"
                          ).write.parquet(str(tmp_path / "asked"))
    spark.createDataFrame(answers, "activity_id string, attempt_time timestamp_ntz"
                          ).write.parquet(str(tmp_path / "answers"))

    def stream(name):
        path = str(tmp_path / name)
        return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)

    found = progress.orphans_live(stream("asked"), stream("answers"), hours=6, delay="1 hour")
    got = {r["message_id"]: r["open"] for r in found.collect()}
    assert got == {3: False, 4: False, 5: True, 7: False}


def moves_of(spark, tmp_path, batches):
    """One file of stage events per batch: (attempt, stage, minute)."""
    import os

    base = datetime.datetime(2024, 1, 1)
    for i, batch in enumerate(batches):
        lines = [f'{{"email_instance_id":"{a}","stage_rank":{s},"event_time":"{base + datetime.timedelta(minutes=m)}"}}\n' for a, s, m in batch]
        (tmp_path / f"m{i}.json").write_text("".join(lines))
        os.utime(tmp_path / f"m{i}.json", (1_700_000_000 + i,) * 2)
    return (
        spark.readStream.schema("email_instance_id STRING, stage_rank INT, event_time TIMESTAMP_NTZ")
        .option("maxFilesPerTrigger", 1).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").json(str(tmp_path))
    )


def test_alarms_come_once_and_survive_a_restart(spark, tmp_path):
    given, folder = tmp_path / "in", str(tmp_path / "alarms")
    given.mkdir()
    batches = [
        [("a", 1, 0), ("a", 3, 60), ("b", 8, 10), ("c", 2, 0), ("d", 5, 190)],
        # d goes back before what it had; c moves on after its span, and after its alarm.
        [("c", 4, 131), ("d", 6, 135)],
        [("e", 1, 400)],
        [("a", 4, 500), ("e", 8, 450)],
        [("x", 1, 2000)],
    ]

    def alarms(n):
        base = datetime.datetime(2024, 1, 1)
        stream = moves_of(spark, given, batches[:n])
        found = progress_alarms.stuck_alarms(stream, "2 hours", "1 hour", folder)
        return sorted((r[0], r[1], (r[2] - base).total_seconds() / 60) for r in found.collect())

    first = [("c", 2, 120.0)]
    assert alarms(1) == first
    assert alarms(2) == first
    third = alarms(3)
    assert third == sorted([("a", 3, 180.0), *first, ("c", 4, 251.0), ("d", 6, 310.0)])
    last = sorted([*third, ("a", 4, 620.0)])
    assert alarms(4) == third
    assert alarms(5) == last == alarms(5)


def test_alarms_stay_in_the_engine(spark, tmp_path, monkeypatch):
    """No row goes through Python, and an event later than the watermark takes no part."""
    given, plans = tmp_path / "in", []
    given.mkdir()
    own = progress_alarms.run_available

    def seen(stream, folder):
        plans.append(stream._jdf.queryExecution().analyzed().toString())
        own(stream, folder)

    monkeypatch.setattr(progress_alarms, "run_available", seen)
    # The engine drops by the watermark of the batch before: 240 when b comes; b's idle span would go on to 320.
    stream = moves_of(spark, given, [[("a", 1, 0), ("x", 1, 300)], [("x", 1, 301)], [("b", 3, 200)], [("x", 1, 2000)]])
    found = progress_alarms.stuck_alarms(stream, "2 hours", "1 hour", str(tmp_path / "alarms"))
    assert sorted(r.email_instance_id for r in found.collect()) == ["a", "x"]
    assert plans and "Python" not in plans[0] and "PySpark" not in plans[0]


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class Unset:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.master, self.folder, self.conf, self.sparkContext = master, None, self, self

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, path):
        self.folder = f"file:{path}"


def test_only_a_local_session_makes_its_own_folder():
    local = Unset("local[2]")
    first, second = shared_dir(local, "x"), shared_dir(local, "x")
    assert first != second and first.startswith(local.folder) and second.startswith(local.folder)
    with pytest.raises(ValueError):
        shared_dir(Unset("yarn"), "x")
