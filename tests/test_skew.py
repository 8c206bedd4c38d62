"""Hot groups: same results for every limit, and plans that split them."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from attemptlog.plans import folds
from attemptlog.operators import latest
from attemptlog.operators.links import lineage_parent
from attemptlog.operators.quality import sequence_breaks
from attemptlog.operators.quantiles import exact_quantiles
from attemptlog.operators.skew import join_unique, order_across, order_between, order_within, spread_nulls
from attemptlog.plans.b1_write import b1_write
from attemptlog.session import materialize
from attemptlog.sources import derived

from conftest import final_plan, rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, ties and NULLs in the order."""
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(200)}"
        place = None if rnd.random() < 0.02 else rnd.randrange(500)
        data.append((i, key, place))
    return spark.createDataFrame(data, "id int, k string, place int").repartition(8, "id")


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_order_within_equals_a_plain_window(skewed, levels):
    pieces = [
        F.floor(F.col("place") / 50), F.col("place"), F.struct("place", F.floor(F.col("id") / 16))
    ][:levels]
    w = Window.partitionBy("k").orderBy("place", "id")
    want = skewed.select(
        "id", "k", "place", F.row_number().over(w).cast("long"), F.lag("id").over(w),
        F.lag("place").over(w),
    )
    got = order_within(
        skewed, ["k"], ["place", "id"], pieces, "n", {"before": "id", "before_place": "place"}
    )
    assert rows(got) == rows(want)


def test_order_within_a_burst_at_one_time(skewed):
    """One key and one second hold most rows; no task gets them all."""
    one = skewed.withColumn("place", F.when(F.col("id") % 5 != 0, 1).otherwise(F.col("place")))
    w = Window.partitionBy("k").orderBy("place", "id")
    pieces = [F.col("place"), F.struct("place", F.floor(F.col("id") / 100))]
    got = order_within(one, ["k"], ["place", "id"], pieces, "n")
    assert rows(got) == rows(one.withColumn("n", F.row_number().over(w).cast("long")))


def test_order_across_equals_a_plain_window(spark, skewed):
    w = Window.partitionBy("k").orderBy("place", "id")
    want = skewed.select(
        "id", "k", "place", F.row_number().over(w).cast("long"), F.lag("id").over(w), F.lag("place").over(w)
    )
    switch = "spark.sql.adaptive.coalescePartitions.enabled"
    for together in ("true", "false"):
        spark.conf.set(switch, together)
        try:
            got = order_across(skewed, ["k"], ["place", "id"], "n", {"before": "id", "before_place": "place"})
            assert rows(got) == rows(want)
        finally:
            spark.conf.unset(switch)
    none = skewed.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    plain = none.select("id", F.row_number().over(w).cast("long"))
    assert rows(order_across(none, ["k"], ["place", "id"], "n").select("id", "n")) == rows(plain)
    assert order_across(skewed.limit(0), ["k"], ["place", "id"], "n").count() == 0


def test_order_between_equals_a_plain_window(spark, skewed):
    """NULL keys too; ranges cut the busy key, and its rows are shuffled once."""
    none = skewed.withColumn("k", F.when(F.col("id") % 17 != 0, F.col("k")))
    w = Window.partitionBy("k").orderBy("place", "id")
    want = none.select(
        "id", "k", "place", F.row_number().over(w).cast("long"), F.lag("id").over(w), F.lag("place").over(w)
    )
    got = order_between(none, ["k"], ["place", "id"], "n", {"before": "id", "before_place": "place"})
    assert rows(got) == rows(want)
    assert final_plan(got).count("Exchange hashpartitioning") == 1
    assert final_plan(derived.attempts(spark, "/root/testdata/sf0.001")).count("Exchange hashpartitioning") == 1
    few = none.filter("id < 40")
    for part in (few, few.limit(1), few.limit(0)):
        part = materialize(part, "part")
        plain = part.select("id", F.row_number().over(w).cast("long"))
        assert rows(order_between(part, ["k"], ["place", "id"], "n").select("id", "n")) == rows(plain)


def test_one_prefix_and_one_second_are_cut(spark, monkeypatch):
    """Most rows are of one key and one second, their ids begin alike: each range has its share."""
    from attemptlog.operators import skew

    kept = []
    monkeypatch.setattr(skew, "materialize", lambda df, name: kept.append(own(df, name)) or kept[-1])
    own = materialize
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        log = spark.range(0, 40_000, 1, 4).selectExpr(
            "'prefix-' || lpad(id, 9, '0') AS email_instance_id", "IF(id % 10 < 9, 'hot', 'a' || id) AS activity_id",
            "CAST(id AS INT) AS attempt_number", "timestamp_ntz'2024-01-01' AS created_date_time",
        )
        out = latest.attempt_history(log).filter("activity_id = 'hot'")
        assert out.agg(F.min("recency"), F.max("recency"), F.count_distinct("recency")).first() == (1, 36_000, 36_000)
        hot = kept[0].filter("activity_id = 'hot'").groupBy("_range").count()
        assert hot.count() >= 6 and hot.agg(F.max("count")).first()[0] < 36_000 / 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_way_for_every_key():
    """No size decides how a key is treated."""
    import inspect

    from attemptlog.operators import skew

    text = inspect.getsource(skew)
    for word in ("HOT", "limit(", "broadcast(", "SALT"):
        assert word not in text


def test_retry_gap_shuffles_rows_once_after_they_are_ranged(spark, sf, tmp_path):
    derived.attempts(spark, sf).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    plan = final_plan(latest.retry_gap(log))
    # Of the rows, and of the spans of keys, which one range may hold all of.
    assert plan.count("Scan parquet") <= 2 and plan.count("Exchange hashpartitioning") <= 3, plan


def test_lineage_lookup_is_a_plain_semi_join(spark, sf, tmp_path):
    from attemptlog.operators import lookups

    derived.attempts(spark, sf).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    plan = final_plan(lookups.lineage_lookup(log, lookups.failed(log)))
    assert plan.count("Scan parquet") == 2
    assert "Exchange hashpartitioning" not in plan


def test_retry_gap_spans_missing_numbers(spark):
    log = spark.sql(
        """SELECT * FROM VALUES ('a1','a',1,TIMESTAMP_NTZ'2024-01-01 00:00:00'),
        ('a5','a',5,TIMESTAMP_NTZ'2024-01-01 00:00:30') AS
        t(email_instance_id, activity_id, attempt_number, created_date_time)"""
    )
    got = {r["attempt_number"]: r["gap_seconds"] for r in latest.retry_gap(log).collect()}
    assert got == {1: None, 5: 30.0}


def test_latest_attempt_prunes_before_the_shuffle(spark, sf):
    plan = final_plan(latest.latest_attempt(derived.attempts(spark, sf)))
    partial, exchange = plan.index("Partial"), plan.rindex("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") == 2 and partial > 0 and exchange > 0


def test_latest_forms_agree(spark, sf):
    log = derived.attempts(spark, sf).select(
        "activity_id", "email_instance_id", "attempt_number", "status_code"
    )
    window = rows(latest.latest_attempt(log).select("email_instance_id", "status_code"))
    assert window == rows(latest.latest_join(log).select("email_instance_id", "status_code"))
    packed = latest.latest_columns(log, ["email_instance_id", "status_code"])
    assert window == rows(packed.select("email_instance_id", "status_code"))


def test_latest_join_keeps_ties(spark):
    log = spark.createDataFrame(
        [("x", "a", 2), ("y", "a", 2), ("z", "a", 1)],
        "email_instance_id string, activity_id string, attempt_number int",
    )
    assert latest.latest_join(log).count() == 2
    assert latest.latest_attempt(log).first()["email_instance_id"] == "y"


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_join_unique_equals_a_plain_join(spark, skewed, how):
    left = skewed.withColumn("k", F.when(F.col("id") % 50 != 7, F.col("k")))
    right = spark.createDataFrame(
        [("hot", 1), *[(f"k{i}", i) for i in range(0, 300, 2)]], "k string, v int"
    )
    got = join_unique(left, right, ["k"], how)
    assert rows(got) == rows(left.join(right, ["k"], how))


def test_join_unique_lets_a_hot_key_be_split(spark):
    """A third of the requests ask for one activity; the other side comes from a ranking."""
    switches = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for key, value in switches.items():
        spark.conf.set(key, value)
    try:
        asked = spark.range(0, 60000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("request_id"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), "id")).alias("k"),
        )
        log = spark.createDataFrame([("hot", 1), ("hot", 2), ("a1", 2)], "k string, v int")
        newest = Window.partitionBy("k").orderBy(F.desc("v"))
        right = log.withColumn("r", F.row_number().over(newest)).filter("r = 1").drop("r")
        joined = join_unique(asked, right, ["k"], "left")
        assert "skew=true" in final_plan(joined)
        assert joined.filter("v = 2").count() == 20001
    finally:
        for key in switches:
            spark.conf.unset(key)


def test_adaptive_split_of_a_hot_parent(spark):
    """Two plain scans: adaptive execution cuts the hot key itself."""
    switches = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for key, value in switches.items():
        spark.conf.set(key, value)
    try:
        log = spark.range(0, 60000, 1, 8).select(
            F.concat(F.lit("i"), "id").alias("email_instance_id"),
            F.when(F.col("id") % 3 == 1, "i0").alias("previous_email_instance_id"),
            F.lit(1).alias("attempt_number"),
            F.lit(9).alias("status_code"),
            F.sha2(F.col("id").cast("string"), 256).alias("last_completed_stage"),
        )
        joined = lineage_parent(log)
        assert "skew=true" in final_plan(joined)
        assert joined.filter("parent_attempt_number = 1").count() == 20000
    finally:
        for key in switches:
            spark.conf.unset(key)


def test_copies_of_one_attempt_are_split_and_not_multiplied(spark):
    switches = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for key, value in switches.items():
        spark.conf.set(key, value)
    try:
        copy = F.col("id") % 3 == 0
        log = spark.range(0, 60000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("email_instance_id"),
            F.when(copy, "a").otherwise(F.concat(F.lit("a"), "id")).alias("activity_id"),
            F.when(copy, 2).otherwise(1).alias("attempt_number"),
            F.lit(None).cast("string").alias("previous_email_instance_id"),
        )
        breaks = sequence_breaks(log)
        assert "skew=true" in final_plan(breaks)
        assert rows(breaks.groupBy("problem").count()) == [("gap", 20000)]
    finally:
        for key in switches:
            spark.conf.unset(key)


def test_null_keys_are_spread(spark):
    df = spark.range(0, 8000, 1, 4).select(
        "id", F.when(F.col("id") % 2 == 0, F.col("id") - 1).alias("p")
    )
    spread = df.select(spread_nulls(F.col("p"), F.col("id")).alias("k")).repartition(8, "k")
    sizes = [r[0] for r in spread.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def interpolated(values, q):
    values = sorted(values)
    spot = q * (len(values) - 1)
    low = int(spot)
    high = min(low + 1, len(values) - 1)
    return values[low] + (spot - low) * (values[high] - values[low])


@pytest.mark.parametrize("widths", [(1,), (7, 1), (10_000, 100, 1)])
def test_quantiles_equal_brute_force(spark, widths):
    rnd = random.Random(3)
    data = [
        (g, None if rnd.random() < 0.05 else rnd.choice([5, rnd.randrange(-50_000, 50_000)]))
        for g in ("a", "b", "c") for _ in range(rnd.randrange(1, 400))
    ] + [("one", 42)]
    df = spark.createDataFrame(data, "g string, v long")
    wanted = {"q0": 0.0, "q5": 0.5, "q95": 0.95, "q1": 1.0}
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", wanted, widths).collect()}
    for g in ("a", "b", "c", "one"):
        values = [v for k, v in data if k == g and v is not None]
        assert got[g]["n"] == len(values)
        for name, q in wanted.items():
            assert got[g][name] == pytest.approx(interpolated(values, q))
    whole = exact_quantiles(df, [], "v", {"q": 0.5}, widths).first()
    assert whole["q"] == pytest.approx(interpolated([v for _, v in data if v is not None], 0.5))


@pytest.mark.parametrize("accuracy,together", [(1000, (1 << 40, 1 << 20)), (10, (64, 8))])
def test_selected_quantiles_equal_brute_force(spark, monkeypatch, accuracy, together):
    from attemptlog.operators import quantiles

    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "COUNTED_WHOLE", 4 * accuracy)
    monkeypatch.setattr(quantiles, "VALUES_TOGETHER", together)
    rnd = random.Random(8)
    data = [
        (g, None if rnd.random() < 0.05 else rnd.choice([5, 7, rnd.randrange(-50_000, 50_000)]))
        for g in ("a", "b", None, "c") for _ in range(rnd.randrange(1, 900))
    ] + [("one", 42), ("none", None), ("two", 1), ("two", 4)]
    df = spark.createDataFrame(data, "g string, v long")
    wanted = {"q0": 0.0, "q5": 0.5, "q95": 0.95, "q1": 1.0}
    got = {r["g"]: r for r in quantiles.selected_quantiles(df, ["g"], "v", wanted).collect()}
    assert set(got) == {"a", "b", "c", None, "one", "two"}
    for g in got:
        values = [v for k, v in data if k == g and v is not None]
        assert got[g]["n"] == len(values)
        for name, q in wanted.items():
            assert got[g][name] == pytest.approx(interpolated(values, q))
    whole = quantiles.selected_quantiles(df, [], "v", {"q": 0.37}).first()
    assert whole["q"] == pytest.approx(interpolated([v for _, v in data if v is not None], 0.37))


def test_selected_quantiles_read_twice(spark, tmp_path):
    from attemptlog.operators import quantiles

    spark.range(20_000).selectExpr("id % 3 AS g", "id * id % 7919 AS v").write.parquet(str(tmp_path / "t"))
    plan = final_plan(quantiles.selected_quantiles(spark.read.parquet(str(tmp_path / "t")), ["g"], "v", {"p": 0.5, "r": 0.9}))
    assert plan.count("Scan parquet") + plan.count("FileScan parquet") <= 2 * 2 and "Window" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_attempts_without_a_case_do_not_meet(spark):
    log = spark.range(4000).selectExpr(
        "id AS email_instance_id", "IF(id % 4 = 0, id, NULL) AS crm_case_id", "'s' AS agent_subject",
        "id % 10 = 0 AS banker_modified_flag",
    )
    cases = spark.range(4000).selectExpr("id AS crm_case_id", "IF(id % 8 = 0, 't', 's') AS case_subject")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        out = folds.feedback_flags(log, cases, {"agent_subject": "case_subject"})
        sizes = out.rdd.glom().map(len).collect()
        flagged = out.filter("banker_modified_flag").count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 4000 and max(sizes) < 1000
    assert flagged == sum(i % 10 == 0 or i % 8 == 0 for i in range(4000))
