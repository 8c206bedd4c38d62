"""A stored attempt log that is cheap to ask, to change and to append to.

Folders below its path:

- ``rows/batch=B/created_day=D``: the attempts, ids in their one spelling, sorted by activity,
  with Bloom filters on the id columns: filters on an id skip row groups.
- ``keys/batch=B/kind=K``: the day of every id, case and (activity, attempt). An update opens
  only the days that hold what it touches, a check reads two columns instead of the log.
- ``latest``: a table bucketed by activity, to which each batch adds its latest attempts. The
  latest of all is found without a shuffle.
- ``rejected/batch=B``: rows a batch could not add, with the rules they break.
- ``done/batch=B``: an empty folder; the table of latest attempts has what the batch adds.

A batch has a name; names sort in the order in which batches are written. Rows become visible
by renaming one folder. Writing a batch again, in part or whole, leaves the same rows: what
is stored already is kept, the rest is completed from it.
"""

from __future__ import annotations

import contextlib
import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from attemptlog.operators import lookups
from attemptlog.operators.quality import Rule, failed_rules
from attemptlog.operators.skew import join_unique
from attemptlog.plans.b1_write import in_line, numbered, reusable_from, written
from attemptlog.plans.folds import feedback_flags, stage_fold
from attemptlog.plans.status_view import with_derived
from attemptlog.session import exists, make_folder, materialize, remove, rename, shared_dir
from attemptlog.sources.schemas import EMAIL_INSTANCE
from attemptlog.sources.tables import DAY, ID_COLUMNS, canonical, conform

BATCH = "batch"
STORED = StructType([*EMAIL_INSTANCE.fields, StructField(BATCH, StringType()), StructField(DAY, DateType())])
KEY_COLUMNS = f"key STRING, {DAY} DATE, {BATCH} STRING, kind STRING"
#: Kinds of keys: an attempt's id, its case, its place in its activity, its activity.
ID, CASE, PLACE, ACTIVITY = "id", "case", "place", "activity"
NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9.-]*")
BROKEN, ROW = "broken", "_row"
PARTITIONS = "spark.sql.shuffle.partitions"
KEY_RULES = ("chk_pk", "chk_activity_attempt", "chk_fk_previous")
Keep = Callable[[DataFrame, str], DataFrame]


def _blooms(columns: Iterable[str]) -> dict[str, str]:
    """Write options: Bloom filters sized by the values that come."""
    on = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {"parquet.bloom.filter.adaptive.enabled": "true", **on}


@contextlib.contextmanager
def _shuffled_into(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Queries that start in here shuffle into so many partitions."""
    own = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, partitions)
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, own)


def _place(activity: str, attempt: str):
    return F.concat(F.col(activity), F.lit("#"), F.col(attempt).cast("string"))


class LogStore:
    """One stored log. ``buckets`` holds for the life of its folder."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        for part in ("rows", "keys", "latest", "rejected"):
            make_folder(spark, f"{self.path}/{part}")
        self.table = "latest_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EMAIL_INSTANCE)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, {BATCH} string) USING parquet "
            f"PARTITIONED BY ({BATCH}) CLUSTERED BY (activity_id) SORTED BY (activity_id) "
            f"INTO {buckets} BUCKETS LOCATION '{self.path}/latest'"
        )
        spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        self.buckets = buckets

    # Reading

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(f"{self.path}/rows")

    def log(self) -> DataFrame:
        """All attempts; filters on ids and days reach the files."""
        return self._rows().select(*EMAIL_INSTANCE.names)

    def rejected(self) -> DataFrame:
        """Rows turned away, with the rules they break and the batch they came in."""
        broken = StructType([*EMAIL_INSTANCE.fields, StructField(BROKEN, StringType()), StructField(BATCH, StringType())])
        return self.spark.read.schema(broken).parquet(f"{self.path}/rejected")

    def _keys(self, kind: str) -> DataFrame:
        return self.spark.read.schema(KEY_COLUMNS).parquet(f"{self.path}/keys").filter(F.col("kind") == kind)

    def attempts_of(self, activities: DataFrame) -> DataFrame:
        """All attempts of the given activities."""
        return lookups.attempts_of_activity(self.log(), canonical(activities), lookups.SHORT)

    def retries_of(self, sources: DataFrame) -> DataFrame:
        """Retries that took their data from the given attempts."""
        return lookups.lineage_lookup(self.log(), canonical(sources), lookups.SHORT)

    def failed_of(self, pairs: DataFrame) -> DataFrame:
        """Failed attempts by subject and activity."""
        return lookups.subject_filter(self.log(), canonical(pairs), lookups.SHORT)

    def days_of(self, kind: str, wanted: DataFrame) -> list:
        """Days on which the wanted keys (a column ``key``) have a row: as many as there are days."""
        found = lookups.having(self._keys(kind), wanted.select("key"), lookups.SHORT)
        return [row[DAY] for row in found.select(DAY).distinct().collect()]

    # The latest attempts

    def latest(self) -> DataFrame:
        """The highest attempt of each activity, without a shuffle.

        Of copies the one with the highest id counts, of its versions the last written.
        """
        newest = Window.partitionBy("activity_id").orderBy(
            F.desc("attempt_number"), F.desc("email_instance_id"), F.desc(BATCH)
        )
        ranked = self.spark.table(self.table).withColumn("_rank", F.row_number().over(newest))
        return ranked.filter("_rank = 1").drop("_rank", BATCH)

    def status_view(self) -> DataFrame:
        """The latest attempts with their computed columns."""
        return with_derived(self.latest())

    def _latest_of(self, keyed: DataFrame, columns: list[str]) -> DataFrame:
        """The latest attempts of the activities of ``keyed``: these travel, the log does not."""
        asked = keyed.select("activity_id").distinct()
        return self.latest().select("activity_id", *columns).join(asked, "activity_id", "left_semi")

    def queue_latest(self, queue_items: DataFrame) -> DataFrame:
        """Queue items with the latest attempt of their activity."""
        items = canonical(queue_items)
        columns = ["email_instance_id", "attempt_number", "status_code", "last_completed_stage"]
        return join_unique(items, self._latest_of(items, columns), ["activity_id"], "left")

    def request_prior(self, requests: DataFrame) -> DataFrame:
        """Each request with its activity's latest attempt, if any, and what a retry may use of it."""
        asked = canonical(requests)
        prior = reusable_from(self._latest_of(asked, [c for c in EMAIL_INSTANCE.names if c != "activity_id"]))
        return join_unique(asked, prior, ["activity_id"], "left")

    def b1_write(self, requests: DataFrame) -> DataFrame:
        """Attempt rows to append for a batch of requests; of the log only latest attempts are read."""
        return written(numbered(self.request_prior(in_line(requests))))

    def _add_latest(self, rows: DataFrame, batch: str) -> None:
        """Replace what a batch adds to the table of latest attempts."""
        newest = Window.partitionBy("activity_id").orderBy(F.desc("attempt_number"), F.desc("email_instance_id"))
        own = rows.select(*EMAIL_INSTANCE.names).withColumn("_rank", F.row_number().over(newest))
        # The ranking's own shuffle is into as many partitions as the table has buckets.
        with _shuffled_into(self.spark, self.buckets):
            self._overwrite_latest(own.filter("_rank = 1").drop("_rank"), batch)

    def _overwrite_latest(self, rows: DataFrame, batch: str) -> None:
        view = f"rows_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        columns = ", ".join(EMAIL_INSTANCE.names)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION ({BATCH} = '{batch}') SELECT {columns} FROM {view}")
        self.spark.catalog.dropTempView(view)

    def compact_latest(self) -> None:
        """Merge what all batches added into one partition, under the name of the last.

        Until the older partitions are gone they hold what the merged one holds too.
        """
        names = sorted(row["partition"].partition("=")[2] for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect())
        if len(names) < 2:
            return
        merged = materialize(self.latest(), "latest")
        self._overwrite_latest(merged.repartition(self.buckets, "activity_id"), names[-1])
        for name in names[:-1]:
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({BATCH} = '{name}')")
            remove(self.spark, f"{self.path}/latest/{BATCH}={name}")

    # Writing

    def append(self, rows: DataFrame, batch: str, rules: Iterable[Rule] = ()) -> None:
        """Add a batch of attempts; rows that break a rule or a key are stored apart.

        A row breaks ``chk_not_null`` without an id, activity, attempt number or creation time,
        ``chk_pk`` and ``chk_activity_attempt`` if another row of the batch, or of a batch before,
        has its id or its place, and ``chk_fk_previous`` if the attempt it names as its previous is
        in neither. Of rows of one batch that clash none is added.
        """
        self._named(batch)
        if not exists(self.spark, f"{self.path}/rows/{BATCH}={batch}"):
            given = materialize(self._given(conform(canonical(rows), EMAIL_INSTANCE), list(rules)), "given")
            clashes = materialize(self._clashes(given, batch, materialize), "clashes")
            judged = self._named_broken(given, clashes)
            # Where no row broke a rule, what is written already is what is stored.
            if not given.filter(F.size(BROKEN) > 0).isEmpty() or not clashes.isEmpty():
                judged = materialize(judged, "judged")
            else:
                judged = given.drop(ROW)
            bad = judged.filter(F.size(BROKEN) > 0).withColumn(BROKEN, F.array_join(BROKEN, ","))
            self._replace(bad, f"rejected/{BATCH}={batch}")
            good = judged.filter(F.size(BROKEN) == 0).drop(BROKEN).withColumn(DAY, F.to_date("created_date_time"))
            self._write_keys(good, batch)
            staged = f"{self.path}/rows/_{batch}-{uuid.uuid4().hex}"
            self._write_days(good, staged, [DAY])
            make_folder(self.spark, staged)
            rename(self.spark, staged, f"{self.path}/rows/{BATCH}={batch}")
        done = f"{self.path}/done/{BATCH}={batch}"
        if not exists(self.spark, done):
            self._add_latest(self._rows().filter(F.col(BATCH) == batch), batch)
            make_folder(self.spark, done)

    @staticmethod
    def _named(batch: str) -> None:
        if not NAME.fullmatch(batch):
            raise ValueError(f"a batch is named by letters, digits, dots and dashes: {batch!r}")

    def _replace(self, rows: DataFrame, part: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{part}")

    def _write_days(self, rows: DataFrame, target: str, by: list[str], mode: str = "error") -> None:
        """Few files a day, sorted by activity; large days are cut."""
        (
            rows.hint("rebalance", *by)
            .sortWithinPartitions(*by, "activity_id")
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .options(**_blooms(ID_COLUMNS))
            .partitionBy(*by)
            .parquet(target)
        )

    def _write_keys(self, rows: DataFrame, batch: str) -> None:
        """The days of all keys of a batch's rows, sorted so that a lookup skips what is in a file.

        Each task writes the keys of its rows: nothing is shuffled, and a key of several rows repeats.
        """
        named = {
            ID: F.col("email_instance_id"),
            CASE: F.col("crm_case_id"),
            PLACE: _place("activity_id", "attempt_number"),
            ACTIVITY: F.col("activity_id"),
        }
        for kind, key in named.items():
            (
                rows.select(key.alias("key"), DAY)
                .filter("key IS NOT NULL")
                .sortWithinPartitions("key")
                .write.mode("overwrite")
                .options(**_blooms(["key"]))
                .parquet(f"{self.path}/keys/{BATCH}={batch}/kind={kind}")
            )

    def _known(self, kind: str, keys: DataFrame, batch: str) -> DataFrame:
        """Those of ``keys`` that batches other than ``batch`` have stored.

        A short list becomes a filter that skips row groups; a longer one is sent to the
        tasks that read the keys, or joined, by its measured size.
        """
        stored = self._keys(kind).filter(F.col(BATCH) != batch).select("key")
        return lookups.having(stored, keys.select("key"), lookups.SHORT).distinct()

    def _judged(self, rows: DataFrame, batch: str, rules: list[Rule], keep: Keep = lambda df, _: df) -> DataFrame:
        """Rows with the names of the rules they break.

        Only the keys travel; ``keep`` writes what is read several times, so that the rows are worked
        out once and meet nothing but the rows that break a key.
        """
        given = keep(self._given(rows, rules), "given")
        return self._named_broken(given, keep(self._clashes(given, batch, keep), "clashes"))

    @staticmethod
    def _named_broken(given: DataFrame, clashes: DataFrame) -> DataFrame:
        judged = join_unique(given, clashes, [ROW], "left").drop(ROW)
        none = F.array().cast("array<string>")
        return judged.withColumn(BROKEN, F.concat(BROKEN, F.coalesce("_names", none))).drop("_names")

    @staticmethod
    def _given(rows: DataFrame, rules: list[Rule]) -> DataFrame:
        """Rows with a number each and the names of the rules they break by themselves."""
        none = F.array().cast("array<string>")
        names = F.transform(failed_rules(rules), lambda v: v["rule"]) if rules else none
        required = ("email_instance_id", "activity_id", "attempt_number", "created_date_time")
        missing = F.greatest(*[F.col(c).isNull() for c in required])
        null = F.when(missing, F.array(F.lit("chk_not_null"))).otherwise(none)
        return rows.withColumn(BROKEN, F.concat(names, null)).withColumn(ROW, F.monotonically_increasing_id())

    def _clashes(self, given: DataFrame, batch: str, keep: Keep) -> DataFrame:
        """The rows that break a key, by number, with the names of these keys."""
        found = []
        for name, kind, key in (
            ("chk_pk", ID, F.col("email_instance_id")),
            ("chk_activity_attempt", PLACE, _place("activity_id", "attempt_number")),
        ):
            own = given.select(ROW, key.alias("key")).filter("key IS NOT NULL")
            twice = own.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
            # Written first, so that the rows are shuffled for it only where it is large.
            taken = keep(self._known(kind, own, batch).unionByName(twice).distinct(), f"taken-{kind}")
            found.append(join_unique(own, taken, ["key"], "left_semi").select(ROW, F.lit(name).alias("name")))
        parents = given.select(ROW, F.col("previous_email_instance_id").alias("key")).filter("key IS NOT NULL")
        mine = given.select(F.col("email_instance_id").alias("key")).filter("key IS NOT NULL")
        # Most parents are in the batch itself; only the others are looked for in those before.
        outside = keep(parents.join(mine, "key", "left_anti"), "parents")
        lost = join_unique(outside, self._known(ID, outside, batch), ["key"], "left_anti")
        found.append(lost.select(ROW, F.lit("chk_fk_previous").alias("name")))
        order = F.array(*[F.lit(n) for n in KEY_RULES])
        names = found[0].unionByName(found[1]).unionByName(found[2]).groupBy(ROW).agg(F.collect_set("name").alias("_names"))
        return names.withColumn("_names", F.filter(order, lambda n: F.array_contains("_names", n)))

    def without_parent(self, children: DataFrame) -> DataFrame:
        """Queue items or attachments whose activity has no attempt in the log."""
        asked = canonical(children)
        wanted = asked.select(F.col("activity_id").alias("key")).filter("key IS NOT NULL")
        known = self._known(ACTIVITY, wanted, "").withColumnRenamed("key", "activity_id")
        return join_unique(asked.filter("activity_id IS NOT NULL"), known, ["activity_id"], "left_anti")

    # Changing

    def _of_days(self, days: list) -> DataFrame:
        """The rows of some days; the others are not opened."""
        return self._rows().filter(F.col(DAY).isin(days) if days else F.lit(False))

    def _swap(self, days: list, changed: Callable[[DataFrame], DataFrame], read: list[str], columns: list[str], batch: str) -> None:
        """Store ``columns`` as ``changed`` makes them, of the rows of some days, by replacing the days that differ.

        What differs is found from the columns that ``changed`` needs to ``read``, so a change that is
        stored already moves no whole row. The table of latest attempts comes first: should the job end
        between the two, the next run still finds the difference in the rows and completes it.
        """
        self._named(batch)
        same = F.lit(True)
        for c in columns:
            same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))

        def compared(rows: DataFrame) -> DataFrame:
            before = rows.withColumns({f"_old_{c}": F.col(c) for c in columns})
            return changed(before).withColumn("_changed", ~same).drop(*[f"_old_{c}" for c in columns])

        narrow = self._of_days(days).select(*dict.fromkeys([*read, *columns, BATCH, DAY]))
        hit = [(r[BATCH], r[DAY]) for r in compared(narrow).filter("_changed").select(BATCH, DAY).distinct().collect()]
        if not hit:
            return
        held = F.lit(False)
        for b in {b for b, _ in hit}:
            held = held | ((F.col(BATCH) == b) & F.col(DAY).isin([d for name, d in hit if name == b]))
        after = materialize(compared(self._rows().filter(held)), "after")
        self._add_latest(after.filter("_changed"), batch)
        self._write_days(after.drop("_changed"), f"{self.path}/rows", [BATCH, DAY], "overwrite")

    def fold(self, events: DataFrame, batch: str) -> None:
        """Write stage-completion events into the stored attempts; only their days are read."""
        events = canonical(events)
        columns = ["last_completed_stage", "status_code", "modified_date_time"]
        days = self.days_of(ID, events.select(F.col("email_instance_id").alias("key")))
        self._swap(days, lambda before: stage_fold(before, events), ["email_instance_id"], columns, batch)

    def flag_feedback(self, cases: DataFrame, fields: dict[str, str], batch: str) -> None:
        """Set the flag of stored attempts whose case a banker has changed; only their days are read."""
        cases = canonical(cases)
        days = self.days_of(CASE, cases.select(F.col("crm_case_id").alias("key")))
        read = ["crm_case_id", *fields]
        flagged = lambda before: feedback_flags(before, cases, fields).drop("_changed")
        self._swap(days, flagged, read, ["banker_modified_flag"], batch)


def open_store(spark: SparkSession, name: str, buckets: int = 64) -> LogStore:
    """A new store in the shared folder."""
    return LogStore(spark, shared_dir(spark, name), buckets)
