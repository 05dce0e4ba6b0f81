"""Incremental maintenance of ``stg_events`` and ``fct_events`` (W-6, R-3, D-F).

Both tables are partitioned by the day an event was received and change together
in one transaction of a snapshot store (sources.snapshots): a run that dies at any
step leaves the last version as it was, and a reader sees a version whole.

A run parses its batch once, keeps the valid rows received after the high-water mark
(``max(received_ts) - 3 days``, read from the newest day alone) and upserts them by
``event_id``.  Days that are new are written straight from the batch;
days that hold a new or a replaced row are read in full and rewritten; of all other
days just the id column is read.  Valid rows that the mark excludes go to the table's
quarantine with a reason, in the same version.

Stitching follows changed keys.  The store also keeps the identity claims (identify
rows) by device and by user, the edges and memberships that follow from them, and the
days on which each device and each user has events, all in buckets by a hash of the key.
A batch's claims rewrite the buckets of their keys; comparing a bucket's edges before
and after gives the devices and users whose answer changed; the day index gives the
days of their events.  In those days only events of the batch, of changed devices or of
changed users are stitched again, the others are copied; no other day is read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelforge.operators import identity, marts, staging
from funnelforge.session import scratch_path
from funnelforge.sources.snapshots import CODEC, Snapshot, SnapshotStore, Transaction, partition_name

LOOKBACK = "INTERVAL 3 DAYS"
FLOOR = "TIMESTAMP_NTZ'1900-01-01 00:00:00'"
DAY = "received_day"
BUCKET = "bucket"
#: What identify rows claim.
CLAIM_COLUMNS = ["event_name", "anonymous_id", "user_id", "account_id", "email", "event_ts"]
#: Buckets of the tables kept by device or user.
BUCKETS = 32


class CheckFailed(RuntimeError):
    """Checks of the new version failed; nothing was published."""

    def __init__(self, failed: list[str]):
        super().__init__(", ".join(failed))
        self.failed = failed


def high_water_mark(target: DataFrame, lookback: str = LOOKBACK) -> Column:
    """R-3 / A-9: scalar ``coalesce(max(received_ts), 1900-01-01) - lookback``.

    Returned as a scalar-subquery Column, computed inside the plan that uses it; the
    newest day of the table has the maximum.
    """
    return target.agg((F.coalesce(F.max("received_ts"), F.expr(FLOOR)) - F.expr(lookback))
                      .alias("hwm")).scalar()


def excluded_rows(parsed: DataFrame, high_water: Column) -> DataFrame:
    """Valid documents that an incremental run leaves out, with the reason."""
    reason = (F.when(F.col("received_ts").isNull(), "missing_received_ts")
              .when(F.col("received_ts") <= high_water, "late_beyond_lookback"))
    return (parsed.filter(staging.is_valid_event()).withColumn("failure_reason", reason)
            .filter(F.col("failure_reason").isNotNull())
            .select("event_id", "raw_json", "failure_reason", F.lit("incremental").alias("origin"), "_loaded_at"))


def _with_day(stg: DataFrame) -> DataFrame:
    # rows without a receive time share one day of their own
    return stg.withColumn(DAY, F.coalesce(F.to_date("received_ts"), F.lit("1900-01-01").cast("date")))


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))


def _names(df: DataFrame, column: str) -> list[str]:
    """Partition names of a column's values (days or buckets: few)."""
    return [partition_name(column, r[0]) for r in df.select(column).distinct().collect()]


@dataclass
class Changes:
    """What a run did, for reports and tests."""
    rows: int = 0
    new_days: list[str] = field(default_factory=list)
    rewritten_days: list[str] = field(default_factory=list)
    fact_days: list[str] = field(default_factory=list)
    snapshot: Snapshot | None = None


class EventTable:
    """``stg_events``, its quarantine, dead letters and (with ``facts``)
    ``fct_events`` and the identity tables, kept as snapshots under ``root``."""

    def __init__(self, spark: SparkSession, root: str, facts: bool = False):
        self.spark, self.facts = spark, facts
        self.store = SnapshotStore(spark, root)

    # ---- reading
    def _published(self, table: str, helper: str, version: int | None) -> DataFrame | None:
        snapshot = self.store.latest() if version is None else self.store.at(version)
        rows = snapshot.read(table)
        return None if rows is None else rows.drop(helper)

    def current(self, version: int | None = None) -> DataFrame | None:
        return self._published("stg_events", DAY, version)

    def fct_events(self, version: int | None = None) -> DataFrame | None:
        return self._published("fct_events", DAY, version)

    def quarantine(self, version: int | None = None) -> DataFrame | None:
        return self._published("quarantine", "batch", version)

    def dead_letter(self, version: int | None = None) -> DataFrame | None:
        return self._published("dead_letter", "batch", version)

    def identity(self, table: str, version: int | None = None) -> DataFrame | None:
        """``anon_to_user`` or ``user_to_account``."""
        return self._published(table, BUCKET, version)

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # ---- one run
    def apply(self, batch_raw: DataFrame, batch: str, **options) -> Changes:
        """Merge one batch of documents (see ``apply_parsed``)."""
        return self.apply_parsed(self._stage(staging.parse_events(batch_raw), "parsed-batch"), batch, **options)

    def apply_parsed(self, parsed: DataFrame, batch: str, check: Callable[[Snapshot], list[str]] | None = None,
                     reached: Callable[[str], None] = lambda step: None, letters: DataFrame | None = None,
                     values: dict[str, object] | None = None) -> Changes:
        """Merge one batch of parsed documents (a stored table: it is read twice).

        ``batch`` names it in the quarantine, so a repeated run replaces its own
        entries.  ``check`` returns the checks that the new version fails; if any,
        nothing is published.  ``letters`` are the batch's dead letters, published with
        it; ``reached`` is told each step; ``values`` are noted with the version."""
        tx = self.store.begin()
        base = tx.base
        table = base.read("stg_events")
        mark = None if table is None else high_water_mark(base.read("stg_events", base.partitions("stg_events")[-1:]))
        fresh = self._stage(_with_day(staging.stg_from_parsed(parsed, mark)), "fresh-events")
        done = Changes()
        reached("staged")

        replaced = None
        if table is None:
            seen = tx.write("stg_events", fresh, DAY)
            done.new_days = sorted(tx.tables["stg_events"])
            tx.write("quarantine", excluded_rows(parsed, F.expr(FLOOR)).where("false").withColumn("batch", F.lit(batch)), "batch")
        else:
            tx.write("quarantine", excluded_rows(parsed, mark).withColumn("batch", F.lit(batch)), "batch")
            replaced = self._stage(self._replaceable(table).join(fresh.select("event_id"), "event_id", "left_semi"), "replaced-events")
            days, held = set(_names(fresh, DAY)), set(base.partitions("stg_events"))
            touched = sorted(days & held | set(_names(replaced, DAY)))
            done.new_days, done.rewritten_days = sorted(days - held), touched
            here = F.concat(F.lit(f"{DAY}="), F.col(DAY).cast("string")).isin(done.new_days)
            seen = tx.write("stg_events", fresh.where(here), DAY)
            reached("new days written")
            if touched:
                kept = base.read("stg_events", touched).join(fresh.select("event_id"), "event_id", "left_anti")
                again = kept.unionByName(fresh.where(~here))
                tx.drop("stg_events", touched)  # a day of which every row moved to another ends here
                done.rows += tx.write("stg_events", again, DAY)["rows"]
            reached("days rewritten")
        done.rows += seen["rows"]
        tx.values |= values or {}
        if letters is not None:
            tx.write("dead_letter", letters.withColumn("batch", F.lit(batch)), "batch")

        if self.facts:
            done.fact_days = self._restitch(tx, base, fresh, replaced)
            reached("facts written")
        if check is not None and (failed := check(tx.preview())):
            raise CheckFailed(failed)
        reached("before commit")
        done.snapshot = tx.commit()
        return done

    def _replaceable(self, table: DataFrame) -> DataFrame:
        """What a run asks of the table's rows by id: their days and, with ``facts``, what
        identify rows claim.  The whole table is dealt by id, so nothing else goes along."""
        if not self.facts:
            return table.select("event_id", DAY)
        claim = F.col("event_name") == "identify"
        return table.select("event_id", DAY, *[F.when(claim, F.col(c)).alias(c) for c in CLAIM_COLUMNS])

    # ---- stitching
    def _claims(self, tx: Transaction, base: Snapshot, table: str, key: str, columns: list[str], fresh: DataFrame,
                gone: DataFrame | None) -> list[str]:
        """Rewrite the buckets of the claims that the batch brings or replaces."""
        def claims(rows: DataFrame) -> DataFrame:
            own = rows.where((F.col("event_name") == "identify") & F.col(key).isNotNull()
                             & F.col("user_id").isNotNull()).select("event_id", "event_name", *columns)
            return _bucketed(own, key)

        new = claims(fresh)
        old = None if gone is None else claims(gone)
        touched = set(_names(new, BUCKET)) | (set(_names(old, BUCKET)) if old is not None else set())
        before = base.read(table, sorted(touched))
        rows = new if before is None else before.join(fresh.select("event_id"), "event_id", "left_anti").unionByName(new)
        tx.drop(table, sorted(touched))
        tx.write(table, rows, BUCKET)
        return sorted(touched)

    def _answers(self, tx: Transaction, base: Snapshot, table: str, key: str, found: DataFrame, touched: list[str],
                 answer: str) -> DataFrame:
        """Rewrite the touched buckets of edges or memberships; the keys whose answer
        is another than before."""
        before = base.read(table, touched)
        tx.drop(table, touched)
        tx.write(table, _bucketed(found, key), BUCKET)
        after = tx.preview().read(table, touched).select(key, F.col(answer).alias("after"))
        if before is None:
            return after.select(key)
        was = before.select(key, F.col(answer).alias("before"))
        return self._stage(after.join(was, key, "full_outer").where(~F.col("after").eqNullSafe(F.col("before"))).select(key), "changed-keys")

    def _day_index(self, tx: Transaction, base: Snapshot, table: str, key: str, fresh: DataFrame) -> None:
        """Days on which each key has events; days are only added (an entry whose
        events moved away costs a look, not a wrong answer)."""
        new = _bucketed(fresh.where(F.col(key).isNotNull()).select(key, DAY).distinct(), key)
        touched = _names(new, BUCKET)
        before = base.read(table, touched)
        rows = new if before is None else before.unionByName(new).distinct()
        tx.write(table, rows, BUCKET)

    def _restitch(self, tx: Transaction, base: Snapshot, fresh: DataFrame, gone: DataFrame | None) -> list[str]:
        """Write the fact days that the batch changes; returns them."""
        device_buckets = self._claims(tx, base, "device_claims", "anonymous_id", ["anonymous_id", "user_id", "event_ts"], fresh, gone)
        user_buckets = self._claims(tx, base, "user_claims", "user_id", ["user_id", "account_id", "email", "event_ts"], fresh, gone)
        now = tx.preview()
        devices = self._answers(tx, base, "anon_to_user", "anonymous_id",
                                identity.anon_to_user(now.read("device_claims", device_buckets)), device_buckets, "user_id")
        users = self._answers(tx, base, "user_to_account", "user_id",
                              identity.user_to_account(now.read("user_claims", user_buckets)), user_buckets, "account_id")
        self._day_index(tx, base, "device_days", "anonymous_id", fresh)
        self._day_index(tx, base, "user_days", "user_id", fresh)
        now = tx.preview()
        edges = now.read("anon_to_user").select("anonymous_id", "user_id")
        # events of a changed user may carry just a device that leads to the user
        via = edges.join(users, "user_id", "left_semi").select("anonymous_id")
        asked = self._stage(devices.unionByName(via).distinct(), "changed-devices")
        batch_days = set(_names(fresh, DAY)) | (set(_names(gone, DAY)) if gone is not None else set())
        key_days = (now.read("device_days").join(asked, "anonymous_id", "left_semi").select(DAY)
                    .unionByName(now.read("user_days").join(users, "user_id", "left_semi").select(DAY)))
        days = sorted(batch_days | set(_names(key_days, DAY)))
        stg = now.read("stg_events", days)
        if gone is None:  # the first run: every event is new
            again = stg
        else:
            touched = (fresh.select("event_id")
                       .unionByName(stg.join(asked, "anonymous_id", "left_semi").select("event_id"))
                       .unionByName(stg.join(users, "user_id", "left_semi").select("event_id")).distinct())
            touched = self._stage(touched, "events-to-stitch")
            again = stg.join(touched, "event_id", "left_semi")
        stitched = marts.fct_events(again, edges, now.read("user_to_account").select("user_id", "account_id"), keep=[DAY])
        before = None if gone is None else base.read("fct_events", days)
        if before is not None:
            stitched = before.join(touched, "event_id", "left_anti").unionByName(stitched)
        tx.drop("fct_events", days)
        tx.write("fct_events", stitched, DAY)
        return days
