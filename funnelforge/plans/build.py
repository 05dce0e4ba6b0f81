"""The batch build: raw -> silver -> gold, checked model by model, then published.

``run_warehouse`` is what a scheduled job calls.  Every run writes all models into
a folder of its own.  After each model its declared checks run; if one fails, the
models that depend on it are not built and nothing is published, so readers keep
the tables of the last good run.  Publishing commits a new version of the list of
tables by one rename, as the last step; ``published`` reads the newest version and
registers each table by its name.

Documents are parsed once: staging and the dead letter read the parsed table.  In an
incremental run the documents given are the new ones alone; events, identity tables,
facts and dead letters live in the snapshot store of operators.incremental, whose new
version is checked before it is committed and published as it is, without a copy.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelforge.operators import incremental, quality, staging
from funnelforge.plans.warehouse import GOLD_TABLES, SILVER_TABLES, Warehouse, materialized
from funnelforge.sources import bronze, sinks
from funnelforge.sources.snapshots import Snapshot, SnapshotStore

#: Models that each model reads; in build order.
READS = {
    "stg_events": [], "dead_letter": [], "stg_companies": [], "stg_contacts": [], "stg_deals": [],
    "stg_customers": [], "stg_subscriptions": [], "stg_invoices": [],
    "anon_to_user": ["stg_events"], "user_to_account": ["stg_events"],
    "account_spine": ["user_to_account", "stg_companies", "stg_customers"],
    "fct_events": ["stg_events", "anon_to_user", "user_to_account"],
    "dim_accounts": ["account_spine", "fct_events"],
    "fct_mrr_monthly": ["stg_invoices", "stg_customers"],
    "fct_ndr": ["fct_mrr_monthly"],
    "fct_revenue_attribution": ["dim_accounts", "fct_mrr_monthly"],
}


@dataclass
class PipelineResult:
    tables: dict[str, dict] = field(default_factory=dict)  # table -> where it is, as far as built
    failed_checks: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)       # models not built for a failure upstream
    published: bool = False

    @property
    def dq_failures(self) -> int:
        return len(self.failed_checks)


def _events_raw(raw: dict[str, DataFrame], streamed: DataFrame | None) -> DataFrame:
    """Landed documents and those the stream accepted, as one table."""
    landed = raw["events_raw"].select("raw_json", "_loaded_at")
    return landed if streamed is None else landed.unionByName(streamed.select("raw_json", "_loaded_at"))


#: Models kept in the snapshot store by incremental runs, and their helper columns.
KEPT = {"stg_events": incremental.DAY, "dead_letter": "batch", "anon_to_user": incremental.BUCKET,
        "user_to_account": incremental.BUCKET, "fct_events": incremental.DAY}


def build(spark: SparkSession, raw: dict[str, DataFrame], out_root: str, incremental_events: bool = False,
          run_checks: bool = True, strict_dead_letter: bool = False, streamed: DataFrame | None = None,
          stream_dead_letters: DataFrame | None = None, checks: list | None = None,
          batch: str | None = None, values: dict[str, object] | None = None) -> PipelineResult:
    """Build, check and publish silver + gold under ``out_root``.

    ``streamed`` / ``stream_dead_letters`` are what the stream routed (see
    streaming.ingest).  With ``incremental_events`` the documents and streamed rows are
    those that no run has seen; ``batch`` names the delivery, ``values`` are noted with
    the event tables' version.
    """
    root, run = out_root.rstrip("/"), uuid.uuid4().hex[:12]
    checks = (quality.DECLARED_CHECKS if checks is None else checks) if run_checks else []
    res, reports = PipelineResult(), []
    w = Warehouse(raw, strict_dead_letter=strict_dead_letter, measure_hot_keys=True)
    parsed = materialized(staging.parse_events(_events_raw(raw, streamed)), "parsed_events")
    letters = staging.dead_letter_from_parsed(parsed, strict_dead_letter).withColumn("origin", F.lit("batch"))
    if stream_dead_letters is not None:
        letters = letters.unionByName(stream_dead_letters)
    w.override("parsed_events", parsed)
    w.override("dead_letter", letters)

    counts: list[tuple[str, str, int]] = []

    def checked(name: str, seen: dict | None = None) -> list[str]:
        """Run a model's checks; the failed ones.  What was observed while the model
        was written (``seen``) is not computed again."""
        own = [c for c in checks if c.model == name]
        rows = [] if seen is None else quality.observed_report(own, seen)
        rest = [c for c in own if seen is None or c.kind != "not_null"]
        rows += [tuple(r) for r in quality.dq_report(w, rest).collect()] if rest else []  # a row per check
        reports.extend(rows)
        return [r[0] for r in rows if r[-1] == "fail"]

    blocked: set[str] = set()
    kept: dict[str, str] = {}
    if incremental_events:
        store = f"{root}/incremental/events"

        def check(snapshot: Snapshot) -> list[str]:
            for name, helper in KEPT.items():
                w.override(name, snapshot.read(name).drop(helper))
            return [f for name in KEPT for f in checked(name)]

        try:
            done = incremental.EventTable(spark, store, facts=True).apply_parsed(
                parsed, batch or run, check=check, letters=letters, values=values)
            kept = {n: {"store": store, "version": done.snapshot.version} for n in KEPT}
        except incremental.CheckFailed as e:
            res.failed_checks += e.failed
            blocked |= set(KEPT)
    else:
        w.override("stg_events", staging.stg_from_parsed(parsed))

    for name, reads in READS.items():
        if name in blocked or blocked.intersection(reads):
            blocked.add(name)
            res.skipped.append(name)
            continue
        if name in kept:
            res.tables[name] = kept[name]
            continue
        path = f"{root}/builds/{run}/{name}"
        metrics = quality.write_metrics([c for c in checks if c.model == name])
        if name == "dead_letter":
            metrics |= {f"reason {r}": F.count_if(F.col("failure_reason") == r) for r in staging.FAILURE_REASONS}
        write = sinks.write_fct_events if name == "fct_events" else sinks.full_refresh
        seen = write(getattr(w, name), path, metrics=metrics)
        counts.append((name, "rows", seen["rows"]))
        counts += [(name, k, n) for k, n in seen.items() if k.startswith("reason ") and n]
        res.tables[name] = {"path": path}
        w.override(name, _read_table(spark, name, res.tables[name]))
        if failed := checked(name, seen):
            res.failed_checks += failed
            blocked.add(name)
    if reports:
        path = f"{root}/builds/{run}/dq_report"
        sinks.full_refresh(spark.createDataFrame(reports, quality.REPORT_SCHEMA), path)
        res.tables["dq_report"] = {"path": path}
    if counts:
        path = f"{root}/builds/{run}/row_counts"
        sinks.full_refresh(spark.createDataFrame(counts, "table_name string, what string, row_count long"), path)
        res.tables["row_counts"] = {"path": path}
    if not blocked:
        tx = SnapshotStore(spark, f"{root}/published").begin()
        tx.values["tables"] = res.tables
        tx.commit()
        res.published = True
    return res


def _read_table(spark: SparkSession, name: str, at: dict) -> DataFrame:
    if "store" in at:
        return SnapshotStore(spark, at["store"]).at(at["version"]).read(name).drop(KEPT[name])
    df = spark.read.parquet(at["path"])
    return df.drop("event_date") if name == "fct_events" else df


def run_warehouse(spark: SparkSession, landing_root: str, out_root: str, incremental_events: bool = False,
                  **options) -> PipelineResult:
    """Build everything from the raw exports under ``landing_root`` (bronze spec).
    An incremental run reads only event files that came after those of the last."""
    raw = bronze.read_bronze(spark, landing_root)
    if not incremental_events:
        return build(spark, raw, out_root, **options)
    landed = f"{landing_root.rstrip('/')}/{next(s.relpath for s in bronze.BRONZE_SPECS if s.table == 'events_raw')}"
    since = SnapshotStore(spark, f"{out_root.rstrip('/')}/incremental/events").latest().values.get("landed_through")
    raw["events_raw"] = bronze.read_events_raw(spark, landed, since)
    files = spark.read.format("binaryFile").load(landed).agg(F.date_format(F.max("modificationTime"), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("t"))
    return build(spark, raw, out_root, incremental_events=True, values={"landed_through": files.first().t}, **options)


def published(spark: SparkSession, out_root: str, register_views: bool = True, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the last good build (or an earlier ``version``) by name, also as
    views for SQL users (W-4); empty before the first."""
    lists = SnapshotStore(spark, f"{out_root.rstrip('/')}/published")
    found = lists.latest() if version is None else lists.at(version)
    tables = {name: _read_table(spark, name, at) for name, at in found.values.get("tables", {}).items()}
    if register_views:
        for name, df in tables.items():
            sinks.as_view(df, name)
    return tables


def gold(spark: SparkSession, result: PipelineResult) -> Warehouse:
    """A Warehouse whose attributes read the written tables (for metrics)."""
    w = Warehouse({})
    for name in [*SILVER_TABLES, *GOLD_TABLES]:
        if name in result.tables:
            w.override(name, _read_table(spark, name, result.tables[name]))
    return w
