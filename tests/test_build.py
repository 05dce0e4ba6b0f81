"""The batch build writes every table, passes its checks, and answers the
golden questions exactly like the lazy model graph."""

import pytest

from funnelforge.operators import quality
from funnelforge.plans import build, metrics
from funnelforge.plans.warehouse import GOLD_TABLES, SILVER_TABLES, Warehouse
from funnelforge.sources import bronze, sinks, testdata
from funnelforge.streaming import ingest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("incremental_events", [False, True])
def test_build_matches_lazy_graph(spark, tmp_path, incremental_events):
    raw = testdata.raw_tables(spark, SF)
    res = build.build(spark, raw, str(tmp_path / "wh"), incremental_events=incremental_events)
    assert set(GOLD_TABLES) <= set(res.tables)
    assert res.dq_failures == 0
    on_tables = metrics.golden(build.gold(spark, res))
    lazy = metrics.golden(Warehouse(raw))
    for name in ["g1_mrr_last_month", "g3_top_channel_revenue", "g6_paying_accounts",
                 "g10_events_stitched", "g12_mrr_by_month", "g15_mobile_events_share"]:
        assert sorted(on_tables[name].collect()) == sorted(lazy[name].collect()), name


def test_failed_check_keeps_the_published_tables(spark, tmp_path):
    raw = testdata.raw_tables(spark, SF)
    root = str(tmp_path / "wh")
    assert build.published(spark, root) == {}
    first = build.build(spark, raw, root)
    assert first.published and not first.skipped
    failing = [quality.Check("unique", "account_spine", "account_spine", ("is_crm_matched",))]
    second = build.build(spark, raw, root, checks=failing)
    assert not second.published and second.dq_failures == 1
    assert second.skipped == ["dim_accounts", "fct_revenue_attribution"]
    tables = build.published(spark, root)
    assert set(tables) == set(SILVER_TABLES) | set(GOLD_TABLES) | {"dq_report", "row_counts"}
    counted = {r.table_name: r.row_count for r in tables["row_counts"].where("what = 'rows'").collect()}
    assert counted == {n: df.count() for n, df in tables.items() if n in counted} and len(counted) == 16
    reasons = {r.what.removeprefix("reason "): r.row_count for r in tables["row_counts"].where("what <> 'rows'").collect()}
    assert reasons == {r.failure_reason: r["count"] for r in tables["dead_letter"].groupBy("failure_reason").count().collect()}
    checks = {r.check_id: r.status for r in tables["dq_report"].collect()}
    assert len(checks) == 21 and set(checks.values()) == {"pass"}
    assert spark.sql("SELECT count(*) FROM fct_revenue_attribution").first()[0] >= 1


def test_streamed_documents_reach_the_models(spark, tmp_path):
    raw = testdata.raw_tables(spark, SF)
    docs = raw["events_raw"].select("raw_json")
    ingest.route_batch(docs, 0, str(tmp_path / "stream"))
    nothing = dict(raw, events_raw=raw["events_raw"].limit(0))
    res = build.build(spark, nothing, str(tmp_path / "wh"), run_checks=False,
                      streamed=ingest.streamed_events(spark, str(tmp_path / "stream")),
                      stream_dead_letters=ingest.stream_dead_letters(spark, str(tmp_path / "stream")))
    w = build.gold(spark, res)
    assert w.stg_events.count() > 0
    origins = {r.origin for r in w.dead_letter.select("origin").distinct().collect()}
    assert "stream" in origins


def test_full_refresh_drops_old_days_and_splits_hot_ones(spark, tmp_path):
    fct = spark.range(4000).selectExpr("concat('e', id) AS event_id",
                                       "TIMESTAMP_NTZ'2025-01-01 00:00:00' + make_interval(0,0,0, cast(if(id < 5, 1, 0) AS int)) AS event_ts",
                                       "repeat('x', 300) AS page")
    path = str(tmp_path / "fct")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.write_fct_events(fct.repartition(4), path)
        files = [r[0] for r in spark.read.parquet(path).where("event_date = DATE'2025-01-01'")
                 .selectExpr("input_file_name()").distinct().collect()]
        assert len(files) > 1  # one day, several tasks
        sinks.write_fct_events(fct.where("event_id NOT IN ('e0', 'e1', 'e2', 'e3', 'e4')"), path)
        assert [str(r[0]) for r in spark.read.parquet(path).select("event_date").distinct().collect()] == ["2025-01-01"]
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)


def test_incremental_builds_publish_the_store_itself(spark, raw_events, tmp_path):
    import json
    import time

    from event_docs import doc
    landing, out = tmp_path / "landing", str(tmp_path / "wh")
    for spec in bronze.BRONZE_SPECS[1:]:
        (landing / spec.relpath).mkdir(parents=True)
        (landing / spec.relpath / "none.json").write_text("")
    (landing / "events").mkdir()

    def land(name, docs):
        (landing / "events" / name).write_text("".join(d + "\n" for d in docs))

    one, two = "evt_" + "1" * 32, "evt_" + "2" * 32
    land("a.json", [doc(event_id=one, user=None), doc(event_id=two, name=7), json.dumps({})])
    first = build.run_warehouse(spark, str(landing), out, incremental_events=True)
    assert first.published and set(first.tables["fct_events"]) == {"store", "version"}
    assert [r.is_stitched for r in build.published(spark, out)["fct_events"].collect()] == [False]
    time.sleep(0.1)
    land("b.json", [doc(event_id=two, name="identify", user="usr_" + "1" * 12, account="acct_" + "2" * 12)])
    second = build.run_warehouse(spark, str(landing), out, incremental_events=True)
    tables = build.published(spark, out)
    assert second.published and [(r.event_id, r.is_stitched) for r in tables["fct_events"].collect()] == [(one, True)]
    assert tables["stg_events"].count() == 2 and tables["dead_letter"].count() == 2  # the documents of the first run are not read again
    failing = [quality.Check("unique", "stg_events", "stg_events", ("event_name",))]
    time.sleep(0.1)
    land("c.json", [doc(event_id="evt_" + "3" * 32)])
    third = build.run_warehouse(spark, str(landing), out, incremental_events=True, checks=failing)
    assert not third.published and third.dq_failures == 1 and "fct_events" in third.skipped
    assert build.published(spark, out)["stg_events"].count() == 2
    assert build.run_warehouse(spark, str(landing), out, incremental_events=True).published
    assert build.published(spark, out)["stg_events"].count() == 3
    assert build.published(spark, out, version=1)["stg_events"].count() == 1


def test_equal_columns_are_matched_without_trying_all(spark):
    same = spark.range(50).selectExpr(*[f"id AS a{i}" for i in range(10)])
    assert quality.results_equivalent(same, same.selectExpr(*[f"a{9 - i} AS b{i}" for i in range(10)]))
    other = spark.range(50).selectExpr(*[f"id AS a{i}" for i in range(9)], "49 - id AS z")
    assert not quality.results_equivalent(same, other) and not quality.results_equivalent(other, same)
    assert quality.results_equivalent(other, other.select("z", *[f"a{i}" for i in range(9)]))
