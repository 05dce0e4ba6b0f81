"""Snapshot commits, and the incremental tables that rest on them."""

import random

import pytest
from event_docs import doc
from pyspark.sql import functions as F

from funnelforge.operators import identity, incremental, marts, staging
from funnelforge.sources.snapshots import CommitConflict, SnapshotStore


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(incremental, "BUCKETS", 3)


def test_versions_conflicts_and_vacuum(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    assert store.latest().version == 0 and store.latest().read("t") is None
    rows = spark.range(9).selectExpr("id", "date_add(DATE'2025-01-01', cast(id % 3 AS int)) AS day")
    tx = store.begin()
    assert tx.write("t", rows, "day", metrics={"nulls": F.count_if(F.col("id").isNull())}) == {"rows": 9, "nulls": 0}
    assert store.latest().version == 0  # not visible yet
    first = tx.commit()
    one, other = store.begin(), store.begin()
    one.write("t", rows.where("id = 0"), "day")
    other.write("t", rows.where("id = 1"), "day")
    one.drop("t", ["day=2025-01-03"])
    second = one.commit()
    with pytest.raises(CommitConflict):
        other.commit()
    assert first.read("t").count() == 9 and second.read("t").count() == 4
    assert sorted(r.id for r in second.read("t", ["day=2025-01-01", "day=2025-02-01"]).collect()) == [0]
    assert store.at(1).read("t").count() == 9
    third = store.begin()
    third.write("t", rows.where("id > 6"), "day", whole=True)
    third.write("u", rows.select("id"))
    assert third.commit().read("t").count() == 2
    assert len(store.vacuum(keep=1)) >= 3  # also what the refused transaction wrote
    assert store.latest().read("t").count() == 2 and store.latest().read("u").count() == 9
    assert third.base.partitions("t") == ["day=2025-01-01", "day=2025-01-02"]


def events(rng, n, first_day, id_from):
    """Documents of a few devices and users over some days, with claims."""
    out = []
    for i in range(n):
        day = first_day + rng.randint(0, 4)
        name = rng.choice(["identify", "page_viewed", "doc_created", "page_viewed"])
        user = rng.choice([None, "usr_" + f"{rng.randint(0, 5):012x}"]) if name != "identify" else "usr_" + f"{rng.randint(0, 5):012x}"
        out.append(doc(event_id="evt_" + f"{id_from + i:032x}", name=name, ts=f"2025-01-{day:02d}T{rng.randint(0, 23):02d}:00:00Z",
                       received=f"2025-01-{day:02d}T23:{rng.randint(10, 59)}:00Z", anon=rng.choice([None, "anon_" + f"{rng.randint(0, 7):012x}"]) if user else "anon_" + f"{rng.randint(0, 7):012x}",
                       user=user, account=rng.choice([None, "acct_" + f"{rng.randint(0, 3):012x}"]), email=f"x{rng.randint(0, 9)}@a{rng.randint(0, 2)}.com" if name == "identify" else None))
    return out


def facts_of(stg):
    return marts.fct_events(stg, identity.anon_to_user(stg), identity.user_to_account(stg))


def test_incremental_facts_equal_a_rebuild(raw_events, spark, tmp_path):
    rng = random.Random(3)
    table = incremental.EventTable(spark, str(tmp_path / "events"), facts=True)
    sent = events(rng, 60, 1, 0)
    table.apply(raw_events(sent), "0")
    for k in range(1, 3):
        batch = events(rng, 12, 3 + 3 * k, 100 * k)
        # some ids again: other device, user or day
        batch += [d.replace('"evt_' + f"{100 * k:032x}", '"evt_' + f"{rng.randint(0, 59):032x}") for d in batch[:1]]
        table.apply(raw_events(batch), str(k))
        stg, fct = table.current(), table.fct_events()
        want = facts_of(stg)
        assert fct.exceptAll(want).isEmpty() and want.exceptAll(fct).isEmpty(), k
        for name, rebuilt in (("anon_to_user", identity.anon_to_user(stg)), ("user_to_account", identity.user_to_account(stg))):
            kept = table.identity(name)
            assert kept.exceptAll(rebuilt).isEmpty() and rebuilt.exceptAll(kept).isEmpty(), name


def test_a_claim_reads_only_the_days_of_its_device(raw_events, spark, tmp_path):
    days = [doc(event_id="evt_" + f"{d:032x}", ts=f"2025-01-{d:02d}T10:00:00Z", anon="anon_" + f"{d % 10:012x}", user=None) for d in range(1, 31)]
    table = incremental.EventTable(spark, str(tmp_path / "events"), facts=True)
    table.apply(raw_events(days), "1")
    before = table.store.latest()
    claim = doc(event_id="evt_" + "f" * 32, name="identify", ts="2025-02-01T00:00:00Z", anon="anon_" + f"{4:012x}", user="usr_" + "1" * 12)
    done = table.apply(raw_events([claim]), "2")
    assert done.fact_days == [f"received_day={d}" for d in ("2025-01-04", "2025-01-14", "2025-01-24", "2025-02-01")]
    after = table.store.latest()
    same = [p for p in before.partitions("fct_events") if before.tables["fct_events"][p] == after.tables["fct_events"][p]]
    assert len(same) == 27  # folders of other days are those of the version before
    assert done.rewritten_days == [] and before.tables["stg_events"].items() <= after.tables["stg_events"].items()
    assert {r.event_id for r in table.fct_events().where("is_stitched").collect()} == {"evt_" + f"{d:032x}" for d in (4, 14, 24)}
    # the stitching reads no file of another day
    files = " ".join(after.read("fct_events", done.fact_days).inputFiles())
    assert "2025-01-05" not in files and "2025-01-04" in files


def test_a_crash_leaves_the_last_version(raw_events, spark, tmp_path):
    rng = random.Random(5)
    first, second = events(rng, 20, 1, 0), events(rng, 20, 3, 15)
    table = incremental.EventTable(spark, str(tmp_path / "events"), facts=True)
    table.apply(raw_events(first), "1")
    stg, fct = sorted(table.current().collect(), key=str), sorted(table.fct_events().collect(), key=str)
    for step in ("new days written", "days rewritten", "before commit"):
        def crash(at, step=step):
            if at == step:
                raise KeyboardInterrupt(at)

        with pytest.raises(KeyboardInterrupt):
            table.apply(raw_events(second), "2", reached=crash)
        assert sorted(table.current().collect(), key=str) == stg and sorted(table.fct_events().collect(), key=str) == fct
    table.apply(raw_events(second), "2")
    whole = incremental.EventTable(spark, str(tmp_path / "whole"), facts=True)
    whole.apply(raw_events(first), "1")
    whole.apply(raw_events(second), "2")
    assert sorted(table.fct_events().collect(), key=str) == sorted(whole.fct_events().collect(), key=str)


def test_failed_check_publishes_nothing(raw_events, spark, tmp_path):
    table = incremental.EventTable(spark, str(tmp_path / "events"))
    table.apply(raw_events([doc()]), "1")
    with pytest.raises(incremental.CheckFailed):
        table.apply(raw_events([doc(event_id="evt_" + "b" * 32)]), "2",
                    check=lambda snapshot: ["too many"] if snapshot.read("stg_events").count() > 1 else [])
    assert table.current().count() == 1 and table.store.latest().version == 1


def test_empty_batch_and_rows_without_receive_time(raw_events, spark, tmp_path):
    table = incremental.EventTable(spark, str(tmp_path / "events"), facts=True)
    table.apply(raw_events([doc(received="", event_id="evt_" + "1" * 32), doc(event_id="evt_" + "2" * 32)]), "1")
    assert table.current().count() == 2 and table.fct_events().count() == 2
    table.apply(raw_events([]), "2")
    table.apply(raw_events([doc(received="", event_id="evt_" + "3" * 32)]), "3")
    assert table.current().count() == 2
    assert [r.failure_reason for r in table.quarantine().collect()] == ["missing_received_ts"]
    assert staging.stg_events(raw_events([])).count() == 0


@pytest.mark.parametrize("facts", [False, True])
def test_a_run_asks_the_table_for_few_columns_by_id(spark, tmp_path, raw_events, monkeypatch, facts):
    """The whole table is dealt by id to find replaced rows: just ids, days and claims."""
    table = incremental.EventTable(spark, str(tmp_path / "t"), facts)
    table.apply(raw_events(events(random.Random(1), 20, 1, 0)), "1")
    stage, staged = table._stage, {}

    def staging_noted(df, name):
        staged[name] = stage(df, name)
        return staged[name]

    monkeypatch.setattr(table, "_stage", staging_noted)
    table.apply(raw_events(events(random.Random(2), 20, 2, 10)), "2")
    rows = staged["replaced-events"]
    assert rows.count() > 0
    assert rows.columns == ["event_id", incremental.DAY, *(incremental.CLAIM_COLUMNS if facts else [])]
    if facts:
        assert rows.where("event_name IS NULL AND email IS NOT NULL OR event_name <> 'identify'").count() == 0
        assert sorted(table.fct_events().collect(), key=str) == sorted(facts_of(table.current()).collect(), key=str)
