"""Contract rules, quality checks, result equivalence, incremental runs."""


from event_docs import doc

from funnelforge.functions.contract import contract_report, validate
from funnelforge.operators import incremental, quality, staging

GOOD = "evt_" + "0" * 32


def _codes(raw_events, d):
    return validate(raw_events([d])).first().violations


def test_valid_document_has_no_violations(raw_events):
    assert _codes(raw_events, doc(event_id=GOOD)) == []


def test_rule_order_and_codes(raw_events):
    assert _codes(raw_events, doc(event_id=GOOD, name=123, drop=("event_ts",))) == \
        ["required:event_ts", "type:event_name", "enum:event_name"]
    assert _codes(raw_events, doc(event_id="evt_XYZ")) == ["pattern:event_id"]
    assert _codes(raw_events, doc(event_id=GOOD, device="tv")) == ["enum:device_type"]
    assert _codes(raw_events, doc(event_id=GOOD, device=None)) == []
    assert _codes(raw_events, doc(event_id=GOOD, debug=True)) == ["additional_properties"]
    assert _codes(raw_events, doc(event_id=GOOD, drop=("anonymous_id", "user_id"))) == \
        ["anyOf:anonymous_id|user_id"]
    # present-but-null identities satisfy the wire contract
    assert _codes(raw_events, doc(event_id=GOOD, anon=None, user=None)) == []
    assert _codes(raw_events, doc(event_id=GOOD, schema_version="2.0.0")) == ["pattern:schema_version"]


def test_not_json_and_non_object(raw_events):
    assert validate(raw_events(["{oops"])).first().failure_reason == "not_json"
    assert validate(raw_events(["[1,2]"])).first().failure_reason == "type"


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 3)], "k string, v int")
    assert {(r.value, r.n) for r in quality.unique_violations(df, "k").collect()} == {("a", 2)}
    assert {(r.column_name, r.null_rows) for r in quality.null_counts(df, ["k", "v"]).collect()} == \
        {("k", 1), ("v", 1)}
    assert [r.value for r in quality.accepted_values_violations(df, "k", ["a"]).collect()] == ["b"]
    assert quality.unique_combination_violations(df, ["k", "v"]).count() == 0


def test_result_equivalence(spark):
    truth = spark.createDataFrame([("x", 1.004), ("y", 2.0)], "c string, v double")
    sup = spark.createDataFrame([(1.0, 2.0, "y"), (9.0, 1.0, "x")], "extra double, value double, name string")
    assert quality.results_equivalent(truth, sup)
    wrong = spark.createDataFrame([(2.0, "y"), (1.1, "x")], "value double, name string")
    assert not quality.results_equivalent(truth, wrong)
    short = spark.createDataFrame([("y",)], "name string")
    assert not quality.results_equivalent(truth, short)


def test_incremental_ignores_rows_older_than_lookback(raw_events, spark, tmp_path):
    b1 = [doc(event_id="evt_" + "1" * 32, ts="2025-01-10T00:00:00Z", received="2025-01-10T00:00:00Z")]
    b2 = [doc(event_id="evt_" + "2" * 32, ts="2025-01-01T00:00:00Z", received="2025-01-05T00:00:00Z"),
          doc(event_id="evt_" + "3" * 32, ts="2025-01-08T00:00:00Z", received="2025-01-08T00:00:00Z"),
          doc(event_id="evt_" + "1" * 32, ts="2025-01-10T00:00:00Z", received="2025-01-10T01:00:00Z",
              device="ios_app")]
    t = incremental.EventTable(spark, str(tmp_path / "stg"))
    t.apply(raw_events(b1), "1")
    t.apply(raw_events(b2), "2")
    rows = {r.event_id: r for r in t.current().collect()}
    assert set(rows) == {"evt_" + "1" * 32, "evt_" + "3" * 32}
    # the re-delivered event is replaced by the latest batch's version
    assert rows["evt_" + "1" * 32].device_type == "ios_app"
    # the late row is kept aside with its reason; a repeated run changes nothing
    t.apply(raw_events(b2), "2")
    assert [(r.event_id, r.failure_reason) for r in t.quarantine().collect()] == [("evt_" + "2" * 32, "late_beyond_lookback")]
    assert {r.event_id for r in t.current().collect()} == set(rows)


def test_incremental_equals_full_refresh_for_disjoint_batches(raw_events, spark, tmp_path):
    docs = [doc(event_id="evt_" + f"{i:032x}", ts=f"2025-01-{i:02d}T00:00:00Z") for i in range(1, 21)]
    t = incremental.EventTable(spark, str(tmp_path / "stg"))
    t.apply(raw_events(docs[:10]), "1")
    t.apply(raw_events(docs[10:]), "2")
    full = staging.stg_events(raw_events(docs))
    assert t.current().exceptAll(full).isEmpty() and full.exceptAll(t.current()).isEmpty()


def test_incremental_moves_rows_between_days(raw_events, spark, tmp_path):
    one = "evt_" + "1" * 32
    t = incremental.EventTable(spark, str(tmp_path / "stg"))
    t.apply(raw_events([doc(event_id=one, received="2025-01-09T00:00:00Z"),
                        doc(event_id="evt_" + "2" * 32, received="2025-01-10T00:00:00Z")]), "1")
    t.apply(raw_events([doc(event_id=one, received="2025-01-11T00:00:00Z", device="ios_app")]), "2")
    got = {(r.event_id, str(r.received_ts), r.device_type) for r in t.current().collect()}
    assert got == {(one, "2025-01-11 00:00:00", "ios_app"), ("evt_" + "2" * 32, "2025-01-10 00:00:00", "desktop_web")}
    assert t.store.latest().partitions("stg_events") == ["received_day=2025-01-10", "received_day=2025-01-11"]


def test_contract_report_of_nothing(raw_events, spark):
    none = spark.createDataFrame([], "raw_json string")
    assert tuple(contract_report(validate(none)).first()) == (0, 0, None)


def test_repeated_keys_follow_the_first_value(raw_events):
    text = doc()[:-1] + ',"event_name":"no_such_event","extra":{"a":1},"extra":2}'
    assert [r.violations for r in validate(raw_events([text])).collect()] == [["additional_properties"]]
    assert validate(raw_events([doc()[:-1] + ',"device_type":"ios_app"}'])).first().violations == []


def test_dq_report_has_all_declared_checks(spark):
    from funnelforge.plans.warehouse import Warehouse
    from funnelforge.sources import testdata
    w = Warehouse(testdata.raw_tables(spark, "/root/testdata/sf0.001"), materialize=True)
    rep = quality.dq_report(w).collect()
    assert len(rep) == 21
    assert all(r.status == "pass" for r in rep), [r for r in rep if r.status != "pass"]
