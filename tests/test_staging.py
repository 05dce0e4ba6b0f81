"""Hand-written staging cases (dedup, lateness, quarantine reasons)."""

from event_docs import doc

from funnelforge.operators import staging

E1 = "evt_" + "1" * 32
E2 = "evt_" + "2" * 32


def test_exact_duplicate_gives_one_row(raw_events):
    d = doc(event_id=E1)
    out = staging.stg_events(raw_events([d, d])).collect()
    assert len(out) == 1


def test_duplicate_received_later_keeps_earlier(raw_events):
    a = doc(event_id=E1, received="2025-01-01T10:00:00Z")
    b = doc(event_id=E1, received="2025-01-01T12:00:00Z")
    out = staging.stg_events(raw_events([b, a])).collect()
    assert len(out) == 1 and out[0].arrival_delay_hours == 0


def test_late_event_delay_48_hours(raw_events):
    d = doc(event_id=E1, ts="2025-01-01T10:00:00Z", received="2025-01-03T10:00:00Z")
    assert staging.stg_events(raw_events([d])).first().arrival_delay_hours == 48


def test_hour_boundary_counts_one(raw_events):
    d = doc(event_id=E1, ts="2025-01-01T00:59:00Z", received="2025-01-01T01:01:00Z")
    assert staging.stg_events(raw_events([d])).first().arrival_delay_hours == 1


def _reasons(raw_events, docs, strict=False):
    return {r.event_id: r.failure_reason
            for r in staging.dead_letter(raw_events(docs), strict=strict).collect()}


def test_dead_letter_reasons(raw_events):
    docs = [
        doc(event_id="evt_m1", name=123, drop=("event_ts",)),
        doc(event_id="evt_m2", name=123),
        doc(event_id="evt_m3", name=None),
        doc(event_id="evt_m4", anon=None, user=None),
        doc(event_id="evt_ok"),
    ]
    r = _reasons(raw_events, docs)
    assert r == {"evt_m1": "missing_or_invalid_event_ts", "evt_m2": "event_name_not_string",
                 "evt_m3": "event_name_not_string", "evt_m4": "no_identity"}


def test_absent_name_lands_nowhere_unless_strict(raw_events):
    d = doc(event_id="evt_abs", drop=("event_name",))
    assert staging.stg_events(raw_events([d])).count() == 0
    assert _reasons(raw_events, [d]) == {}
    assert _reasons(raw_events, [d], strict=True) == {"evt_abs": "missing_event_name"}


def test_unparseable_timestamp_is_quarantined(raw_events):
    for ts in ["not-a-time", "2025", "12:30"]:
        assert _reasons(raw_events, [doc(event_id="evt_t", ts=ts)]) == {"evt_t": "missing_or_invalid_event_ts"}


def test_duplicate_json_keys_fall_back_to_first_value(raw_events):
    raw = ('{"event_id":"evt_dk","event_name":"page_viewed","event_name":"identify",'
           '"event_ts":"2025-01-01T00:00:00Z","anonymous_id":"anon_000000000001"}')
    out = staging.parse_events(raw_events([raw])).first()
    assert out.event_id == "evt_dk" and out.event_name_json_type == "string"


def test_stg_columns(raw_events):
    df = staging.stg_events(raw_events([doc(event_id=E2)]))
    assert df.columns == staging.STG_EVENT_COLUMNS
    assert dict(df.dtypes)["arrival_delay_hours"] == "bigint"
    assert dict(df.dtypes)["event_ts"] == "timestamp_ntz"
