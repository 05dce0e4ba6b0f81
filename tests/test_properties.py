"""Property tests (hypothesis): dedup, partition of the input, conservation."""

from event_docs import doc
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from funnelforge.operators import staging

ids = st.integers(min_value=0, max_value=30)
kinds = st.sampled_from(["ok", "no_ts", "num_name", "null_name", "no_name", "no_ids"])
rows = st.lists(st.tuples(ids, kinds, st.integers(min_value=0, max_value=5)), min_size=1, max_size=25)


def _make(r):
    i, kind, late = r
    eid = "evt_" + f"{i:032x}"
    rec = f"2025-01-0{1 + late}T00:00:00Z"
    if kind == "no_ts":
        return doc(event_id=eid, received=rec, drop=("event_ts",))
    if kind == "num_name":
        return doc(event_id=eid, name=7, received=rec)
    if kind == "null_name":
        return doc(event_id=eid, name=None, received=rec)
    if kind == "no_name":
        return doc(event_id=eid, received=rec, drop=("event_name",))
    if kind == "no_ids":
        return doc(event_id=eid, anon=None, user=None, received=rec)
    return doc(event_id=eid, received=rec)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows)
def test_valid_dead_lost_partition_the_input(spark, raw_events, data):
    docs = [_make(r) for r in data]
    raw = raw_events(docs)
    parsed = staging.parse_events(raw)
    valid = parsed.filter(staging.is_valid_event()).count()
    dead = staging.dead_letter(raw).count()
    lost = sum(1 for _, k, _ in data if k == "no_name")
    assert valid + dead + lost == len(docs)
    # strict mode quarantines exactly what is not valid
    assert valid + staging.dead_letter(raw, strict=True).count() == len(docs)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows)
def test_dedup_unique_and_idempotent(spark, raw_events, data):
    docs = [_make(r) for r in data]
    stg = staging.stg_events(raw_events(docs))
    n = stg.count()
    assert n == stg.select("event_id").distinct().count()
    # feeding the documents twice changes nothing
    again = staging.stg_events(raw_events(docs + docs))
    assert again.exceptAll(stg).isEmpty() and stg.exceptAll(again).isEmpty()
    # the kept copy is the earliest received one
    first = {}
    for i, k, late in data:
        if k in ("ok",):
            first[i] = min(first.get(i, late), late)
    got = {int(r.event_id[4:], 16): r.received_ts.day - 1 for r in stg.collect()}
    assert got == first
