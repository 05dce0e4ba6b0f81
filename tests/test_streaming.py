"""Deliveries that count once, and a route for every streamed document."""

import pytest
from event_docs import doc

from funnelforge.streaming import ingest


def land(path, name, docs):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(d + "\n" for d in docs))


def event(k, **fields):
    return doc(event_id="evt_" + f"{k:032x}", **fields)


def ids(spark, out):
    return sorted(int(r.event_id[-4:], 16) for r in ingest.routed(spark, out).collect())


def test_a_new_checkpoint_neither_overwrites_nor_doubles(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")

    def drain(checkpoint):
        ingest.start_routing(ingest.file_source(spark, str(src)), out, str(tmp_path / checkpoint)).awaitTermination()

    assert ids(spark, out) == []
    land(src, "a.json", [event(1), event(2), event(2)])
    drain("c1")
    land(src, "b.json", [event(3)])
    drain("c2")  # reads both files, a.json was delivered
    assert ids(spark, out) == [1, 2, 2, 3]
    land(src, "c.json", [event(4, name="no_such_event")])
    drain("c1")
    drain("c2")
    assert ids(spark, out) == [1, 2, 2, 3, 4]
    assert [r.event_id[-1] for r in ingest.stream_dead_letters(spark, out).collect()] == ["4"]


def test_topic_offsets_count_per_partition(spark, tmp_path):
    out = str(tmp_path / "out")

    def records(rows):
        return ingest.topic_rows(spark.createDataFrame([(bytes(event(k), "utf8"), "events", p, o) for k, p, o in rows],
                                                       "value binary, topic string, partition int, offset long"))

    ingest.route_batch(records([(1, 0, 10), (2, 0, 11), (3, 1, 5)]), 0, out, "first")
    ingest.route_batch(records([(2, 0, 11), (4, 0, 12), (3, 1, 5), (5, 2, 0)]), 0, out, "second")
    ingest.route_batch(records([(6, 0, 13)]), 1, out, "second")
    assert ids(spark, out) == [1, 2, 3, 4, 5, 6]


def test_only_committed_deliveries_are_read(spark, raw_events, tmp_path):
    out = str(tmp_path / "out")

    def die(step):
        raise KeyboardInterrupt(step)

    with pytest.raises(KeyboardInterrupt):
        ingest.route_batch(raw_events([event(1)]), 0, out, reached=die)
    assert ids(spark, out) == []
    ingest.route_batch(raw_events([event(1)]), 0, out)
    ingest.route_batch(raw_events([event(9)]), 0, out)  # this batch was delivered
    ingest.route_batch(raw_events([]), 1, out)
    assert ids(spark, out) == [1]


def test_every_document_leaves_by_one_route(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")

    def drain(name, docs):
        land(src, name, docs)
        ingest.run_routes(ingest.file_source(spark, str(src)), out, str(tmp_path / "ckpt")).awaitTermination()

    def found():
        rows = spark.read.parquet(out).collect()
        return sorted((r.route, int(r.event_id[-4:], 16) if r.event_id else 0) for r in rows)

    drain("a.json", [event(1, received="2025-01-10T00:00:00Z"), event(1, received="2025-01-10T05:00:00Z"), event(2, ts="2099-01-01T00:00:00Z", received=""),
                     doc(drop=("event_id",)), event(3, ts="never", received="")])
    assert found() == [("accepted", 1), ("accepted", 2), ("duplicate", 1), ("undedupable", 0), ("undedupable", 3)]
    # a document of the future moves the time to now at most
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    drain("b.json", [event(1, received="2025-01-10T06:00:00Z"), event(4, received="2025-01-20T00:00:00Z"), "{"])
    routes = found()
    assert len(routes) == 8 and ("late", 1) in routes and ("late", 4) in routes and ("undedupable", 0) in routes


def test_state_is_asked_per_group_not_per_document():
    from pyspark.sql import Row

    class State:
        def __init__(self):
            self.rows, self.timers, self.calls = [], [], 0

        def getListState(self, name, schema):
            return self

        def get(self):
            self.calls += 1
            return iter(self.rows)

        def appendList(self, rows):
            self.calls += 1
            self.rows = self.rows + rows

        def put(self, rows):
            self.calls += 1
            self.rows = list(rows)

        def clear(self):
            self.calls += 1
            self.rows = []

        def registerTimer(self, at):
            self.calls += 1
            self.timers.append(at)

    class At:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

        getExpiryTimeInMs = getCurrentWatermarkInMs

    hour, state = 3_600_000, State()
    first = ingest.KeepFirst(hour)
    first.init(state)

    def routes(watermark, rows):
        return [r.route for r in first.handleInputRows((0,), (Row(event_id=i, raw_json="x", wm_ms=t, failure_reason=None) for i, t in rows), At(watermark))]

    got = routes(0, [(f"e{k % 500}", 1 + k * hour) for k in range(1000)])
    assert got == ["accepted"] * 500 + ["duplicate"] * 500 and state.calls == 3
    assert state.timers == [2 * hour]
    list(first.handleExpiredTimer((0,), At(100 * hour), At(2 * hour)))  # ids of the first 99 hours go
    assert len(state.rows) == 401 and state.timers[-1] == 101 * hour
    assert routes(100 * hour, [("e0", 101 * hour), ("e499", 101 * hour), ("e1", 100 * hour)]) == ["accepted", "duplicate", "late"]
    list(first.handleExpiredTimer((0,), At(9999 * hour), At(101 * hour)))
    assert state.rows == []
