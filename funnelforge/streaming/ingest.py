"""Streaming ingestion: consume -> validate against the contract -> two routes.

* ST-1  every micro-batch is validated with the compiled contract and written
        once, partitioned by route (valid / dead); micro-batches are as large as
        what has arrived unless a deployment sets a limit.
* ST-2  at-least-once + idempotent: a delivery is named by (query id, batch id) and
        counts once its commit file is there, written by one rename after the data.
        A replayed batch that has a commit is passed over, one without is written
        again in its own folder.  A query with a new checkpoint has an id of its own,
        so it overwrites nothing; commits also note what was read (file, or topic
        partition and offset), so what another query has delivered is left out.
* ST-3  ``availableNow``: drain what is there, then stop.
* ST-4  live dedup on event_id with a 3-day watermark
        (``dropDuplicatesWithinWatermark``); batch staging stays the truth.
* ST-5  lateness bound = the same 3 days as the batch high-water mark.  The
        state is kept in RocksDB, so it is not bounded by executor memory.
        ``route_stream`` accounts for every document: accepted, duplicate, late or
        undedupable, each with its reason.

The event time that moves the watermark is at most the load time, so a document dated
in the future doesn't make all others late.

What was routed feeds the models: ``streamed_events`` is unioned with the landed
documents, ``stream_dead_letters`` with the batch dead letter.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from funnelforge.functions.contract import validate
from funnelforge.functions.jsonx import json_text, with_doc
from funnelforge.functions.semantics import try_timestamp
from funnelforge.sources.bronze import load_time
from funnelforge.sources.snapshots import Files

WATERMARK_DELAY = "3 days"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S-5 (tests / landing folders): NDJSON files as a stream of raw documents."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).select(F.col("value").alias("raw_json"), F.col("_metadata.file_path").alias("source"),
                               F.lit(None).cast("bigint").alias("position"))


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str = "product-events",
                 max_offsets_per_trigger: int | None = None, starting_offsets: str = "earliest") -> DataFrame:
    """S-5: the event topic from the earliest offset (needs the Kafka connector).
    ``max_offsets_per_trigger`` is a deployment option; without it a trigger
    takes all that has arrived."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return topic_rows(r.load())


def topic_rows(records: DataFrame) -> DataFrame:
    """Documents of a topic's records, with where they were read."""
    return records.select(F.col("value").cast("string").alias("raw_json"),
                          F.concat_ws("-", "topic", F.col("partition").cast("string")).alias("source"),
                          F.col("offset").alias("position"))


#: What no query id names: batches routed by hand.
BY_HAND = "direct"
ROUTED_SCHEMA = "event_id string, raw_json string, failure_reason string, origin string, _loaded_at timestamp_ntz, route string"


def _commits(files: Files, out_path: str) -> dict[str, dict]:
    """The deliveries that count, by name."""
    return {n[:-5]: json.loads(files.read(f"{out_path}/_commits/{n}")) for n in files.names(f"{out_path}/_commits")
            if n.endswith(".json") and not n.startswith(".")}


def _not_delivered(batch: DataFrame, out_path: str, others: list[str]) -> DataFrame:
    """The rows that none of the deliveries ``others`` has read: files count as
    read whole, topic partitions up to an offset."""
    if not others or "source" not in batch.columns:
        return batch
    read = (batch.sparkSession.read.schema("source string, until bigint")
            .parquet(*[f"{out_path}/_positions/{n}" for n in others])
            .groupBy("source").agg(F.max("until").alias("until")).withColumn("read", F.lit(True)))
    joined = batch.join(read, "source", "left")
    return joined.where(F.col("read").isNull() | (F.col("position") > F.col("until"))).select(*batch.columns)


def route_batch(batch: DataFrame, batch_id: int, out_path: str, query: str = BY_HAND,
                reached: Callable[[str], None] = lambda step: None) -> None:
    """ST-1 / W-2 / W-3: validate one micro-batch and write it, by route.

    One write: the batch is validated once and lands in its own folder; the commit
    file, written last, makes it count.  ``reached`` is told each step.
    """
    out_path = out_path.rstrip("/")
    name, folder = f"{query}-{batch_id}", f"query={query}/batch_id={batch_id}"
    files = Files(batch.sparkSession, out_path)
    commits = _commits(files, out_path)
    if name in commits:
        return  # delivered before
    others = [n for n, c in commits.items() if c["query"] != query and c["positions"]]
    batch = _not_delivered(batch, out_path, others)
    placed = "source" in batch.columns
    if placed:
        (batch.groupBy("source").agg(F.max("position").alias("until"))
         .write.mode("overwrite").parquet(f"{out_path}/_positions/{name}"))
    checked = validate(batch.select("raw_json"))
    route = F.when(F.size("violations") == 0, "valid").otherwise("dead")
    (checked.select(F.get_json_object("raw_json", "$.event_id").alias("event_id"), "raw_json", "failure_reason",
                    F.lit("stream").alias("origin"), load_time().alias("_loaded_at"), route.alias("route"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("route")
     .parquet(f"{out_path}/{folder}"))
    reached("written")
    files.put_new(f"{out_path}/_commits/{name}.json", json.dumps(
        {"query": query, "batch": batch_id, "folder": folder, "positions": placed}))


def start_routing(stream: DataFrame, out_path: str, checkpoint: str,
                  available_now: bool = True, processing_time: str | None = None):
    """ST-1..ST-3: start the contract-routing stream; returns the StreamingQuery."""
    def route(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise ValueError("a micro-batch without a query id")
        route_batch(batch, batch_id, out_path, query)

    w = stream.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def routed(spark: SparkSession, out_path: str) -> DataFrame:
    """All documents of deliveries that count, with their route."""
    out_path = out_path.rstrip("/")
    files = Files(spark, out_path)
    folders = sorted(c["folder"] for c in _commits(files, out_path).values())
    paths = [f"{out_path}/{f}" for f in folders if any("=" in n for n in files.names(f"{out_path}/{f}"))]
    if not paths:
        return spark.createDataFrame([], ROUTED_SCHEMA)
    return spark.read.schema(ROUTED_SCHEMA).option("basePath", out_path).parquet(*paths).drop("query", "batch_id")


def streamed_events(spark: SparkSession, out_path: str) -> DataFrame:
    """Accepted documents of the stream, shaped like the landed ones."""
    return routed(spark, out_path).where("route = 'valid'").select("raw_json", "_loaded_at")


def stream_dead_letters(spark: SparkSession, out_path: str) -> DataFrame:
    """Refused documents of the stream: event_id, raw_json, failure_reason, origin, _loaded_at."""
    return (routed(spark, out_path).where("route = 'dead'")
            .select("event_id", "raw_json", "failure_reason", "origin", "_loaded_at"))


def _keyed(stream: DataFrame) -> DataFrame:
    d = with_doc(stream.select("raw_json"))
    doc, raw = F.col("_doc"), F.col("raw_json")
    ev = d.select(
        json_text(doc, "$.event_id", raw).alias("event_id"),
        try_timestamp(json_text(doc, "$.event_ts", raw)).alias("event_ts"),
        try_timestamp(json_text(doc, "$.received_ts", raw)).alias("received_ts"),
        "raw_json")
    seen = F.coalesce("received_ts", "event_ts").cast("timestamp")
    return ev.withColumn("_wm", F.when(seen.isNotNull(), F.least(seen, F.current_timestamp())))


def dedup_stream(stream: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """ST-4 / ST-5: unique event ids within a 3-day watermark on
    ``coalesce(received_ts, event_ts)``.  State is bounded by the watermark.
    Documents without id or time can't be kept apart: see ``undedupable``."""
    ev = _keyed(stream).filter(F.col("event_id").isNotNull() & F.col("_wm").isNotNull())
    return ev.withWatermark("_wm", delay).dropDuplicatesWithinWatermark(["event_id"])


def undedupable(stream: DataFrame) -> DataFrame:
    """The documents that ``dedup_stream`` passes over, with the reason."""
    reason = F.when(F.col("event_id").isNull(), "missing_event_id").when(F.col("_wm").isNull(), "missing_event_time")
    return (_keyed(stream).withColumn("failure_reason", reason).filter(F.col("failure_reason").isNotNull())
            .select("event_id", "raw_json", "failure_reason", F.lit("stream_dedup").alias("origin"),
                    load_time().alias("_loaded_at")))


def run_dedup(stream: DataFrame, out_path: str, checkpoint: str):
    """Write the deduplicated stream (append) with ``availableNow``; returns the query."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (dedup_stream(stream).select("event_id", "event_ts", "received_ts", "raw_json")
            .writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())


def run_undedupable(stream: DataFrame, out_path: str, checkpoint: str):
    """Write what ``run_dedup`` passes over; returns the query."""
    return (undedupable(stream).writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())


# ------------------------------------------------------- every document accounted for
#: Groups of event ids whose state is kept together.
GROUPS = 256
OUTCOME_SCHEMA = "event_id string, raw_json string, route string, failure_reason string"
_HOUR_MS = 3_600_000


class KeepFirst(StatefulProcessor):
    """Per group of event ids: which were accepted, each until the watermark has
    passed its time by the delay (in full hours); a timer forgets them.

    The state is asked a few times a group and batch, not per document: the ids are read
    once, those that are new are appended at once, and one timer is set, for the earliest."""

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.accepted = handle.getListState("accepted", "event_id string, until bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        seen = {event_id for event_id, _ in self.accepted.get()}
        new: list[tuple[str, int]] = []
        for r in rows:
            if r.failure_reason is not None:
                route, reason = "undedupable", r.failure_reason
            elif r.wm_ms <= watermark:
                route, reason = "late", "late_beyond_watermark"
            elif r.event_id in seen:
                route, reason = "duplicate", "event_id_seen"
            else:
                route, reason = "accepted", None
                seen.add(r.event_id)
                new.append((r.event_id, _full_hour(r.wm_ms + self.delay_ms)))
            yield Row(event_id=r.event_id, raw_json=r.raw_json, route=route, failure_reason=reason)
        if new:
            self.accepted.appendList(new)
            self.handle.registerTimer(min(until for _, until in new))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        known = [(event_id, until) for event_id, until in self.accepted.get()]
        left = [k for k in known if k[1] > now]
        if left:
            if len(left) < len(known):
                self.accepted.put(left)
            self.handle.registerTimer(min(until for _, until in left))
        elif known:
            self.accepted.clear()
        return iter(())

    def close(self) -> None:
        pass


def _full_hour(ms: int) -> int:
    return -(-ms // _HOUR_MS) * _HOUR_MS


def route_stream(stream: DataFrame, delay: str = WATERMARK_DELAY, groups: int = GROUPS) -> DataFrame:
    """ST-4 / ST-5 with every document accounted for (``OUTCOME_SCHEMA``): the first
    of an event id is accepted, further ones are duplicates, documents older than the
    watermark are late, those without id or time undedupable.

    The time itself isn't passed on to the state, only its milliseconds: Spark drops
    rows behind the watermark where it sees the watermark's own column."""
    delay_ms = int(stream.sparkSession.sql(f"SELECT unix_millis(TIMESTAMP'1970-01-01T00:00:00Z' + INTERVAL {delay})").first()[0])
    reason = F.when(F.col("event_id").isNull(), "missing_event_id").when(F.col("_wm").isNull(), "missing_event_time")
    rows = (_keyed(stream).withColumn("failure_reason", reason).withWatermark("_wm", delay)
            .select(F.pmod(F.xxhash64(F.coalesce("event_id", "raw_json")), F.lit(groups)).alias("group"), "event_id", "raw_json",
                    F.unix_millis("_wm").alias("wm_ms"), "failure_reason"))
    return rows.groupBy("group").transformWithState(KeepFirst(delay_ms), OUTCOME_SCHEMA, "Append", "EventTime")


def run_routes(stream: DataFrame, out_path: str, checkpoint: str):
    """Write ``route_stream`` by route with ``availableNow``; returns the query."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (route_stream(stream).writeStream.format("parquet").option("path", out_path).partitionBy("route")
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
