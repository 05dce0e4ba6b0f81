"""Sinks: full-refresh loads, appends, views, mart tables, keyed publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from funnelforge.functions.jsonx import json_text, with_doc
from funnelforge.functions.semantics import try_timestamp


def full_refresh(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 metrics: dict[str, Column] | None = None) -> dict[str, object]:
    """W-1 / W-5: idempotent replace of a whole Parquet table, also when it is
    partitioned and the session overwrites partitions dynamically.

    Returns ``rows`` and the further ``metrics`` (aggregates), observed while the rows
    are written, so nothing is scanned again for them."""
    seen = Observation()
    w = (df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()])
         .write.mode("overwrite").option("partitionOverwriteMode", "static"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return dict(seen.get)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """W-4: publish a model as a (lazy) temporary view."""
    df.createOrReplaceTempView(name)
    return df


def write_fct_events(fct: DataFrame, path: str, metrics: dict[str, Column] | None = None) -> dict[str, object]:
    """W-5 for the event fact: partitioned by event date, so date filters prune
    whole directories.  Rows are rebalanced by date: small days share a task and
    a large day is split over several (at the advisory partition size)."""
    return full_refresh(fct.withColumn("event_date", F.to_date("event_ts")).hint("rebalance", "event_date"),
                        path, ["event_date"], metrics)


def keyed_records(events_raw: DataFrame) -> DataFrame:
    """W-7 / ST-6: (key, value) records for the event topic.

    key = user_id, else anonymous_id, else '' (empty strings fall through like
    missing ones), so one identity's events share a partition and stay ordered;
    value = the original document bytes.
    """
    d = with_doc(events_raw.select("raw_json"))
    uid = json_text(F.col("_doc"), "$.user_id", F.col("raw_json"))
    aid = json_text(F.col("_doc"), "$.anonymous_id", F.col("raw_json"))
    key = F.coalesce(F.nullif(uid, F.lit("")), F.nullif(aid, F.lit("")), F.lit(""))
    return d.select(key.alias("key"), F.col("raw_json").alias("value"))


def ordered_records(events_raw: DataFrame, partitions: int | None = None) -> DataFrame:
    """W-7 / ST-6: keyed records in the order in which each key's events happened.

    ``sequence`` numbers a key's records from 1 by event time, event id and the
    document's digest; records without a key have no order to keep and sequence 0, and
    are spread over all tasks.  Rows come out dealt by key and sorted, so writing them
    as they are keeps every key's order."""
    d = with_doc(events_raw.select("raw_json"))
    doc, raw = F.col("_doc"), F.col("raw_json")
    uid, aid, eid, ts = (json_text(doc, f"$.{k}", raw) for k in ("user_id", "anonymous_id", "event_id", "event_ts"))
    key = F.coalesce(F.nullif(uid, F.lit("")), F.nullif(aid, F.lit("")), F.lit(""))
    rows = d.select(key.alias("key"), raw.alias("value"), eid.alias("_id"), try_timestamp(ts).alias("_ts"), F.md5(raw).alias("_digest"))
    rows = rows.withColumn("_to", F.when(F.col("key") == "", F.col("_digest")).otherwise(F.col("key")))
    dealt = rows.repartition(partitions, "_to") if partitions else rows.repartition("_to")
    order = ["_ts", "_id", "_digest"]
    place = F.row_number().over(Window.partitionBy("_to").orderBy(*[F.col(c).asc_nulls_last() for c in order]))
    return (dealt.withColumn("sequence", F.when(F.col("key") == "", 0).otherwise(place).cast("long"))
            .select("key", "value", "sequence").sortWithinPartitions("key", "sequence"))


def order_report(records: DataFrame) -> DataFrame:
    """ST-6: per key what a consumer has read in order of ``position``: records, and
    how often the next one was not the next of its key (a gap, a repeat or a swap).

    Each key's records are compared with their neighbours by position; records without
    a key are only counted, in parts."""
    keyed = records.where("key <> ''")
    before = F.lag("sequence", 1, 0).over(Window.partitionBy("key").orderBy("position"))
    report = (keyed.withColumn("step", F.col("sequence") - before).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("step") != 1).alias("violations")))
    rest = records.where("key = ''").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("violations"))
    return report.unionByName(rest)


def publish_kafka(records: DataFrame, bootstrap_servers: str, topic: str = "product-events") -> None:
    """W-7: write (key, value) records to a Kafka topic (needs the Kafka connector);
    a ``sequence`` goes along as a header."""
    columns = ["CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value"]
    if "sequence" in records.columns:
        columns.append("array(named_struct('key', 'sequence', 'value', CAST(CAST(sequence AS STRING) AS BINARY))) AS headers")
    (records.selectExpr(*columns)
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
     .option("topic", topic).save())
