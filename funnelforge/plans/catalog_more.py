"""Catalogue part 2: sources, sinks, contract, quality, incremental, streaming,
and the stand-alone joins / aggregates / windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelforge.functions.contract import EVENT_NAMES, PRODUCT_EVENT_V1, contract_report, contract_samples, validate
from funnelforge.functions.jsonx import json_text, with_doc
from funnelforge.operators import identity, incremental, marts, quality, staging
from funnelforge.plans.catalog import _wh, register
from funnelforge.plans.oracle import _VALID, CTES, contract_violations_sql, stg_events_sql
from funnelforge.session import scratch_path
from funnelforge.sources import bronze, sinks, testdata
from funnelforge.streaming import ingest

# ------------------------------------------------------------------ sources (S)


@register("s1_events_raw_scan", "SELECT raw_json FROM events_raw")
def s1_events_raw_scan(spark, sf_dir):
    """S-1: land adapter documents as NDJSON, re-read them as raw strings."""
    path = scratch_path(spark, "landing-events")
    bronze.write_ndjson(testdata.raw_table(spark, sf_dir, "events_raw"), path, text_col="raw_json")
    return bronze.read_events_raw(spark, path).select("raw_json")


@register("s1_landed_events", "SELECT raw_json, 1 AS load_times FROM events_raw")
def s1_landed_events(spark, sf_dir):
    """S-1 / S-6: the bronze table of documents keeps the time they were landed:
    two deliveries, read twice, one load time for each document."""
    root = scratch_path(spark, "bronze-events")
    docs = testdata.raw_table(spark, sf_dir, "events_raw").select("raw_json")
    half = F.pmod(F.xxhash64("raw_json"), F.lit(2))
    for day in (0, 1):
        bronze.land_events(docs.where(half == day), root, f"2026-01-0{day + 1}")
    first, again = bronze.landed_events(spark, root), bronze.landed_events(spark, root)
    times = (first.unionByName(again).groupBy("raw_json").agg(F.count_distinct("_loaded_at").cast("int").alias("load_times")))
    return first.join(times, "raw_json").select("raw_json", "load_times")


@register("s2_crm_companies_scan", """
SELECT id, properties.name AS name, properties.domain AS domain, properties.industry AS industry,
       properties.numberofemployees AS numberofemployees, properties.lifecyclestage AS lifecyclestage,
       properties.createdate AS createdate
FROM hubspot_companies""")
def s2_crm_companies_scan(spark, sf_dir):
    """S-2: CRM export round trip through JSON lines with the explicit schema."""
    path = scratch_path(spark, "landing-companies")
    bronze.write_ndjson(testdata.raw_table(spark, sf_dir, "hubspot_companies").drop("_loaded_at"), path)
    df = bronze.read_export(spark, "hubspot_companies", path)
    return df.select("id", "properties.*")


@register("s3_billing_invoices_scan", """
SELECT id, customer, subscription, amount_paid, status, created, len(lines.data) AS n_lines,
       lines.data[1].quantity AS first_quantity
FROM stripe_invoices""")
def s3_billing_invoices_scan(spark, sf_dir):
    """S-3: billing export round trip (nested arrays) with the explicit schema."""
    path = scratch_path(spark, "landing-invoices")
    bronze.write_ndjson(testdata.raw_table(spark, sf_dir, "stripe_invoices").drop("_loaded_at"), path)
    df = bronze.read_export(spark, "stripe_invoices", path)
    return df.select("id", "customer", "subscription", "amount_paid", "status", "created",
                     F.size("lines.data").cast("bigint").alias("n_lines"),
                     F.get("lines.data", 0)["quantity"].alias("first_quantity"))


_S4_SQL = " UNION ALL ".join(
    f"SELECT '{s.table}' AS table_name, count(*) AS row_count FROM {s.table}" for s in bronze.BRONZE_SPECS)


@register("s4_bronze_row_counts", _S4_SQL)
def s4_bronze_row_counts(spark, sf_dir):
    """S-4 + A-11: land all seven raw tables by the bronze spec, read them back
    through their readers, count rows per table."""
    root = scratch_path(spark, "landing")
    raw = testdata.raw_tables(spark, sf_dir)
    for spec in bronze.BRONZE_SPECS:
        df = raw[spec.table]
        if spec.table == "events_raw":
            bronze.write_ndjson(df, f"{root}/{spec.relpath}", text_col="raw_json")
        else:
            bronze.write_ndjson(df.drop("_loaded_at"), f"{root}/{spec.relpath}")
    return quality.row_counts(bronze.read_bronze(spark, root))


# ------------------------------------------------------------- contract (K)
_VIOL = contract_violations_sql(PRODUCT_EVENT_V1)


@register("k1_contract_violations", f"""
SELECT event_id, v[1] AS failure_reason, len(v) AS n_violations
FROM (SELECT doc ->> '$.event_id' AS event_id, {_VIOL} AS v FROM event_docs) c
WHERE len(v) > 0""")
def k1_contract_violations(spark, sf_dir):
    """K-1..K-8: documents breaking the wire contract, first reason + count."""
    v = validate(testdata.landed_events_raw(spark, sf_dir))
    return v.filter(F.size("violations") > 0).select(
        F.get_json_object("raw_json", "$.event_id").alias("event_id"),
        "failure_reason", F.size("violations").cast("bigint").alias("n_violations"))


@register("k9_contract_report", f"""
SELECT count(*) FILTER (WHERE len(v) = 0) AS valid_count,
       count(*) FILTER (WHERE len(v) > 0) AS dead_letter_count,
       round(count(*) FILTER (WHERE len(v) > 0) * 100.0 / count(*), 3) AS dead_letter_pct
FROM (SELECT {_VIOL} AS v FROM event_docs) c""")
def k9_contract_report(spark, sf_dir):
    """K-9: valid / dead-letter counts and share of a document set."""
    return contract_report(validate(testdata.landed_events_raw(spark, sf_dir)))


# -------------------------------------------------------------- quality (A/Q)
@register("a10_dead_letter_summary", f"""
SELECT origin, failure_reason, count(*) AS n FROM (
  SELECT 'batch' AS origin, failure_reason FROM dead_letter
  UNION ALL
  SELECT 'stream' AS origin, v[1] AS failure_reason
  FROM (SELECT {_VIOL} AS v FROM event_docs) c WHERE len(v) > 0) u
GROUP BY 1, 2""")
def a10_dead_letter_summary(spark, sf_dir):
    """A-10: both quarantines (batch model, stream contract) counted by reason."""
    w = _wh(spark, sf_dir, materialize=False)
    stream_dead = validate(w.raw["events_raw"]).filter(F.size("violations") > 0)
    return quality.dead_letter_summary(("batch", w.dead_letter), ("stream", stream_dead))


@register("q1_unique_raw_event_ids", """
SELECT event_id AS value, count(*) AS n FROM parsed_events WHERE event_id IS NOT NULL
GROUP BY 1 HAVING count(*) > 1""")
def q1_unique_raw_event_ids(spark, sf_dir):
    """Q-1 on the landed documents: event ids delivered more than once."""
    return quality.unique_violations(_wh(spark, sf_dir, materialize=False).parsed_events, "event_id")


_Q2_COLS = ["event_id", "event_name", "event_ts", "received_ts", "anonymous_id", "user_id",
            "device_type", "account_id", "page", "utm_source", "email", "schema_version"]


@register("q2_null_counts_parsed_events", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM parsed_events"
    for c in _Q2_COLS))
def q2_null_counts_parsed_events(spark, sf_dir):
    """Q-2: NULL counts of all typed event fields in one pass."""
    return quality.null_counts(_wh(spark, sf_dir, materialize=False).parsed_events, _Q2_COLS)


_NAMES_SQL = ", ".join(f"'{n}'" for n in EVENT_NAMES)


@register("q3_accepted_event_names", f"""
SELECT event_name AS value, count(*) AS n FROM parsed_events
WHERE event_name IS NOT NULL AND event_name NOT IN ({_NAMES_SQL}) GROUP BY 1""")
def q3_accepted_event_names(spark, sf_dir):
    """Q-3 on the landed documents: event names outside the closed list."""
    return quality.accepted_values_violations(_wh(spark, sf_dir, materialize=False).parsed_events,
                                              "event_name", EVENT_NAMES)


@register("q4_invoice_customer_month_combos", """
SELECT stripe_customer_id, invoice_month, count(*) AS n FROM stg_invoices
GROUP BY 1, 2 HAVING count(*) > 1""")
def q4_invoice_customer_month_combos(spark, sf_dir):
    """Q-4: (customer, month) pairs with several invoices."""
    return quality.unique_combination_violations(_wh(spark, sf_dir, materialize=False).stg_invoices,
                                                 ["stripe_customer_id", "invoice_month"])


def _check_sql(c: quality.Check) -> str:
    t, cols = c.model, list(c.columns)
    if c.kind == "unique":
        body = (f"SELECT count(*) FROM (SELECT {cols[0]} FROM {t} WHERE {cols[0]} IS NOT NULL "
                f"GROUP BY 1 HAVING count(*) > 1) x")
    elif c.kind == "not_null":
        body = f"SELECT count(*) FROM {t} WHERE {cols[0]} IS NULL"
    elif c.kind == "accepted_values":
        body = (f"SELECT count(*) FROM (SELECT {cols[0]} FROM {t} WHERE {cols[0]} IS NOT NULL "
                f"AND {cols[0]} NOT IN ({_NAMES_SQL}) GROUP BY 1) x")
    else:
        body = (f"SELECT count(*) FROM (SELECT {', '.join(cols)} FROM {t} GROUP BY "
                f"{', '.join(cols)} HAVING count(*) > 1) x")
    return (f"SELECT '{quality.check_id(c)}' AS check_id, '{c.kind}' AS check_kind, '{c.table}' AS table_name, "
            f"'{','.join(cols)}' AS column_name, ({body}) AS failing_rows")


@register("q5_dq_report", "SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
          + " UNION ALL ".join(_check_sql(c) for c in quality.DECLARED_CHECKS) + ") r")
def q5_dq_report(spark, sf_dir):
    """Q-5: all 21 declared tests of the warehouse as one result table."""
    return quality.dq_report(_wh(spark, sf_dir, materialize="all"))


_SAME = "NOT EXISTS ((FROM truth EXCEPT ALL FROM {0}) UNION ALL (FROM {0} EXCEPT ALL FROM truth))"


@register("q6_result_equivalence", f"""
SELECT * FROM (
WITH months AS (FROM fct_mrr_monthly SELECT invoice_month AS m, sum(mrr) AS s, count(*) AS k GROUP BY ALL),
     truth AS (FROM months SELECT m, round(s, 2) AS s),
     renamed AS (FROM months SELECT m AS month, round(s, 2) AS revenue),
     shifted AS (FROM months SELECT m, round(s + 0.5, 2)),
     dropped AS (FROM truth WHERE m <> (SELECT min(m) FROM truth))
SELECT 'renamed_permuted_superset' AS comparison, {_SAME.format("renamed")} AS equivalent
UNION ALL SELECT 'shifted_values', {_SAME.format("shifted")}
UNION ALL SELECT 'dropped_month', {_SAME.format("dropped")}) q""")
def q6_result_equivalence(spark, sf_dir):
    """Q-6: result equivalence of golden query answers against reformulations."""
    from funnelforge.plans.metrics import mrr_by_month
    from funnelforge.plans.warehouse import materialized
    led = materialized(_wh(spark, sf_dir, materialize=False).fct_mrr_monthly, "ledger")
    per_month = led.groupBy("invoice_month").agg(F.sum("mrr").alias("s"), F.count(F.lit(1)).alias("k"))
    candidates = {
        "renamed_permuted_superset": per_month.select(F.col("k").alias("accounts"), F.col("s").alias("revenue"),
                                                      F.col("invoice_month").alias("month")),
        "shifted_values": per_month.select("invoice_month", (F.col("s") + F.lit(0.5)).alias("s")),
        "dropped_month": per_month.filter(F.col("invoice_month") != led.agg(F.min("invoice_month")).scalar())
        .select("invoice_month", "s"),
    }
    truth = mrr_by_month(led)
    rows = [(name, quality.results_equivalent(truth, df)) for name, df in candidates.items()]
    return spark.createDataFrame(rows, "comparison string, equivalent boolean")


_RAW_CHECKS = [quality.Check("unique", "parsed_events", "raw_documents", ("event_id",)),
               quality.Check("not_null", "parsed_events", "raw_documents", ("user_id",)),
               quality.Check("accepted_values", "parsed_events", "raw_documents", ("event_name",)),
               quality.Check("not_null", "parsed_events", "raw_documents", ("raw_json",))]


@register("q5_failures", "SELECT * FROM (" + " UNION ALL ".join(_check_sql(c) for c in _RAW_CHECKS)
          + ") r, (SELECT 'fail' AS status) s WHERE failing_rows > 0")
def q5_failures(spark, sf_dir):
    """Q-5 / triage: the failing checks among some declared on the raw documents."""
    w = _wh(spark, sf_dir, materialize=False)
    return quality.failures(quality.dq_report(w, _RAW_CHECKS))


# ------------------------------------------------------------------ sinks (W)
@register("w5_fct_events_table", "SELECT * FROM fct_events")
def w5_fct_events_table(spark, sf_dir):
    """W-5: the event fact written as a date-partitioned table and read back."""
    path = scratch_path(spark, "fct_events")
    sinks.write_fct_events(_wh(spark, sf_dir).fct_events, path)
    return spark.read.parquet(path).drop("event_date")


@register("w5_rebuild", "SELECT * FROM fct_events WHERE event_ts::DATE <> (SELECT min(event_ts)::DATE FROM fct_events)")
def w5_rebuild(spark, sf_dir):
    """W-5: a full refresh replaces the table: a day that is gone from the source
    is gone from the table, also in a session that overwrites dynamically."""
    path = scratch_path(spark, "fct_events_rebuilt")
    fct = _wh(spark, sf_dir).fct_events
    sinks.write_fct_events(fct, path)
    first = spark.read.parquet(path).agg(F.min("event_date")).first()[0]
    sinks.write_fct_events(fct.where(F.to_date("event_ts") != F.lit(first)), path)
    return spark.read.parquet(path).drop("event_date")


_W6_CUT = "(SELECT max(received_ts) - INTERVAL 7 DAY FROM parsed_events)"
_W6_HWM = "AND received_ts > (SELECT coalesce(max(received_ts), TIMESTAMP '1900-01-01') - INTERVAL 3 DAY FROM t1)"


_W6_BATCHES = f"""batch1 AS (SELECT * FROM parsed_events WHERE received_ts IS NULL OR received_ts < {_W6_CUT}),
     batch2 AS (SELECT * FROM parsed_events WHERE received_ts >= {_W6_CUT} - INTERVAL 4 DAY),
     t1 AS ({stg_events_sql('batch1')}),
     b2 AS ({stg_events_sql('batch2', _W6_HWM)})"""


def _deliveries(spark, sf_dir) -> tuple:
    """The documents as two deliveries; the second brings four days of the first again."""
    raw = testdata.landed_events_raw(spark, sf_dir)
    d = with_doc(raw)
    rts = staging.try_timestamp(json_text(F.col("_doc"), "$.received_ts", F.col("raw_json")))
    cut = d.agg((F.max(rts) - F.expr("INTERVAL 7 DAYS")).alias("c")).scalar()
    d = d.withColumn("_r", rts)
    b1 = d.filter(F.col("_r").isNull() | (F.col("_r") < cut)).select("raw_json", "_loaded_at")
    b2 = d.filter(F.col("_r") >= cut - F.expr("INTERVAL 4 DAYS")).select("raw_json", "_loaded_at")
    return b1, b2


def _two_batches(spark, sf_dir, facts: bool = False) -> incremental.EventTable:
    b1, b2 = _deliveries(spark, sf_dir)
    table = incremental.EventTable(spark, scratch_path(spark, "stg_events_table"), facts)
    table.apply(b1, "1")
    table.apply(b2, "2")
    return table


@register("w6_incremental_upsert", f"""
SELECT * FROM (
WITH {_W6_BATCHES}
SELECT * FROM t1 WHERE event_id NOT IN (SELECT event_id FROM b2)
UNION ALL SELECT * FROM b2) w6""")
def w6_incremental_upsert(spark, sf_dir):
    """W-6 + R-3: two incremental runs; the second re-delivers four days of the
    first and only rows above the high-water mark are merged."""
    return _two_batches(spark, sf_dir).current()


_W6_AFTER = "SELECT * FROM t1 WHERE event_id NOT IN (SELECT event_id FROM b2) UNION ALL SELECT * FROM b2"


@register("w6_crash_between_steps", f"""
SELECT * FROM (
WITH {_W6_BATCHES},
     steps AS (SELECT unnest(['staged', 'new days written', 'days rewritten', 'before commit']) AS died_after),
     after_ AS ({_W6_AFTER})
SELECT died_after, 1 AS version, t1.* FROM steps, t1
UNION ALL SELECT 'none', 2, * FROM after_) w""")
def w6_crash_between_steps(spark, sf_dir):
    """W-6 / W-1: the second run dies after each of its steps; what readers find is
    the first version whole.  In the end a run that is left alone gives the second."""
    class Died(RuntimeError):
        pass

    b1, b2 = _deliveries(spark, sf_dir)
    table = incremental.EventTable(spark, scratch_path(spark, "stg_events_crashes"))
    table.apply(b1, "1")
    found = []
    for step in ("staged", "new days written", "days rewritten", "before commit", "none"):
        def reached(at, step=step):
            if at == step:
                raise Died(at)

        try:
            table.apply(b2, "2", reached=reached)
        except Died:
            pass
        now = table.store.latest().version
        found.append(table.current().select(F.lit(step).alias("died_after"), F.lit(now).alias("version"), "*"))
    return reduce(DataFrame.unionByName, found)


_STITCHED = ["identify_claims", "anon_to_user", "user_to_account", "fct_events"]


@register("df_incremental", f"""
SELECT * FROM (
WITH {_W6_BATCHES}, stg_events AS ({_W6_AFTER}),
     {", ".join(f"{name} AS ({CTES[name]})" for name in _STITCHED)}
SELECT * FROM fct_events) f""")
def df_incremental(spark, sf_dir):
    """D-F under W-6: the fact follows two incremental runs; only events of the batch
    and of devices and users whose claims changed are stitched again."""
    return _two_batches(spark, sf_dir, facts=True).fct_events().select(*marts.FCT_EVENT_COLUMNS)


@register("w6_quarantine", f"""
SELECT * FROM (
WITH {_W6_BATCHES}
SELECT event_id, 'late_beyond_lookback' AS failure_reason, 'incremental' AS origin
FROM batch2 WHERE {_VALID} AND received_ts <= (SELECT max(received_ts) - INTERVAL 3 DAY FROM t1)) q""")
def w6_quarantine(spark, sf_dir):
    """R-3: valid rows that the high-water mark excludes, with the reason."""
    return _two_batches(spark, sf_dir).quarantine().select("event_id", "failure_reason", "origin")


@register("w7_keyed_records", """
SELECT coalesce(nullif(doc ->> '$.user_id', ''), nullif(doc ->> '$.anonymous_id', ''), '') AS key,
       raw_json AS value FROM event_docs""")
def w7_keyed_records(spark, sf_dir):
    """W-7 / ST-6: (key, value) records as published to the event topic."""
    return sinks.keyed_records(testdata.landed_events_raw(spark, sf_dir))


@register("st6_ordered_publish", """
SELECT coalesce(nullif(doc ->> '$.user_id', ''), nullif(doc ->> '$.anonymous_id', ''), '') AS key,
       count(*) AS n, 0 AS violations FROM event_docs GROUP BY ALL""")
def st6_ordered_publish(spark, sf_dir):
    """ST-6 / W-7: records written in each key's order and read back by position: no
    gap, repeat or swap in any key."""
    path = scratch_path(spark, "published-records")
    sinks.ordered_records(testdata.landed_events_raw(spark, sf_dir)).withColumn(
        "position", F.monotonically_increasing_id()).write.parquet(path)
    return sinks.order_report(spark.read.parquet(path))


# -------------------------------------------------------------- streaming (ST)
def _land_stream_input(spark, sf_dir) -> str:
    path = scratch_path(spark, "stream-in")
    testdata.raw_table(spark, sf_dir, "events_raw").select("raw_json").write.mode("overwrite").text(path)
    return path


def _routed(spark, sf_dir) -> str:
    src, out = _land_stream_input(spark, sf_dir), scratch_path(spark, "stream-out")
    ingest.start_routing(ingest.file_source(spark, src), f"{out}/events", f"{out}/_checkpoint").awaitTermination()
    return f"{out}/events"


@register("st1_stream_contract_routing", f"""
SELECT raw_json, CASE WHEN len(v) = 0 THEN 'valid' ELSE 'dead' END AS route, v[1] AS failure_reason
FROM (SELECT raw_json, {_VIOL} AS v FROM event_docs) c""")
def st1_stream_contract_routing(spark, sf_dir):
    """ST-1..ST-3 (+W-2/W-3): file-source stream, contract routing in
    foreachBatch, availableNow; both sinks read back."""
    return ingest.routed(spark, _routed(spark, sf_dir)).select("raw_json", "route", "failure_reason")


_BY_ROUTE = f"""
SELECT route, count(*) AS n, count(DISTINCT raw_json) AS n_documents
FROM (SELECT raw_json, CASE WHEN len(v) = 0 THEN 'valid' ELSE 'dead' END AS route
      FROM (SELECT raw_json, {_VIOL} AS v FROM event_docs) c) r GROUP BY ALL"""


def _by_route(spark, out):
    return ingest.routed(spark, out).groupBy("route").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.sha2("raw_json", 256)).alias("n_documents"))  # digests travel, not documents


@register("st2_replay", _BY_ROUTE)
def st2_replay(spark, sf_dir):
    """ST-2: two batches; the first dies between its data and its commit and is
    delivered again, then once more after it: every document is there as often as it
    was sent."""
    class Died(RuntimeError):
        pass

    def die(step):
        raise Died(step)

    out = scratch_path(spark, "stream-replay")
    docs = testdata.landed_events_raw(spark, sf_dir).select("raw_json")
    half = F.pmod(F.xxhash64("raw_json"), F.lit(2))
    try:
        ingest.route_batch(docs.where(half == 0), 0, out, reached=die)
    except Died:
        pass
    for batch_id in (0, 1, 0):
        ingest.route_batch(docs.where(half == batch_id), batch_id, out)
    return _by_route(spark, out)


@register("st2_new_checkpoint", _BY_ROUTE)
def st2_new_checkpoint(spark, sf_dir):
    """ST-2: half the documents are routed by one query, then all files, old and new,
    are read by a query with a new checkpoint on the same folder: nothing is
    overwritten, nothing is there twice."""
    docs = testdata.landed_events_raw(spark, sf_dir).select("raw_json")
    half = F.pmod(F.xxhash64("raw_json"), F.lit(2))
    src, out = scratch_path(spark, "checkpoints-in"), scratch_path(spark, "checkpoints-out")
    for k in (0, 1):
        docs.where(half == k).write.mode("append").text(src)
        ingest.start_routing(ingest.file_source(spark, src), f"{out}/events", f"{out}/_checkpoint{k}").awaitTermination()
    return _by_route(spark, f"{out}/events")


@register("da_from_stream", f"""
SELECT * FROM (WITH accepted AS (SELECT p.* FROM parsed_events p JOIN event_docs d ON p.raw_json = d.raw_json
                                 WHERE len({_VIOL.replace("(doc", "(d.doc").replace(" doc ", " d.doc ")}) = 0)
{stg_events_sql('accepted')}) s""")
def da_from_stream(spark, sf_dir):
    """ST-1 -> D-A: what the stream accepted, staged by the same model."""
    return staging.stg_events(ingest.streamed_events(spark, _routed(spark, sf_dir)))


@register("st1_dead_letters", f"""
SELECT doc ->> '$.event_id' AS event_id, raw_json, v[1] AS failure_reason, 'stream' AS origin
FROM (SELECT doc, raw_json, {_VIOL} AS v FROM event_docs) c WHERE len(v) > 0""")
def st1_dead_letters(spark, sf_dir):
    """ST-1 / W-3: refused documents in the shared dead-letter shape."""
    return ingest.stream_dead_letters(spark, _routed(spark, sf_dir)).drop("_loaded_at")


@register("st4_passed_over", """
SELECT event_id, raw_json, CASE WHEN event_id IS NULL THEN 'missing_event_id' ELSE 'missing_event_time' END AS failure_reason
FROM parsed_events WHERE event_id IS NULL OR coalesce(received_ts, event_ts) IS NULL""")
def st4_passed_over(spark, sf_dir):
    """ST-4: documents that the streaming dedup passes over, with the reason."""
    src, out = _land_stream_input(spark, sf_dir), scratch_path(spark, "stream-passed-over")
    ingest.run_undedupable(ingest.file_source(spark, src), f"{out}/data", f"{out}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data").select("event_id", "raw_json", "failure_reason")


@register("st4_stream_dedup", """
SELECT DISTINCT event_id FROM (
  SELECT doc ->> '$.event_id' AS event_id,
         coalesce(try_cast(doc ->> '$.received_ts' AS TIMESTAMP),
                  try_cast(doc ->> '$.event_ts' AS TIMESTAMP)) AS wm
  FROM event_docs) e
WHERE event_id IS NOT NULL AND wm IS NOT NULL""")
def st4_stream_dedup(spark, sf_dir):
    """ST-4 / ST-5: watermark-bounded streaming dedup on event_id (one drain)."""
    src = _land_stream_input(spark, sf_dir)
    out = scratch_path(spark, "stream-dedup")
    q = ingest.run_dedup(ingest.file_source(spark, src), f"{out}/data", f"{out}/_checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{out}/data").select("event_id")


def _three_deliveries(spark, sf_dir) -> list[DataFrame]:
    """Documents of the first three tenths of the time, of the last four and those
    without a time, then those in between."""
    docs = testdata.landed_events_raw(spark, sf_dir)
    timed = staging.parse_events(docs).select("raw_json", F.coalesce("received_ts", "event_ts").alias("wm"))
    lo, hi = timed.agg(F.min("wm"), F.max("wm")).first()
    early, recent, wm = F.lit(lo + (hi - lo) * 0.3), F.lit(lo + (hi - lo) * 0.6), F.col("wm")
    return [timed.where(d).select("raw_json") for d in (wm < early, wm.isNull() | (wm >= recent), (wm >= early) & (wm < recent))]


@register("st5_late_rows", """
SELECT DISTINCT event_id FROM (
  SELECT event_id, coalesce(received_ts, event_ts) AS wm, min(coalesce(received_ts, event_ts)) OVER () AS lo,
         max(coalesce(received_ts, event_ts)) OVER () AS hi FROM parsed_events) e
WHERE event_id IS NOT NULL AND (wm < lo + (hi - lo) * 0.3 OR wm >= lo + (hi - lo) * 0.6)""")
def st5_late_rows(spark, sf_dir):
    """ST-2 / ST-5: three deliveries, each drained by a restarted query; the last
    brings rows from before the watermark, which are dropped."""
    src, out = scratch_path(spark, "late-in"), scratch_path(spark, "late-out")
    for delivery in _three_deliveries(spark, sf_dir):
        delivery.write.mode("append").text(src)
        ingest.run_dedup(ingest.file_source(spark, src), f"{out}/data", f"{out}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data").select("event_id")


_ST5_TIMES = """
SELECT event_id, CASE WHEN event_id IS NULL THEN 'missing_event_id' WHEN coalesce(received_ts, event_ts) IS NULL THEN 'missing_event_time' END AS problem,
       coalesce(received_ts, event_ts) AS wm, min(coalesce(received_ts, event_ts)) OVER () AS lo,
       max(coalesce(received_ts, event_ts)) OVER () AS hi FROM parsed_events"""


@register("st5_routes", f"""
SELECT event_id, route, count(*) AS n FROM (
  SELECT event_id, CASE WHEN problem IS NOT NULL THEN 'undedupable'
       WHEN wm >= lo + (hi - lo) * 0.3 AND wm < lo + (hi - lo) * 0.6 THEN 'late'
       WHEN row_number() OVER (PARTITION BY event_id, problem, wm < lo + (hi - lo) * 0.3, wm >= lo + (hi - lo) * 0.6) = 1 THEN 'accepted'
       ELSE 'duplicate' END AS route
  FROM ({_ST5_TIMES}) t) r GROUP BY ALL""")
def st5_routes(spark, sf_dir):
    """ST-4 / ST-5: three deliveries, each drained by a restarted query, the last from
    before the watermark: every document leaves by one route, so accepted, duplicate,
    late and undedupable ones add up to what was sent."""
    src, out = scratch_path(spark, "routes-in"), scratch_path(spark, "routes-out")
    for delivery in _three_deliveries(spark, sf_dir):
        delivery.write.mode("append").text(src)
        ingest.run_routes(ingest.file_source(spark, src), f"{out}/data", f"{out}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data").groupBy("event_id", "route").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------- stand-alone joins / aggs / windows
_HOT_SQL = """
SELECT * FROM (
WITH raw_stg AS (SELECT * FROM stg_events),
     stg_events AS (SELECT * REPLACE (CASE WHEN event_name <> 'identify' AND substr(event_id, 5, 1) IN ('0', '1', '2', '3', '4', '5')
                                           THEN 'anon_000000000000' ELSE anonymous_id END AS anonymous_id) FROM raw_stg),
     fct_events AS ({})
SELECT * FROM fct_events) f"""


def _one_device(spark, sf_dir):
    """Staged events of which a device has more than a third, and the identity tables."""
    w = _wh(spark, sf_dir)
    third = (F.col("event_name") != "identify") & F.substring("event_id", 5, 1).isin(*"012345")
    stg = w.stg_events.withColumn("anonymous_id", F.when(third, testdata.SHARED_DEVICE).otherwise(F.col("anonymous_id")))
    return stg, w.anon_to_user, w.user_to_account


@register("j1_hot_device", _HOT_SQL.format(CTES["fct_events"]))
def j1_hot_device(spark, sf_dir):
    """J-1 / J-2: a device (and the user it leads to) holds over a third of all rows;
    hot keys are measured first and spread over several tasks."""
    return marts.fct_events(*_one_device(spark, sf_dir), measure_hot_keys=True)


@register("a1_account_domain_users", "SELECT account_id, dom AS email_domain, voters AS n_users FROM domain_votes")
def a1_account_domain_users(spark, sf_dir):
    """A-1: users per (account, email domain)."""
    from funnelforge.functions.semantics import email_domain
    m = _wh(spark, sf_dir, materialize=False).user_to_account
    return (m.select("account_id", email_domain("email").alias("email_domain"))
            .groupBy("account_id", "email_domain").agg(F.count(F.lit(1)).alias("n_users")))


@register("n5_primary_domains", "SELECT account_id, email_domain FROM account_spine GROUP BY ALL")
def n5_primary_domains(spark, sf_dir):
    """N-5: each account's dominant email domain."""
    return identity.primary_domains(_wh(spark, sf_dir, materialize=False).user_to_account)


@register("n6_crm_survivors", """
SELECT DISTINCT ON (domain) domain, crm_company_id, company_name, lifecycle_stage FROM stg_companies
ORDER BY domain, crm_created_at NULLS LAST, crm_company_id""")
def n6_crm_survivors(spark, sf_dir):
    """N-6: CRM survivorship (oldest record per domain)."""
    return identity.dedup_companies(_wh(spark, sf_dir, materialize=False).stg_companies)


@register("n8_first_touch", """
SELECT account_id, touch.via AS first_touch_channel, touch.at AS first_touch_at FROM first_touches""")
def n8_first_touch(spark, sf_dir):
    """N-8: first touch per account."""
    return marts.first_touch(_wh(spark, sf_dir).fct_events)


@register("a5_account_revenue", """
SELECT account_id, sum(mrr) AS total_revenue, count(DISTINCT invoice_month) AS months_paying
FROM fct_mrr_monthly GROUP BY account_id""")
def a5_account_revenue(spark, sf_dir):
    """A-5: lifetime revenue and distinct paying months per account."""
    return marts.account_revenue(_wh(spark, sf_dir, materialize=False).fct_mrr_monthly)


@register("j7_invoice_accounts", """
SELECT i.stripe_invoice_id, i.invoice_month, i.amount_usd, c.account_id
FROM stg_invoices i JOIN stg_customers c USING (stripe_customer_id) WHERE i.invoice_status = 'paid'""")
def j7_invoice_accounts(spark, sf_dir):
    """J-7 (+R-6): paid invoices joined to their billing customer's account."""
    w = _wh(spark, sf_dir, materialize=False)
    inv = w.stg_invoices.filter(F.col("invoice_status") == "paid")
    return inv.join(w.stg_customers.select("stripe_customer_id", "account_id"), "stripe_customer_id") \
        .select("stripe_invoice_id", "invoice_month", "amount_usd", "account_id")


# ------------------------------------------------- options and records as queries
@register("db_dead_letter_strict", f"""
SELECT event_id, raw_json, CASE WHEN event_ts IS NULL THEN 'missing_or_invalid_event_ts'
       WHEN event_name_json_type IS NULL THEN 'missing_event_name'
       WHEN event_name_json_type <> 'string' THEN 'event_name_not_string'
       WHEN anonymous_id IS NULL AND user_id IS NULL THEN 'no_identity'
       ELSE 'missing_event_id' END AS failure_reason
FROM parsed_events WHERE ({_VALID}) IS NOT TRUE""")
def db_dead_letter_strict(spark, sf_dir):
    """D-B strict: exactly the documents that staging refuses."""
    w = _wh(spark, sf_dir, materialize=False, strict_dead_letter=True)
    return w.dead_letter.select("event_id", "raw_json", "failure_reason")


@register("dc_anon_to_user_compat", "SELECT * REPLACE (FALSE AS had_conflicting_claims) FROM anon_to_user")
def dc_anon_to_user_compat(spark, sf_dir):
    """D-C with the published constant conflict flag."""
    return _wh(spark, sf_dir, compat_conflicts=True).anon_to_user


@register("k9_contract_samples", f"""
SELECT doc ->> '$.event_id' AS event_id, v[1] AS failure_reason
FROM (SELECT doc, raw_json, {_VIOL} AS v FROM event_docs) c WHERE len(v) > 0 ORDER BY raw_json LIMIT 3""")
def k9_contract_samples(spark, sf_dir):
    """K-9: three sample violations, the first by document text."""
    return contract_samples(validate(testdata.landed_events_raw(spark, sf_dir)), 3)


def _export_query(name: str, table: str, sql_columns: str, columns: list):
    @register(name, f"SELECT {sql_columns} FROM {table}")
    def scan(spark, sf_dir):
        path = scratch_path(spark, f"landing-{table}")
        bronze.write_ndjson(testdata.raw_table(spark, sf_dir, table).drop("_loaded_at"), path)
        out = bronze.read_export(spark, table, path).select(*columns)
        return out.withColumn("n_items", F.size("items.data").cast("bigint")).drop("items") if "items" in columns else out
    return scan


_export_query("s2_crm_contacts_scan", "hubspot_contacts",
              "id, properties.email AS email, properties.associatedcompanyid AS associatedcompanyid",
              ["id", "properties.email", "properties.associatedcompanyid"])
_export_query("s2_crm_deals_scan", "hubspot_deals",
              "id, properties.dealname AS dealname, properties.closedate AS closedate",
              ["id", "properties.dealname", "properties.closedate"])
_export_query("s3_billing_customers_scan", "stripe_customers",
              "id, email, created, metadata.account_id AS account_id",
              ["id", "email", "created", "metadata.account_id"])
_export_query("s3_billing_subscriptions_scan", "stripe_subscriptions",
              "id, customer, status, current_period_start, len(items.data) AS n_items",
              ["id", "customer", "status", "current_period_start", "items"])
