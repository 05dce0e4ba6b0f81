"""Adapters: TESTDATA tables -> the raw shapes the pipeline ingests.

The generated tables are TPC-H-like (``customer``, ``orders``) plus a generic
``events`` table.  These adapters turn them, deterministically, into

* ``events_raw``            one JSON document per event (+ duplicates,
                            late arrivals and contract violations),
* ``stripe_customers`` / ``stripe_subscriptions`` / ``stripe_invoices``,
* ``hubspot_companies`` / ``hubspot_contacts`` / ``hubspot_deals``,

with the nested struct / array shapes of the real exports.

Every column is written once as SQL text rendered for two dialects: Spark SQL
(used through ``selectExpr``) and DuckDB (used by the oracle queries).  Only
functions with identical definitions in both engines are used: ``md5`` of the
decimal text, ``substr``, ``||`` (NULL-propagating), ``%`` on non-negative
integers, CASE, interval arithmetic.  JSON is assembled by concatenation
because the engines' JSON writers disagree on NULL members.

No row is dropped: every source row yields at least one raw row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK = "spark"
DUCK = "duckdb"

# ---------------------------------------------------------------------------
# Vocabularies of the simulated product world.
# ---------------------------------------------------------------------------
# "google" and "producthunt" are named by golden questions; the rest is free.
UTM_SOURCES = ["google", "radio", "meetup", "producthunt", "poster", "podcast"]
PAGES = ["/start", "/plans", "/tour", "/guides", "/gallery"]
EVENT_NAME_BY_TYPE = {
    "view": "page_viewed",
    "signup": "identify",
    "click": "doc_edited",
    "purchase": "doc_created",
    "error": "search_performed",
}
SHARED_DEVICE = "anon_000000000000"
LOADED_AT = "2026-01-01 00:00:00"
INVOICE_EPOCH = 1735689600  # 2025-01-01T00:00:00Z
CUSTOMER_EPOCH = 1704067200  # 2024-01-01T00:00:00Z


def _case(expr: str, mapping: list[tuple[str, str]], default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {k} THEN {v}" for k, v in mapping)
    return f"CASE {expr} {whens} ELSE {default} END"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _q(x: str) -> str:
    """SQL text -> JSON string member value ("..." or null)."""
    return f"coalesce('\"' || ({x}) || '\"', 'null')"


def _iso(ts: str) -> str:
    """TIMESTAMP -> 'YYYY-MM-DDTHH:MM:SSZ' (seconds precision)."""
    return f"replace(substr(cast({ts} AS string), 1, 19), ' ', 'T') || 'Z'"


def _hex12(x: str) -> str:
    return f"substr(md5(cast({x} AS string)), 1, 12)"


def _struct(d: str, pairs: list[tuple[str, str]]) -> str:
    if d == SPARK:
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in pairs) + ")"
    return "struct_pack(" + ", ".join(f"{k} := {v}" for k, v in pairs) + ")"


def _array(d: str, items: list[str]) -> str:
    return ("array(" if d == SPARK else "[") + ", ".join(items) + (")" if d == SPARK else "]")


def _one_or_none(d: str, cond_empty: str, item: str) -> str:
    """A one-element array, or an empty array of the same type when cond_empty."""
    if d == SPARK:
        return f"filter(array({item}), x -> NOT ({cond_empty}))"
    return f"CASE WHEN {cond_empty} THEN [] ELSE [{item}] END"


def _ts_lit(d: str, s: str) -> str:
    return f"TIMESTAMP_NTZ '{s}'" if d == SPARK else f"TIMESTAMP '{s}'"


def _copies(d: str, cond_two: str) -> str:
    """Generator expression: 0, plus 1 when the row is emitted twice."""
    if d == SPARK:
        return f"explode(CASE WHEN {cond_two} THEN array(0, 1) ELSE array(0) END)"
    return f"unnest(CASE WHEN {cond_two} THEN [0, 1] ELSE [0] END)"


# ---------------------------------------------------------------------------
# events -> events_raw
# ---------------------------------------------------------------------------
# Chaos rules (by event_id), all rows kept:
#   % 25 = 3   emitted twice, byte-identical (exact duplicate)
#   % 100 = 41 emitted twice, the copy received 2 hours later (re-delivery)
#   % 67 = 0   received 1-3 days late
#   % 50 = 7   no event_ts and a numeric event_name   -> dead letter
#   % 50 = 9   both identities null                   -> dead letter
#   % 50 = 11  event_name null                        -> dead letter
#   % 50 = 13  event_name key absent                  -> neither table
#   % 50 = 17  unparseable event_ts                   -> dead letter
#   % 50 = 19  an extra top-level key                 -> contract only
#   % 50 = 21  upper-case event id                    -> contract only
#   % 50 = 23  received_ts null
#   % 97 = 0   device shared by several users (conflicting identity claims)
#   % 200 = 27 the event_id key twice (the first value counts)
#   % 200 = 29 broken JSON                        -> dead letter
#   % 200 = 33 a JSON array                       -> dead letter
#   % 200 = 35 both identity keys absent          -> dead letter
#   % 200 = 37 unknown device, % 200 = 39 unknown version -> contract only
#   % 200 = 43 event_ts with a bare hour (invalid), % 200 = 47 at 24:00 (next midnight)
EVENT_DUP_COND = "event_id % 25 = 3 OR event_id % 100 = 41"


def event_exprs(d: str) -> list[tuple[str, str]]:
    """(alias, expression) over (event_id, ts, user_id, event_type, copy_no)."""
    m50 = "event_id % 50"
    name = _case("event_type", [(_lit(k), _lit(v)) for k, v in EVENT_NAME_BY_TYPE.items()], "event_type")
    acct_key = "cast(floor(user_id / 2) AS bigint)"
    evt = (f"CASE WHEN {m50} = 21 THEN 'evt_' || upper(md5(cast(event_id AS string))) "
           f"ELSE 'evt_' || md5(cast(event_id AS string)) END")
    anon = (f"CASE WHEN {m50} = 9 THEN NULL WHEN event_id % 97 = 0 THEN {_lit(SHARED_DEVICE)} "
            f"ELSE 'anon_' || {_hex12('user_id * 3 + event_id % 3')} END")
    usr = (f"CASE WHEN {m50} = 9 THEN NULL WHEN event_type = 'signup' THEN 'usr_' || {_hex12('user_id')} "
           f"WHEN event_type = 'view' OR event_id % 4 = 0 THEN NULL ELSE 'usr_' || {_hex12('user_id')} END")
    acct = (f"CASE WHEN {m50} = 9 OR event_type = 'view' THEN NULL "
            f"WHEN event_type = 'signup' THEN 'acct_' || {_hex12(acct_key)} "
            f"WHEN event_id % 4 <> 0 AND event_id % 2 = 1 THEN 'acct_' || {_hex12(acct_key)} END")
    email = (f"CASE WHEN event_type = 'signup' THEN 'U' || cast(user_id AS string) || '@Acct' "
             f"|| cast({acct_key} AS string) || '.com' END")
    # every ninth account never shows a channel
    utm = (f"CASE WHEN event_type = 'view' AND {acct_key} % 9 <> 4 THEN "
           + _case("event_id % 7", [(str(i), _lit(s)) for i, s in enumerate(UTM_SOURCES)]) + " END")
    page = ("CASE WHEN event_type = 'view' THEN "
            + _case("event_id % 5", [(str(i), _lit(s)) for i, s in enumerate(PAGES)]) + " END")
    device = ("CASE WHEN event_id % 9 IN (0, 1, 2, 3) THEN 'desktop_web' "
              "WHEN event_id % 9 IN (4, 5) THEN 'mobile_web' WHEN event_id % 9 = 6 THEN 'ios_app' "
              "WHEN event_id % 9 = 7 THEN 'android_app' END")
    received = ("CASE WHEN event_id % 50 = 23 THEN NULL ELSE ts "
                "+ (CASE WHEN event_id % 67 = 0 THEN INTERVAL 1 DAY * (1 + event_id % 3) ELSE INTERVAL 0 DAY END) "
                "+ (CASE WHEN copy_no = 1 AND event_id % 100 = 41 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END) END")
    m200 = "event_id % 200"
    device = f"CASE WHEN {m200} = 37 THEN 'smart_fridge' ELSE {device} END"
    agent = f"CASE WHEN {m50} = 31 THEN NULL ELSE 'Mozilla/5.0' END"
    version = f"CASE WHEN {m200} = 39 THEN '2' WHEN event_id % 3 = 0 THEN '1.1.0' ELSE '1.0.0' END"
    day = "substr(cast(ts AS string), 1, 10)"
    raw = ("'{\"event_id\":' || " + _q(evt)
           + f" || CASE WHEN {m200} = 27 THEN ',\"event_id\":\"evt_again\"' ELSE '' END"
           + f" || CASE WHEN {m50} = 13 THEN '' WHEN {m50} = 7 THEN ',\"event_name\":123' "
             f"WHEN {m50} = 11 THEN ',\"event_name\":null' ELSE ',\"event_name\":' || {_q(name)} END"
           + f" || CASE WHEN {m50} = 7 THEN '' WHEN {m50} = 17 THEN ',\"event_ts\":\"not-a-timestamp\"' "
             f"WHEN {m200} = 43 THEN ',\"event_ts\":\"' || {day} || 'T10\"' "
             f"WHEN {m200} = 47 THEN ',\"event_ts\":\"' || {day} || 'T24:00:00Z\"' "
             f"ELSE ',\"event_ts\":' || {_q(_iso('ts'))} END"
           + " || ',\"received_ts\":' || " + _q(_iso(f"({received})"))
           + f" || CASE WHEN {m200} = 35 THEN '' ELSE ',\"anonymous_id\":' || {_q(anon)} || ',\"user_id\":' || {_q(usr)} END"
           + " || ',\"device_type\":' || " + _q(device)
           + " || ',\"user_agent\":' || " + _q(agent)
           + " || ',\"schema_version\":' || " + _q(version)
           + " || ',\"properties\":{\"account_id\":' || " + _q(acct)
           + " || ',\"page\":' || " + _q(page)
           + " || ',\"utm_source\":' || " + _q(utm)
           + " || ',\"email\":' || " + _q(email) + " || '}'"
           + f" || CASE WHEN {m50} = 19 THEN ',\"debug\":true' ELSE '' END"
           + " || '}'")
    raw = (f"CASE WHEN {m200} = 29 THEN '{{\"event_id\":\"evt_' || cast(event_id AS string) || '\",\"event_na' "
           f"WHEN {m200} = 33 THEN '[\"evt_' || cast(event_id AS string) || '\"]' ELSE {raw} END")
    return [("raw_json", raw), ("_loaded_at", _ts_lit(d, LOADED_AT))]


# ---------------------------------------------------------------------------
# customer -> billing customers / subscriptions, CRM companies / contacts / deals
# orders   -> billing invoices
# ---------------------------------------------------------------------------
def stripe_customer_exprs(d: str) -> list[tuple[str, str]]:
    k = "cast(c_custkey AS string)"
    return [
        ("id", f"'cus_' || {k}"),
        ("object", "'customer'"),
        ("email", f"'Billing@ACCT' || {k} || '.com'"),
        ("name", "c_name"),
        ("created", f"cast({CUSTOMER_EPOCH} + c_custkey * 3600 AS bigint)"),
        ("metadata", _struct(d, [("account_id",
                                  f"CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE 'acct_' || {_hex12('c_custkey')} END")])),
    ]


def stripe_subscription_exprs(d: str) -> list[tuple[str, str]]:
    k = "cast(c_custkey AS string)"
    item = _struct(d, [
        ("price", _struct(d, [
            ("id", "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'plan_large' ELSE 'plan_small' END"),
            ("unit_amount", "cast(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 2400 ELSE 1000 END AS bigint)"),
        ])),
        ("quantity", "cast(1 + c_custkey % 12 AS bigint)"),
    ])
    return [
        ("id", f"'sub_' || {k}"),
        ("object", "'subscription'"),
        ("customer", f"'cus_' || {k}"),
        ("status", "CASE WHEN c_custkey % 10 = 0 THEN 'canceled' WHEN c_custkey % 10 = 1 THEN 'past_due' ELSE 'active' END"),
        ("current_period_start", f"cast({INVOICE_EPOCH} + (c_custkey % 28) * 86400 AS bigint)"),
        ("canceled_at", f"CASE WHEN c_custkey % 10 = 0 THEN cast({INVOICE_EPOCH} + (c_custkey % 90) * 86400 AS bigint) END"),
        ("items", _struct(d, [("data", _one_or_none(d, "c_custkey % 53 = 0", item))])),
    ]


def stripe_invoice_exprs(d: str) -> list[tuple[str, str]]:
    line = _struct(d, [
        ("quantity", "cast(1 + o_orderkey % 9 AS bigint)"),
        ("price", _struct(d, [("id", "'plan_small'")])),
    ])
    return [
        ("id", "'in_' || cast(o_orderkey AS string)"),
        ("object", "'invoice'"),
        ("customer", "'cus_' || cast(o_custkey AS string)"),
        ("subscription", "'sub_' || cast(o_custkey AS string)"),
        ("amount_paid", "100000 * (1 + cast(floor(o_totalprice / 200000) AS bigint))"),
        ("currency", "'usd'"),
        ("status", "CASE WHEN o_orderstatus = 'F' THEN 'paid' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'uncollectible' END"),
        ("created", f"cast({INVOICE_EPOCH} + (o_orderkey % 180) * 86400 + (o_orderkey % 7) * 3600 AS bigint)"),
        ("lines", _struct(d, [("data", _one_or_none(d, "o_orderkey % 53 = 0", line))])),
    ]


COMPANY_DUP_COND = "c_custkey % 20 = 0"


def hubspot_company_exprs(d: str) -> list[tuple[str, str]]:
    """Over (customer.*, copy_no); a later-created duplicate for every 20th key."""
    k = "cast(c_custkey AS string)"
    created = ("CASE WHEN copy_no = 0 AND c_custkey % 41 = 0 THEN NULL ELSE "
               "cast(DATE '2022-01-01' + cast(c_custkey % 365 + copy_no * 400 AS int) AS string) || 'T08:00:00Z' END")
    return [
        ("id", f"'co_' || {k} || CASE WHEN copy_no = 1 THEN '_b' ELSE '' END"),
        ("properties", _struct(d, [
            ("name", "c_name"),
            ("domain", f"'ACCT' || {k} || CASE WHEN c_custkey % 33 = 0 THEN '.old' ELSE '.com' END"),
            ("industry", "c_mktsegment"),
            ("numberofemployees", "cast(c_nationkey * 10 + 1 AS bigint)"),
            ("lifecyclestage", "CASE c_custkey % 4 WHEN 0 THEN 'lead' WHEN 1 THEN 'opportunity' ELSE 'customer' END"),
            ("createdate", created),
        ])),
    ]


def hubspot_contact_exprs(d: str) -> list[tuple[str, str]]:
    k = "cast(c_custkey AS string)"
    return [
        ("id", f"'ct_' || {k}"),
        ("properties", _struct(d, [
            ("email", f"'Owner' || {k} || '@ACCT' || {k} || '.com'"),
            ("firstname", "split_part(c_name, '#', 1)"),
            ("lastname", "split_part(c_name, '#', 2)"),
            ("associatedcompanyid", f"'co_' || {k}"),
            ("createdate", "cast(DATE '2022-06-01' + cast(c_custkey % 365 AS int) AS string)"),
        ])),
    ]


def hubspot_deal_exprs(d: str) -> list[tuple[str, str]]:
    k = "cast(c_custkey AS string)"
    return [
        ("id", f"'deal_' || {k}"),
        ("properties", _struct(d, [
            ("dealname", "c_name || ' renewal'"),
            ("amount", "cast(floor(c_acctbal * 12) AS bigint)"),
            ("dealstage", "CASE c_custkey % 3 WHEN 0 THEN 'closedwon' WHEN 1 THEN 'closedlost' ELSE 'negotiation' END"),
            ("closedate", "CASE WHEN c_custkey % 37 = 0 THEN 'TBD' ELSE cast(DATE '2025-01-01' + cast(c_custkey % 200 AS int) AS string) END"),
            ("associatedcompanyid", f"'co_' || {k}"),
        ])),
    ]


# Which TESTDATA table feeds each raw table, and its expressions.
RAW_TABLES = {
    "events_raw": ("events", event_exprs, EVENT_DUP_COND,
                   ["event_id", "ts", "user_id", "event_type"]),
    "stripe_customers": ("customer", stripe_customer_exprs, None, None),
    "stripe_subscriptions": ("customer", stripe_subscription_exprs, None, None),
    "stripe_invoices": ("orders", stripe_invoice_exprs, None, None),
    "hubspot_companies": ("customer", hubspot_company_exprs, COMPANY_DUP_COND, None),
    "hubspot_contacts": ("customer", hubspot_contact_exprs, None, None),
    "hubspot_deals": ("customer", hubspot_deal_exprs, None, None),
}


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one raw table from TESTDATA as a lazy DataFrame."""
    src, exprs, dup_cond, cols = RAW_TABLES[name]
    df = read_table(spark, sf_dir, src)
    if cols:
        df = df.select(*cols)
    if dup_cond:
        # every row once, plus a second copy of the rows that are re-delivered;
        # a union (not a generator) keeps the generated code per stage small
        df = (df.withColumn("copy_no", F.lit(0))
              .unionByName(df.filter(F.expr(dup_cond)).withColumn("copy_no", F.lit(1))))
    out = [f"{e} AS {a}" for a, e in exprs(SPARK)]
    if name != "events_raw":
        out.append(f"{_ts_lit(SPARK, LOADED_AT)} AS _loaded_at")
    return df.selectExpr(*out)


_LANDED: dict[tuple, str] = {}


def landed_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter's event documents landed as NDJSON text, then read as bronze.

    This is the production shape (documents arrive as files), and it keeps the
    adapter's JSON assembly out of the generated code of the parsing stages.  An
    application lands an input once: again only if the table has changed since, or the
    landed files are gone.
    """
    from funnelforge.session import scratch_path
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/events.parquet")
    fs = source.getFileSystem(conf)
    files = sorted((f.getPath().toString(), f.getModificationTime(), f.getLen()) for f in fs.listStatus(source))
    key = (spark.sparkContext.applicationId, *files)
    path = _LANDED.get(key)
    done = path and jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done or not done.getFileSystem(conf).exists(done):
        path = _LANDED[key] = scratch_path(spark, "landed-events")
        raw_table(spark, sf_dir, "events_raw").select("raw_json").write.text(path)
    return spark.read.text(path).selectExpr("value AS raw_json", f"{_ts_lit(SPARK, LOADED_AT)} AS _loaded_at")


class RawTables(dict):
    """The raw tables by name; documents are landed when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__({n: raw_table(spark, sf_dir, n) for n in RAW_TABLES if n != "events_raw"})
        self._land = lambda: landed_events_raw(spark, sf_dir)

    def __missing__(self, name: str) -> DataFrame:
        if name != "events_raw":
            raise KeyError(name)
        self[name] = self._land()
        return self[name]


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return RawTables(spark, sf_dir)


# ---------------------------------------------------------------------------
# DuckDB side (oracle)
# ---------------------------------------------------------------------------
def duck_raw_cte(name: str) -> str:
    """SELECT text producing the raw table from the pre-registered TESTDATA views."""
    src, exprs, dup_cond, cols = RAW_TABLES[name]
    inner = f"SELECT {', '.join(cols) if cols else '*'} FROM {src}"
    if dup_cond:
        inner = f"SELECT *, {_copies(DUCK, dup_cond)} AS copy_no FROM ({inner}) _s"
    sel = ", ".join(f"{e} AS {a}" for a, e in exprs(DUCK))
    if name != "events_raw":
        sel += f", {_ts_lit(DUCK, LOADED_AT)} AS _loaded_at"
    return f"SELECT {sel} FROM ({inner}) _src"
