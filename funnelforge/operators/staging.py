"""Silver staging: typed, checked and deduplicated views over the bronze tables.

Event documents are parsed once to VARIANT; all fields are read from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelforge.functions.jsonx import json_kind, json_text, with_doc
from funnelforge.functions.semantics import (
    cents_to_usd, epoch_to_ts, first_element, hours_between, month_start,
    try_int_rounded, try_timestamp,
)

# P-1 field map: output column -> JSON path inside the event document.
EVENT_FIELDS = [
    ("event_id", "$.event_id"),
    ("event_name", "$.event_name"),
    ("event_ts", "$.event_ts"),
    ("received_ts", "$.received_ts"),
    ("anonymous_id", "$.anonymous_id"),
    ("user_id", "$.user_id"),
    ("device_type", "$.device_type"),
    ("account_id", "$.properties.account_id"),
    ("page", "$.properties.page"),
    ("utm_source", "$.properties.utm_source"),
    ("email", "$.properties.email"),
    ("schema_version", "$.schema_version"),
]
TIMESTAMP_FIELDS = {"event_ts", "received_ts"}

STG_EVENT_COLUMNS = [
    "event_id", "event_name", "event_ts", "received_ts", "anonymous_id", "user_id",
    "device_type", "account_id", "page", "utm_source", "email", "schema_version",
    "arrival_delay_hours",
]


def parse_events(events_raw: DataFrame, keep_raw: bool = True) -> DataFrame:
    """P-1: typed projection of every raw document (no filtering).

    Adds ``event_name_json_type``: the JSON type of ``event_name`` (string,
    number, null, ...; NULL when the key is absent).
    """
    raw = F.col("raw_json")
    doc = F.col("_doc")
    staged = with_doc(events_raw.select("raw_json", "_loaded_at"))
    cols: list[Column] = []
    for name, path in EVENT_FIELDS:
        text = json_text(doc, path, raw)
        cols.append((try_timestamp(text) if name in TIMESTAMP_FIELDS else text).alias(name))
        if name == "event_name":
            cols.append(json_kind(doc, "$.event_name", raw).alias("event_name_json_type"))
    out = staged.select(*cols, "raw_json", "_loaded_at")
    return out if keep_raw else out.drop("raw_json")


def is_valid_event() -> Column:
    """R-1: the batch validity predicate (id, string name, parseable ts, an identity)."""
    return (F.col("event_id").isNotNull() & F.col("event_name").isNotNull()
            & (F.col("event_name_json_type") == "string") & F.col("event_ts").isNotNull()
            & (F.col("anonymous_id").isNotNull() | F.col("user_id").isNotNull()))


def dedup_events(valid: DataFrame) -> DataFrame:
    """N-1: one row per event_id – the earliest received copy wins.

    Ties (byte-identical re-deliveries, or both received_ts NULL) are broken by
    the digest of the document, so the result is deterministic and the document
    itself is neither shuffled nor sorted.  Catalyst turns ``row_number() = 1``
    into a per-partition group limit before the shuffle.
    """
    w = Window.partitionBy("event_id").orderBy(F.col("received_ts").asc_nulls_last(), F.col("_digest").asc_nulls_last())
    return (valid.withColumn("_digest", F.md5("raw_json")).drop("raw_json")
            .withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn", "_digest"))


def finish_events(deduped: DataFrame) -> DataFrame:
    return deduped.select(
        *STG_EVENT_COLUMNS[:-1],
        hours_between("event_ts", "received_ts").alias("arrival_delay_hours"))


def stg_events(events_raw: DataFrame, high_water: Column | None = None) -> DataFrame:
    """D-A: typed, valid, deduplicated events.

    ``high_water`` (optional) is a scalar Column: only rows received after it
    are kept (the incremental run, see operators.incremental).
    """
    return stg_from_parsed(parse_events(events_raw), high_water)


def stg_from_parsed(parsed: DataFrame, high_water: Column | None = None) -> DataFrame:
    """D-A from documents that are parsed already (``parse_events``)."""
    valid = parsed.filter(is_valid_event())
    if high_water is not None:
        valid = valid.filter(F.col("received_ts") > high_water)
    return finish_events(dedup_events(valid))


#: Why a document is quarantined: by the staging model, plain and strict.
FAILURE_REASONS = ["missing_or_invalid_event_ts", "missing_event_name", "event_name_not_string", "no_identity",
                   "missing_event_id", "unknown_violation"]
DEAD_LETTER_COLUMNS = ["event_id", "raw_json", "failure_reason", "_loaded_at"]


def dead_letter(events_raw: DataFrame, strict: bool = False) -> DataFrame:
    """D-B: quarantined documents with the first failing reason.

    Default follows the published predicate: ts missing/unparseable, then
    name not a JSON string, then no identity.  A document whose ``event_name``
    key is absent satisfies neither that predicate nor R-1 and lands nowhere;
    ``strict=True`` quarantines exactly ``NOT R-1`` instead, adding the reasons
    ``missing_event_id`` and ``missing_event_name``.
    """
    return dead_letter_from_parsed(parse_events(events_raw), strict)


def dead_letter_from_parsed(p: DataFrame, strict: bool = False) -> DataFrame:
    """D-B from documents that are parsed already (``parse_events``)."""
    ts_bad = F.col("event_ts").isNull()
    kind = F.col("event_name_json_type")
    no_id = F.col("anonymous_id").isNull() & F.col("user_id").isNull()
    if strict:
        reason = (F.when(ts_bad, "missing_or_invalid_event_ts")
                  .when(kind.isNull(), "missing_event_name")
                  .when(kind != "string", "event_name_not_string")
                  .when(no_id, "no_identity")
                  .when(F.col("event_id").isNull(), "missing_event_id")
                  .otherwise("unknown_violation"))
        cond = ~F.coalesce(is_valid_event(), F.lit(False))
    else:
        reason = (F.when(ts_bad, "missing_or_invalid_event_ts")
                  .when(kind != "string", "event_name_not_string")
                  .when(no_id, "no_identity")
                  .otherwise("unknown_violation"))
        cond = ts_bad | (kind != "string") | no_id
    return p.filter(cond).select("event_id", "raw_json", reason.alias("failure_reason"), "_loaded_at")


def late_events(stg: DataFrame, hours: int = 24) -> DataFrame:
    """D-K: events that arrived more than ``hours`` after they happened."""
    return stg.filter(F.col("arrival_delay_hours") > hours)


# --------------------------------------------------------------------------- CRM
def stg_companies(raw: DataFrame) -> DataFrame:
    """P-2: CRM companies un-nested; domain lower-cased."""
    p = F.col("properties")
    return raw.select(
        F.col("id").alias("crm_company_id"),
        p["name"].alias("company_name"),
        F.lower(p["domain"]).alias("domain"),
        p["industry"].alias("industry"),
        try_int_rounded(p["numberofemployees"].cast("string")).alias("employee_count"),
        p["lifecyclestage"].alias("lifecycle_stage"),
        try_timestamp(p["createdate"]).alias("crm_created_at"))


def stg_contacts(raw: DataFrame) -> DataFrame:
    """P-3: CRM contacts; email lower-cased (join key to product users)."""
    p = F.col("properties")
    return raw.select(
        F.col("id").alias("crm_contact_id"),
        F.lower(p["email"]).alias("email"),
        p["firstname"].alias("first_name"),
        p["lastname"].alias("last_name"),
        p["associatedcompanyid"].alias("crm_company_id"))


def stg_deals(raw: DataFrame) -> DataFrame:
    """P-4: CRM deals; annual amount as DECIMAL(12,2), close date as DATE."""
    p = F.col("properties")
    close = p["closedate"]
    return raw.select(
        F.col("id").alias("crm_deal_id"),
        p["dealname"].alias("deal_name"),
        p["amount"].try_cast("decimal(12,2)").alias("deal_amount_annual"),
        p["dealstage"].alias("deal_stage"),
        F.when(close.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), close.try_cast("date")).alias("close_date"),
        p["associatedcompanyid"].alias("crm_company_id"))


# ------------------------------------------------------------------------ billing
def stg_customers(raw: DataFrame) -> DataFrame:
    """P-5: billing customers; ``metadata.account_id`` links billing to product."""
    return raw.select(
        F.col("id").alias("stripe_customer_id"),
        F.lower("email").alias("email"),
        F.col("name").alias("customer_name"),
        epoch_to_ts("created").alias("billing_created_at"),
        F.col("metadata")["account_id"].alias("account_id"))


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    """P-6: subscriptions with their first line item flattened."""
    item = first_element(F.col("items")["data"])
    return raw.select(
        F.col("id").alias("stripe_subscription_id"),
        F.col("customer").alias("stripe_customer_id"),
        "status",
        epoch_to_ts("current_period_start").alias("period_start_at"),
        epoch_to_ts(F.col("canceled_at").try_cast("bigint")).alias("canceled_at"),
        item["price"]["id"].alias("stripe_price_id"),
        cents_to_usd(item["price"]["unit_amount"]).alias("unit_price_usd"),
        item["quantity"].alias("seat_count"))


def stg_invoices(raw: DataFrame) -> DataFrame:
    """P-7: invoices; cents -> USD, month of issue, seats of the first line."""
    created = epoch_to_ts("created")
    return raw.select(
        F.col("id").alias("stripe_invoice_id"),
        F.col("customer").alias("stripe_customer_id"),
        F.col("subscription").alias("stripe_subscription_id"),
        cents_to_usd("amount_paid").alias("amount_usd"),
        F.col("status").alias("invoice_status"),
        created.alias("invoiced_at"),
        month_start(created).alias("invoice_month"),
        first_element(F.col("lines")["data"])["quantity"].alias("seat_count"))
