"""Golden business questions (G-1..G-15) over the five gold tables.

Each function takes the gold DataFrames it needs and returns a small result
DataFrame.  "Last month" means ``max(invoice_month)``; it is taken from the per-month
aggregate (one row per month), so the upstream plan runs once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelforge.functions.semantics import round_half_away
from funnelforge.operators.marts import MOBILE_DEVICES

def _latest_row(per_month: DataFrame, col: str = "invoice_month") -> DataFrame:
    """Rows of the latest month of a table that has one row per month.

    Picking the top row of the (small) per-month result avoids a scalar
    subquery that would recompute the whole upstream plan a second time.
    """
    return per_month.orderBy(F.col(col).desc_nulls_last()).limit(1)


def mrr_last_month(ledger: DataFrame) -> DataFrame:
    """Total MRR of the latest invoice month (one row, NULL on an empty ledger)."""
    per_month = ledger.groupBy("invoice_month").agg(F.sum("mrr").alias("m"))
    return per_month.agg(round_half_away(F.max_by("m", "invoice_month"), 2).alias("total_mrr"))


def ndr_latest(ndr: DataFrame) -> DataFrame:
    return _latest_row(ndr).select("ndr")


def top_channel(attribution: DataFrame, metric: str) -> DataFrame:
    """T-3: the channel ranked first by ``metric`` (ties: channel name)."""
    return (attribution.orderBy(F.col(metric).desc_nulls_last(), F.col("channel").asc_nulls_last())
            .limit(1).select("channel"))


def churned_last_month(ndr: DataFrame) -> DataFrame:
    return _latest_row(ndr).select("churned_accounts")


def paying_accounts(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count_distinct("account_id").alias("paying_accounts"))


def channel_value(attribution: DataFrame, channel: str, column: str) -> DataFrame:
    return attribution.filter(F.col("channel") == channel).select(column)


def movement_count(ledger: DataFrame, movement: str) -> DataFrame:
    return ledger.filter(F.col("movement") == movement).agg(F.count(F.lit(1)).alias("n"))


def crm_match_rate(dim: DataFrame) -> DataFrame:
    return dim.agg(round_half_away(
        F.avg(F.when(F.col("is_crm_matched"), 1).otherwise(0)), 3).alias("crm_match_rate"))


def events_stitched(fct: DataFrame) -> DataFrame:
    return fct.filter(F.col("is_stitched")).agg(F.count(F.lit(1)).alias("stitched"))


def event_count(fct: DataFrame, name: str, alias: str) -> DataFrame:
    return fct.filter(F.col("event_name") == name).agg(F.count(F.lit(1)).alias(alias))


def mrr_by_month(ledger: DataFrame) -> DataFrame:
    return (ledger.groupBy("invoice_month")
            .agg(round_half_away(F.sum("mrr"), 2).alias("total_mrr"))
            .orderBy("invoice_month"))


def mobile_events_share(fct: DataFrame) -> DataFrame:
    return fct.agg(round_half_away(
        F.avg(F.when(F.col("device_type").isin(MOBILE_DEVICES), 1).otherwise(0)), 3).alias("mobile_share"))


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """T-5: ``n`` rows of a model for a human to look at."""
    return df.limit(n)


GOLDEN = {
    "g1_mrr_last_month": lambda w: mrr_last_month(w.fct_mrr_monthly),
    "g2_ndr_latest": lambda w: ndr_latest(w.fct_ndr),
    "g3_top_channel_revenue": lambda w: top_channel(w.fct_revenue_attribution, "total_revenue_usd"),
    "g4_best_conversion_channel": lambda w: top_channel(w.fct_revenue_attribution, "signup_to_paid_rate"),
    "g5_churned_last_month": lambda w: churned_last_month(w.fct_ndr),
    "g6_paying_accounts": lambda w: paying_accounts(w.fct_mrr_monthly),
    "g7_google_signups": lambda w: channel_value(w.fct_revenue_attribution, "google", "accounts_signed_up"),
    "g8_expansion_accounts": lambda w: movement_count(w.fct_mrr_monthly, "expansion"),
    "g9_crm_match_rate": lambda w: crm_match_rate(w.dim_accounts),
    "g10_events_stitched": lambda w: events_stitched(w.fct_events),
    "g11_docs_created_total": lambda w: event_count(w.fct_events, "doc_created", "docs"),
    "g12_mrr_by_month": lambda w: mrr_by_month(w.fct_mrr_monthly),
    "g13_unattributed_accounts": lambda w: channel_value(w.fct_revenue_attribution, "(unattributed)",
                                                         "accounts_signed_up"),
    "g14_revenue_per_paying_producthunt": lambda w: channel_value(w.fct_revenue_attribution, "producthunt",
                                                                  "revenue_per_paying_account"),
    "g15_mobile_events_share": lambda w: mobile_events_share(w.fct_events),
}


def golden(w, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The golden questions against a Warehouse (or anything with the five gold
    attributes); only the requested ones are built."""
    return {n: GOLDEN[n](w) for n in (names or GOLDEN)}
