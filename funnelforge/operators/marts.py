"""Gold marts: stitched events, account dimension, MRR ledger, NDR, attribution.

Shuffle plan (what runs at scale):

* ``fct_events``   two equi-joins on identity keys.  Rows whose key is NULL can
                   never match; they are spread by event id instead of hashing
                   into a single reducer.  Hot non-NULL keys are measured by a
                   sketch and salted on both sides (written tables), else left
                   to AQE's skew-join split.
* ``dim_accounts`` first touch = ``min(struct(ts, channel, id))`` per account,
                   an aggregate that is combined map-side (one hot account
                   cannot overload a task).
* ``mrr_ledger``   invoices are pre-aggregated per (customer, month) before
                   the customer join, then per (month, account); the movement
                   window runs over (account, month) rows only.
* ``fct_ndr``      no self-join: the next month of the same account comes from
                   ``lead`` over the same window as the ledger's ``lag``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelforge.functions.semantics import round_half_away, safe_div
from funnelforge.operators.joins import hot_keys, left_join_spread_nulls

FCT_EVENT_COLUMNS = ["event_id", "event_name", "event_ts", "device_type", "page", "utm_source",
                     "user_id", "account_id", "is_stitched", "anonymous_id"]


def fct_events(stg_events: DataFrame, edges: DataFrame, memberships: DataFrame, measure_hot_keys: bool = False,
               keep: Sequence[str] = ()) -> DataFrame:
    """D-F: every non-identify event with identity resolved retroactively.

    A pre-signup anonymous event inherits the user its device was later
    identified as (``is_stitched``) and that user's account.

    ``measure_hot_keys`` first measures which devices and users hold many rows (two
    passes over their id columns) and spreads those over several tasks; it pays where
    ``stg_events`` is a written table.  ``keep`` names further columns to go along.
    """
    ev = stg_events.filter(F.col("event_name") != "identify").select(
        "event_id", "event_name", "event_ts", "device_type", "page", "utm_source",
        "user_id", "account_id", "anonymous_id", *keep)
    m = edges.select("anonymous_id", F.col("user_id").alias("m_user_id"))
    devices = hot_keys(ev, F.col("anonymous_id")) if measure_hot_keys else None
    j1 = left_join_spread_nulls(ev, F.col("anonymous_id"), F.col("event_id"), m, "anonymous_id", devices)
    ua = memberships.select("user_id", F.col("account_id").alias("ua_account_id"))
    users = None
    if measure_hot_keys:
        # users in the data, and those that the hot devices lead to
        users = hot_keys(ev, F.col("user_id"))
        led = {r.m_user_id: devices[r.anonymous_id] for r in m.where(F.col("anonymous_id").isin(list(devices))).collect()} if devices else {}
        users |= {u: max(n, users.get(u, 0)) for u, n in led.items()}  # a row per hot device
    j2 = left_join_spread_nulls(j1, F.coalesce("user_id", "m_user_id"), F.col("event_id"), ua, "user_id", users)
    return j2.select(
        "event_id", "event_name", "event_ts", "device_type", "page", "utm_source",
        F.coalesce("user_id", "m_user_id").alias("user_id"),
        F.coalesce("account_id", "ua_account_id").alias("account_id"),
        (F.col("user_id").isNull() & F.col("m_user_id").isNotNull()).alias("is_stitched"),
        "anonymous_id", *keep)


def first_touch(fct: DataFrame) -> DataFrame:
    """N-8: each account's earliest event carrying a channel (ties: channel, event id)."""
    g = (fct.filter(F.col("account_id").isNotNull() & F.col("utm_source").isNotNull())
         .groupBy("account_id")
         .agg(F.min(F.struct("event_ts", "utm_source", "event_id")).alias("_t")))
    return g.select("account_id", F.col("_t.utm_source").alias("first_touch_channel"),
                    F.col("_t.event_ts").alias("first_touch_at"))


DIM_ACCOUNT_COLUMNS = ["account_id", "company_name", "email_domain", "crm_company_id",
                       "stripe_customer_id", "is_crm_matched", "is_billing_matched",
                       "first_touch_channel", "first_touch_at"]


def dim_accounts(spine: DataFrame, fct: DataFrame) -> DataFrame:
    """D-G: the identity spine plus first-touch acquisition channel."""
    return spine.join(first_touch(fct), "account_id", "left").select(*DIM_ACCOUNT_COLUMNS)


MOVEMENTS = ["new", "expansion", "contraction", "retained"]


def monthly_mrr(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """A-2: paid revenue per (invoice_month, account_id)."""
    per_customer = (invoices.filter(F.col("invoice_status") == "paid")
                    .groupBy("stripe_customer_id", "invoice_month")
                    .agg(F.sum("amount_usd").alias("mrr")))
    cust = customers.select("stripe_customer_id", "account_id")
    return (per_customer.join(cust, "stripe_customer_id", "inner")
            .groupBy("invoice_month", "account_id").agg(F.sum("mrr").alias("mrr")))


def _account_window():
    return Window.partitionBy("account_id").orderBy("invoice_month")


def mrr_ledger(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """D-H: account-month MRR with movement class.

    new         – no earlier month, or the previous paid month is more than 35
                  days before this one (a return after a gap keeps its old
                  ``prev_mrr``);
    expansion / contraction / retained – compared with the previous month.
    """
    w = _account_window()
    m = (monthly_mrr(invoices, customers)
         .withColumn("_prev_mrr", F.lag("mrr").over(w))
         .withColumn("_prev_month", F.lag("invoice_month").over(w)))
    gap = F.col("_prev_month") < (F.col("invoice_month") - F.expr("INTERVAL 35 DAYS"))
    movement = (F.when(F.col("_prev_mrr").isNull() | gap, "new")
                .when(F.col("mrr") > F.col("_prev_mrr"), "expansion")
                .when(F.col("mrr") < F.col("_prev_mrr"), "contraction")
                .otherwise("retained"))
    return m.select("invoice_month", "account_id", "mrr",
                    F.coalesce("_prev_mrr", F.lit(0.0)).alias("prev_mrr"),
                    movement.alias("movement"))


def fct_ndr(ledger: DataFrame) -> DataFrame:
    """D-I: monthly net dollar retention of the previous month's paying base.

    For every account-month ``t`` the base row counts toward month ``t + 1``;
    its retained revenue is the account's next ledger row when that row is
    exactly month ``t + 1`` (else 0, i.e. churned).  Months without any paid
    invoice get no row, nor does the first month.
    """
    w = _account_window()
    nxt = (ledger.select("account_id", "invoice_month", "mrr")
           .withColumn("_next_month", F.lead("invoice_month").over(w))
           .withColumn("_next_mrr", F.lead("mrr").over(w)))
    target = F.col("invoice_month") + F.expr("INTERVAL 1 MONTH")
    # a base row counts toward month t+1; a NULL account never equals itself in
    # the published join, so it is never retained
    retained = (F.when(F.col("account_id").isNotNull() & (F.col("_next_month") == target), F.col("_next_mrr"))
                .otherwise(F.lit(0.0)))
    # each ledger row gives a base row of month t + 1 and a marker that month t
    # has revenue at all: one pass, the ledger is computed once
    base = F.struct(target.alias("invoice_month"), F.col("mrr").alias("base_mrr"),
                    retained.alias("retained_mrr"), F.lit(True).alias("_is_base"))
    marker = F.struct(F.col("invoice_month").alias("invoice_month"), F.lit(None).cast("double").alias("base_mrr"),
                      F.lit(None).cast("double").alias("retained_mrr"), F.lit(False).alias("_is_base"))
    agg = nxt.select(F.inline(F.array(base, marker))).groupBy("invoice_month").agg(
        F.count_if(F.col("_is_base")).alias("base_accounts"),
        F.sum("base_mrr").alias("_base"),
        F.sum("retained_mrr").alias("_ret"),
        F.count_if(F.col("_is_base") & (F.col("retained_mrr") == 0)).alias("churned_accounts"),
        F.max(~F.col("_is_base")).alias("_present"))
    return agg.filter(F.col("_present") & (F.col("base_accounts") > 0)).select(
        "invoice_month", "base_accounts",
        round_half_away("_base", 2).alias("base_mrr"),
        round_half_away("_ret", 2).alias("retained_mrr"),
        round_half_away(safe_div("_ret", "_base"), 4).alias("ndr"),
        "churned_accounts").orderBy("invoice_month")


def account_revenue(ledger: DataFrame) -> DataFrame:
    """A-5: lifetime revenue and paying months per account."""
    return ledger.groupBy("account_id").agg(
        F.sum("mrr").alias("total_revenue"),
        F.count_distinct("invoice_month").alias("months_paying"))


ATTRIBUTION_COLUMNS = ["channel", "accounts_signed_up", "accounts_paying", "signup_to_paid_rate",
                       "total_revenue_usd", "revenue_per_paying_account"]


def revenue_attribution(dim: DataFrame, ledger: DataFrame) -> DataFrame:
    """D-J: first-touch channel -> signups -> paying accounts -> revenue."""
    rev = (account_revenue(ledger).filter(F.col("account_id").isNotNull())
           .select("account_id", "total_revenue", F.lit(1).alias("_paying")))
    j = dim.select("account_id", "first_touch_channel").join(rev, "account_id", "left")
    g = (j.groupBy(F.coalesce("first_touch_channel", F.lit("(unattributed)")).alias("channel"))
         .agg(F.count(F.lit(1)).alias("accounts_signed_up"),
              F.count("_paying").alias("accounts_paying"),
              F.coalesce(F.sum("total_revenue"), F.lit(0.0)).alias("_rev")))
    return g.select(
        "channel", "accounts_signed_up", "accounts_paying",
        round_half_away(safe_div("accounts_paying", "accounts_signed_up"), 3).alias("signup_to_paid_rate"),
        round_half_away("_rev", 2).alias("total_revenue_usd"),
        round_half_away(safe_div("_rev", "accounts_paying"), 2).alias("revenue_per_paying_account"),
    ).orderBy(F.col("total_revenue_usd").desc_nulls_last(), F.col("channel").asc_nulls_last())


def match_rates(dim: DataFrame) -> DataFrame:
    """D-L: share of accounts matched to a CRM company and to a billing customer."""
    return dim.agg(
        round_half_away(F.avg(F.when(F.col("is_crm_matched"), 1).otherwise(0)), 3).alias("crm_match_rate"),
        round_half_away(F.avg(F.when(F.col("is_billing_matched"), 1).otherwise(0)), 3).alias("billing_match_rate"))


MOBILE_DEVICES = ["mobile_web", "ios_app", "android_app"]


def device_mix(fct: DataFrame) -> DataFrame:
    """D-M: share of events from mobile devices."""
    return fct.agg(round_half_away(
        F.avg(F.when(F.col("device_type").isin(MOBILE_DEVICES), 1).otherwise(0)), 3).alias("mobile_share"))
