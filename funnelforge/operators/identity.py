"""Identity resolution: device -> user -> account -> CRM company / billing customer.

The graph has fixed depth (two hops), so it is resolved with joins, not an
iterative closure.  "Earliest claim wins" is expressed as ``min(struct(...))``
aggregations: unlike a window, an aggregate is combined map-side, so a hot key
(a shared kiosk device, an account holding a third of all users) is reduced
inside each task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelforge.functions.semantics import email_domain
from funnelforge.operators.joins import left_join_spread_nulls


def _identifies(stg_events: DataFrame) -> DataFrame:
    return stg_events.filter(F.col("event_name") == "identify")


def anon_to_user(stg_events: DataFrame, compat: bool = False,
                 with_claim_count: bool = False) -> DataFrame:
    """D-C: device -> user edges from identify events; the earliest claim wins
    (ties: smallest user_id).

    ``had_conflicting_claims`` is TRUE when the device was claimed by more than
    one distinct user.  ``compat=True`` reproduces the published model, where
    the flag is evaluated after filtering to the winning claim and is
    therefore always FALSE.
    """
    ids = (_identifies(stg_events)
           .filter(F.col("anonymous_id").isNotNull() & F.col("user_id").isNotNull())
           .select("anonymous_id", "user_id", "event_ts"))
    g = ids.groupBy("anonymous_id").agg(
        F.min(F.struct(F.col("event_ts").isNull().alias("n"), "event_ts", "user_id")).alias("_first"),
        (F.min("user_id") != F.max("user_id")).alias("_conflict"),
        F.count(F.lit(1)).alias("n_claims"))
    flag = F.lit(False) if compat else F.col("_conflict")
    cols = [F.col("anonymous_id"), F.col("_first.user_id").alias("user_id"),
            F.col("_first.event_ts").alias("first_identified_at"),
            flag.alias("had_conflicting_claims")]
    if with_claim_count:
        cols.append(F.col("n_claims"))
    return g.select(*cols)


def user_to_account(stg_events: DataFrame) -> DataFrame:
    """D-D: user -> account membership with (lower-cased) email; earliest identify
    wins (ties: account_id, then email)."""
    ids = (_identifies(stg_events)
           .filter(F.col("user_id").isNotNull() & F.col("account_id").isNotNull())
           .select("user_id", "account_id", F.lower("email").alias("email"), "event_ts"))
    g = ids.groupBy("user_id").agg(F.min(F.struct(
        F.col("event_ts").isNull().alias("n0"), "event_ts", "account_id",
        F.col("email").isNull().alias("n1"), "email")).alias("_c"))
    return g.select("user_id", F.col("_c.account_id").alias("account_id"),
                    F.col("_c.email").alias("email"), F.col("_c.event_ts").alias("joined_at"))


def primary_domains(memberships: DataFrame) -> DataFrame:
    """A-1 + N-5: each account's dominant email domain (most users; ties: the
    alphabetically first domain, NULL last)."""
    counts = (memberships.select("account_id", email_domain("email").alias("email_domain"))
              .groupBy("account_id", "email_domain").agg(F.count(F.lit(1)).alias("n_users")))
    best = counts.groupBy("account_id").agg(F.min(F.struct(
        (-F.col("n_users")).alias("k"), F.col("email_domain").isNull().alias("n"),
        "email_domain")).alias("_d"))
    return best.select("account_id", F.col("_d.email_domain").alias("email_domain"))


def dedup_companies(companies: DataFrame) -> DataFrame:
    """N-6: CRM survivorship – per domain keep the oldest record (NULL dates last,
    ties: smallest company id)."""
    g = companies.groupBy("domain").agg(F.min(F.struct(
        F.col("crm_created_at").isNull().alias("n0"), "crm_created_at",
        F.col("crm_company_id").isNull().alias("n1"), "crm_company_id",
        "company_name", "lifecycle_stage")).alias("_c"))
    return g.select("domain", "_c.crm_company_id", "_c.company_name", "_c.lifecycle_stage")


SPINE_COLUMNS = ["account_id", "email_domain", "crm_company_id", "company_name",
                 "lifecycle_stage", "stripe_customer_id", "is_crm_matched", "is_billing_matched"]


def account_spine(memberships: DataFrame, companies: DataFrame, customers: DataFrame) -> DataFrame:
    """D-E: one row per product account with its CRM company (probabilistic,
    by email domain) and billing customer (deterministic, by metadata link).

    Both lookups are equi-joins; AQE turns either into a broadcast join at run
    time when the materialized side is below the broadcast threshold.
    """
    primary = primary_domains(memberships)
    crm = dedup_companies(companies).filter(F.col("domain").isNotNull())
    with_crm = left_join_spread_nulls(primary, F.col("email_domain"), F.col("account_id"), crm, "domain")
    billing = (customers.filter(F.col("account_id").isNotNull())
               .select("account_id", "stripe_customer_id"))
    spine = with_crm.join(billing, "account_id", "left")
    return spine.select(
        "account_id", "email_domain", "crm_company_id", "company_name", "lifecycle_stage",
        "stripe_customer_id",
        F.col("crm_company_id").isNotNull().alias("is_crm_matched"),
        F.col("stripe_customer_id").isNotNull().alias("is_billing_matched"))
