"""Identity resolution and mart cases with exact expected rows."""

import datetime as dt

from event_docs import doc
from pyspark.sql import Row

from funnelforge.operators import identity, marts, staging
from funnelforge.sources import bronze

A = "anon_" + "a" * 12
U1, U2 = "usr_" + "1" * 12, "usr_" + "2" * 12


def _eid(i):
    return "evt_" + f"{i:032x}"


def test_stitching_is_retroactive(raw_events):
    docs = [doc(event_id=_eid(1), name="page_viewed", ts="2025-01-01T09:00:00Z", anon=A, utm="google"),
            doc(event_id=_eid(2), name="identify", ts="2025-01-01T10:00:00Z", anon=A, user=U1,
                account="acct_1", email="X@A.com")]
    stg = staging.stg_events(raw_events(docs))
    edges = identity.anon_to_user(stg)
    members = identity.user_to_account(stg)
    fct = marts.fct_events(stg, edges, members).collect()
    assert len(fct) == 1
    r = fct[0]
    assert (r.user_id, r.account_id, r.is_stitched) == (U1, "acct_1", True)
    assert members.first().email == "x@a.com"


def test_two_claims_first_wins_and_conflict_flagged(raw_events):
    docs = [doc(event_id=_eid(1), name="identify", ts="2025-01-01T10:00:00Z", anon=A, user=U2),
            doc(event_id=_eid(2), name="identify", ts="2025-01-02T10:00:00Z", anon=A, user=U1)]
    stg = staging.stg_events(raw_events(docs))
    r = identity.anon_to_user(stg).first()
    assert r.user_id == U2 and r.had_conflicting_claims is True
    assert identity.anon_to_user(stg, compat=True).first().had_conflicting_claims is False


def test_repeat_identify_same_user_is_not_a_conflict(raw_events):
    docs = [doc(event_id=_eid(1), name="identify", ts="2025-01-01T10:00:00Z", anon=A, user=U1),
            doc(event_id=_eid(2), name="identify", ts="2025-01-02T10:00:00Z", anon=A, user=U1)]
    r = identity.anon_to_user(staging.stg_events(raw_events(docs)), with_claim_count=True).first()
    assert r.had_conflicting_claims is False and r.n_claims == 2


def _companies(spark, rows):
    return spark.createDataFrame(
        [Row(id=i, properties=Row(name=n, domain=d, industry=None, numberofemployees=None,
                                  lifecyclestage="customer", createdate=c)) for i, n, d, c in rows],
        bronze.HUBSPOT_COMPANIES)


def _customers(spark, rows):
    return spark.createDataFrame(
        [Row(id=i, object="customer", email=None, name=None, created=0, metadata=Row(account_id=a))
         for i, a in rows], bronze.STRIPE_CUSTOMERS)


def test_spine_domain_vote_survivorship_and_stale_domain(spark):
    members = spark.createDataFrame(
        [("u1", "acct_1", "a@a.com"), ("u2", "acct_1", "b@a.com"), ("u3", "acct_1", "c@b.com"),
         ("u4", "acct_2", "d@x.com")], "user_id string, account_id string, email string")
    comps = staging.stg_companies(_companies(spark, [
        ("co_new", "A new", "A.com", "2024-01-01T00:00:00Z"),
        ("co_old", "A old", "a.com", "2020-01-01T00:00:00Z"),
        ("co_x", "X", "x.co", "2020-01-01T00:00:00Z")]))
    cust = staging.stg_customers(_customers(spark, [("cus_1", "acct_1"), ("cus_9", None)]))
    spine = {r.account_id: r for r in identity.account_spine(members, comps, cust).collect()}
    assert len(spine) == 2
    a1, a2 = spine["acct_1"], spine["acct_2"]
    assert (a1.email_domain, a1.crm_company_id, a1.is_crm_matched, a1.stripe_customer_id) == \
        ("a.com", "co_old", True, "cus_1")
    assert (a2.email_domain, a2.is_crm_matched, a2.is_billing_matched) == ("x.com", False, False)


def _invoices(spark, rows):
    """rows: (id, customer, cents, status, yyyy, mm, lines)"""
    out = []
    for i, c, cents, st, y, m, lines in rows:
        created = int(dt.datetime(y, m, 15, tzinfo=dt.timezone.utc).timestamp())
        out.append(Row(id=i, object="invoice", customer=c, subscription=None, amount_paid=cents,
                       currency="usd", status=st, created=created,
                       lines=Row(data=[Row(quantity=q, price=Row(id="p")) for q in lines])))
    return spark.createDataFrame(out, bronze.STRIPE_INVOICES)


def test_mrr_movements_and_uncollectible(spark):
    inv = staging.stg_invoices(_invoices(spark, [
        ("i1", "cus_a", 10000, "paid", 2025, 1, [1]), ("i2", "cus_a", 12000, "paid", 2025, 2, [1]),
        ("i3", "cus_a", 9000, "paid", 2025, 3, [1]), ("i4", "cus_a", 9000, "paid", 2025, 4, [1]),
        ("i5", "cus_a", 9000, "paid", 2025, 6, []), ("i6", "cus_a", 50000, "uncollectible", 2025, 6, [1])]))
    cust = staging.stg_customers(_customers(spark, [("cus_a", "acct_a")]))
    led = marts.mrr_ledger(inv, cust).orderBy("invoice_month").collect()
    assert [r.movement for r in led] == ["new", "expansion", "contraction", "retained", "new"]
    assert [r.mrr for r in led] == [100.0, 120.0, 90.0, 90.0, 90.0]
    assert led[-1].prev_mrr == 90.0 and led[0].prev_mrr == 0.0
    seats = {r.stripe_invoice_id: r.seat_count for r in inv.collect()}
    assert seats["i5"] is None and seats["i1"] == 1


def test_ndr_cohort(spark):
    ledger = spark.createDataFrame([
        (dt.datetime(2025, 1, 1), "A", 100.0), (dt.datetime(2025, 1, 1), "B", 50.0),
        (dt.datetime(2025, 2, 1), "A", 110.0), (dt.datetime(2025, 2, 1), "C", 10.0)],
        "invoice_month timestamp_ntz, account_id string, mrr double")
    rows = marts.fct_ndr(ledger).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.invoice_month == dt.datetime(2025, 2, 1)
    assert (r.base_accounts, r.base_mrr, r.retained_mrr, r.ndr, r.churned_accounts) == (2, 150.0, 110.0, 0.7333, 1)


def test_attribution_unattributed_account(spark):
    dim = spark.createDataFrame([("acct_1", None), ("acct_2", "google")],
                                "account_id string, first_touch_channel string")
    ledger = spark.createDataFrame([(dt.datetime(2025, 1, 1), "acct_2", 30.0)],
                                   "invoice_month timestamp_ntz, account_id string, mrr double")
    out = {r.channel: r for r in marts.revenue_attribution(dim, ledger).collect()}
    u = out["(unattributed)"]
    assert (u.accounts_signed_up, u.accounts_paying, u.total_revenue_usd, u.revenue_per_paying_account) == \
        (1, 0, 0.0, None)
    g = out["google"]
    assert (g.accounts_paying, g.signup_to_paid_rate, g.revenue_per_paying_account) == (1, 1.0, 30.0)


def test_round_matches_binary_value_rounding(spark):
    from funnelforge.functions.semantics import round_half_away
    r = spark.createDataFrame([(1.005,), (2.675,), (-1.005,)], "x double").select(
        round_half_away("x", 2).alias("r")).collect()
    assert [x.r for x in r] == [1.0, 2.68, -1.0]
