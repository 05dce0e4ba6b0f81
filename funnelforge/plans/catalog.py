"""The query catalogue: one named Spark query per operator / model / metric,
each paired (where expressible) with its DuckDB oracle.

Every query reads the TESTDATA tables of ``sf_dir`` through the adapters, so
its work grows with the data.  Keys are ``<survey id>_<short name>``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from funnelforge.operators import staging
from funnelforge.plans import metrics
from funnelforge.plans.oracle import with_ctes
from funnelforge.plans.warehouse import Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = with_ctes(oracle)
        return fn
    return deco


def _wh(spark: SparkSession, sf_dir: str, **kw) -> Warehouse:
    kw.setdefault("materialize", True)
    return Warehouse.from_testdata(spark, sf_dir, **kw)


_ONE_READER = {"parsed_events", "dead_letter", "anon_to_user", "user_to_account", "account_spine",
               "fct_mrr_monthly", "fct_ndr"}


def _model(name: str, attr: str, oracle_cte: str, columns: list[str] | None = None):
    cols = ", ".join(columns) if columns else "*"

    def fn(spark, sf_dir):
        # a model that reads stg_events once (or precedes it) stays one lazy plan
        lazy = attr in _ONE_READER or attr.startswith("stg_")
        df = getattr(_wh(spark, sf_dir, materialize=not lazy), attr)
        return df.select(*columns) if columns else df
    fn.__name__ = name
    register(name, f"SELECT {cols} FROM {oracle_cte}")(fn)


# ---------------------------------------------------------------- staging (P)
_P1_COLS = ["event_id", "event_name", "event_name_json_type", "event_ts", "received_ts",
            "anonymous_id", "user_id", "device_type", "account_id", "page", "utm_source",
            "email", "schema_version", "raw_json"]
_model("p1_parse_events", "parsed_events", "parsed_events", _P1_COLS)
_model("p2_stg_companies", "stg_companies", "stg_companies")
_model("p3_stg_contacts", "stg_contacts", "stg_contacts")
_model("p4_stg_deals", "stg_deals", "stg_deals")
_model("p5_stg_customers", "stg_customers", "stg_customers")
_model("p6_stg_subscriptions", "stg_subscriptions", "stg_subscriptions")
_model("p7_stg_invoices", "stg_invoices", "stg_invoices")

# ---------------------------------------------------------- transforms (D)
_model("da_stg_events", "stg_events", "stg_events")
_model("db_dead_letter", "dead_letter", "dead_letter", ["event_id", "raw_json", "failure_reason"])
_model("dc_anon_to_user", "anon_to_user", "anon_to_user")
_model("dd_user_to_account", "user_to_account", "user_to_account")
_model("de_account_spine", "account_spine", "account_spine")
_model("df_fct_events", "fct_events", "fct_events")
_model("dg_dim_accounts", "dim_accounts", "dim_accounts")
_model("dh_fct_mrr_monthly", "fct_mrr_monthly", "fct_mrr_monthly")
_model("di_fct_ndr", "fct_ndr", "fct_ndr")
_model("dj_revenue_attribution", "fct_revenue_attribution", "fct_revenue_attribution")


# ------------------------------------------------------------ golden (G)
_LATEST = "QUALIFY row_number() OVER (ORDER BY invoice_month DESC) = 1"
_CHANNELS = "SELECT channel FROM fct_revenue_attribution"
_ONE_CHANNEL = "FROM fct_revenue_attribution SELECT {} WHERE channel = '{}'"
_MONTHS = "(FROM fct_mrr_monthly SELECT invoice_month, round(sum(mrr), 2) AS total_mrr GROUP BY ALL)"
_GOLDEN_SQL = {
    "g1_mrr_last_month": f"SELECT max_by(total_mrr, invoice_month) AS total_mrr FROM {_MONTHS}",
    "g2_ndr_latest": f"FROM fct_ndr SELECT ndr {_LATEST}",
    "g3_top_channel_revenue": f"{_CHANNELS} ORDER BY total_revenue_usd DESC, channel LIMIT 1",
    "g4_best_conversion_channel": f"{_CHANNELS} ORDER BY signup_to_paid_rate DESC, channel LIMIT 1",
    "g5_churned_last_month": f"FROM fct_ndr SELECT churned_accounts {_LATEST}",
    "g6_paying_accounts": "SELECT count(DISTINCT account_id) AS paying_accounts FROM fct_mrr_monthly",
    "g7_google_signups": _ONE_CHANNEL.format("accounts_signed_up", "google"),
    "g8_expansion_accounts": "SELECT count_if(movement = 'expansion') AS n FROM fct_mrr_monthly",
    "g9_crm_match_rate": "SELECT round(count_if(is_crm_matched) / count(*), 3) AS crm_match_rate FROM dim_accounts",
    "g10_events_stitched": "SELECT count_if(is_stitched) AS stitched FROM fct_events",
    "g11_docs_created_total": "SELECT count_if(event_name = 'doc_created') AS docs FROM fct_events",
    "g12_mrr_by_month": f"FROM {_MONTHS}",
    "g13_unattributed_accounts": _ONE_CHANNEL.format("accounts_signed_up", "(unattributed)"),
    "g14_revenue_per_paying_producthunt": _ONE_CHANNEL.format("revenue_per_paying_account", "producthunt"),
    "g15_mobile_events_share": "SELECT round(count_if(device_type IN ('mobile_web', 'ios_app', 'android_app')) "
                               "/ count(*), 3) AS mobile_share FROM fct_events",
}


@register("dk_late_events", "SELECT * FROM stg_events WHERE arrival_delay_hours > 24")
def dk_late_events(spark, sf_dir):
    return staging.late_events(_wh(spark, sf_dir, materialize=False).stg_events)


@register("dl_match_rates", """
SELECT round(count_if(is_crm_matched) / count(*), 3) AS crm_match_rate,
       round(count_if(is_billing_matched) / count(*), 3) AS billing_match_rate FROM dim_accounts""")
def dl_match_rates(spark, sf_dir):
    from funnelforge.operators.marts import match_rates
    return match_rates(_wh(spark, sf_dir).dim_accounts)


@register("dm_device_mix", _GOLDEN_SQL["g15_mobile_events_share"])
def dm_device_mix(spark, sf_dir):
    from funnelforge.operators.marts import device_mix
    return device_mix(_wh(spark, sf_dir).fct_events)


def _golden(name: str):
    def fn(spark, sf_dir):
        return metrics.golden(_wh(spark, sf_dir), [name])[name]
    fn.__name__ = name
    return fn


for _n, _sql in _GOLDEN_SQL.items():
    register(_n, _sql)(_golden(_n))


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def _load_more() -> None:
    # second half of the catalogue registers itself on import
    import funnelforge.plans.catalog_more  # noqa: F401


_load_more()
