"""A slice of the driver's correctness gate, at sf0.001: Spark vs DuckDB."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from check_oracles import rows_key  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["da_stg_events", "db_dead_letter", "de_account_spine", "df_fct_events", "dh_fct_mrr_monthly",
         "di_fct_ndr", "dj_revenue_attribution", "k1_contract_violations", "g10_events_stitched",
         "w6_incremental_upsert", "st1_stream_contract_routing", "q5_dq_report", "a10_dead_letter_summary"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["events", "customer", "orders"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    import __spark_entry__ as entry
    df = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_key(df.columns, [tuple(r) for r in df.collect()]) == rows_key(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["channel", "accounts_signed_up", "accounts_paying", "signup_to_paid_rate",
                          "total_revenue_usd", "revenue_per_paying_account"]
    assert df.count() >= 1


def test_attribution_conserves_revenue_of_known_accounts(spark):
    """Revenue attributed to channels = ledger revenue of the accounts in dim_accounts."""
    from pyspark.sql import functions as F

    from funnelforge.plans.warehouse import Warehouse
    w = Warehouse.from_testdata(spark, SF, materialize=True)
    att = w.fct_revenue_attribution.agg(F.sum("total_revenue_usd")).first()[0]
    known = (w.fct_mrr_monthly.join(w.dim_accounts.select("account_id"), "account_id", "left_semi")
             .agg(F.sum("mrr")).first()[0])
    assert abs(att - known) < 0.01 * max(1, len(w.fct_revenue_attribution.collect()))
    signed = w.fct_revenue_attribution.agg(F.sum("accounts_signed_up")).first()[0]
    assert signed == w.dim_accounts.count()
