"""The model graph: bronze tables -> silver -> gold, as lazy DataFrames.

``Warehouse`` wires the operators together once; every attribute is a lazy
DataFrame, built on first access and shared by everything downstream, so a
single Spark query over e.g. ``attribution`` contains the whole lineage and
Catalyst can prune columns / push filters through all of it.  Materializing
(``plans.build``) swaps an attribute for a read of its written table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from funnelforge.operators import identity, marts, staging
from funnelforge.session import scratch_path
from funnelforge.sources import testdata


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder; return the re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


class Warehouse:
    def __init__(self, raw: dict[str, DataFrame], strict_dead_letter: bool = False,
                 compat_conflicts: bool = False, materialize: bool | str = False, measure_hot_keys: bool = False):
        """``materialize=True`` writes ``stg_events`` (four consumers: both
        identity models, fct_events and the quality checks) once to the shared
        checkpoint folder and reads it back, cutting its lineage: downstream
        plans start from that table, and a lost executor re-reads files instead
        of recomputing the parse + dedup shuffle.  ``materialize="all"`` does
        the same for every silver and gold model (for jobs such as the quality
        report that read most models several times)."""
        self.raw = raw
        self.strict_dead_letter = strict_dead_letter
        self.compat_conflicts = compat_conflicts
        self.measure_hot_keys = measure_hot_keys
        if materialize == "all":
            self._materialize = set(SILVER_TABLES) | set(GOLD_TABLES)
        elif materialize:
            self._materialize = {"stg_events"}
        else:
            self._materialize = set()

    def _out(self, name: str, df: DataFrame) -> DataFrame:
        return materialized(df, name) if name in self._materialize else df

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "Warehouse":
        return cls(testdata.raw_tables(spark, sf_dir), **kw)

    def override(self, name: str, df: DataFrame) -> None:
        """Replace a model by a materialized version (e.g. a written table)."""
        self.__dict__[name] = df

    # ---- silver: events
    @cached_property
    def parsed_events(self) -> DataFrame:
        return self._out("parsed_events", staging.parse_events(self.raw["events_raw"]))

    @cached_property
    def stg_events(self) -> DataFrame:
        return self._out("stg_events", staging.stg_events(self.raw["events_raw"]))

    @cached_property
    def dead_letter(self) -> DataFrame:
        return self._out("dead_letter", staging.dead_letter(self.raw["events_raw"], strict=self.strict_dead_letter))

    # ---- silver: CRM / billing
    @cached_property
    def stg_companies(self) -> DataFrame:
        return self._out("stg_companies", staging.stg_companies(self.raw["hubspot_companies"]))

    @cached_property
    def stg_contacts(self) -> DataFrame:
        return self._out("stg_contacts", staging.stg_contacts(self.raw["hubspot_contacts"]))

    @cached_property
    def stg_deals(self) -> DataFrame:
        return self._out("stg_deals", staging.stg_deals(self.raw["hubspot_deals"]))

    @cached_property
    def stg_customers(self) -> DataFrame:
        return self._out("stg_customers", staging.stg_customers(self.raw["stripe_customers"]))

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return self._out("stg_subscriptions", staging.stg_subscriptions(self.raw["stripe_subscriptions"]))

    @cached_property
    def stg_invoices(self) -> DataFrame:
        return self._out("stg_invoices", staging.stg_invoices(self.raw["stripe_invoices"]))

    # ---- silver: identity
    @cached_property
    def anon_to_user(self) -> DataFrame:
        return self._out("anon_to_user", identity.anon_to_user(self.stg_events, compat=self.compat_conflicts))

    @cached_property
    def user_to_account(self) -> DataFrame:
        return self._out("user_to_account", identity.user_to_account(self.stg_events))

    @cached_property
    def account_spine(self) -> DataFrame:
        return self._out("account_spine", identity.account_spine(self.user_to_account, self.stg_companies, self.stg_customers))

    # ---- gold
    @cached_property
    def fct_events(self) -> DataFrame:
        return self._out("fct_events", marts.fct_events(
            self.stg_events, self.anon_to_user, self.user_to_account, measure_hot_keys=self.measure_hot_keys))

    @cached_property
    def dim_accounts(self) -> DataFrame:
        return self._out("dim_accounts", marts.dim_accounts(self.account_spine, self.fct_events))

    @cached_property
    def fct_mrr_monthly(self) -> DataFrame:
        return self._out("fct_mrr_monthly", marts.mrr_ledger(self.stg_invoices, self.stg_customers))

    @cached_property
    def fct_ndr(self) -> DataFrame:
        return self._out("fct_ndr", marts.fct_ndr(self.fct_mrr_monthly))

    @cached_property
    def fct_revenue_attribution(self) -> DataFrame:
        return self._out("fct_revenue_attribution", marts.revenue_attribution(self.dim_accounts, self.fct_mrr_monthly))


GOLD_TABLES = ["fct_events", "dim_accounts", "fct_mrr_monthly", "fct_ndr", "fct_revenue_attribution"]
SILVER_TABLES = ["stg_events", "dead_letter", "stg_companies", "stg_contacts", "stg_deals",
                 "stg_customers", "stg_subscriptions", "stg_invoices", "anon_to_user",
                 "user_to_account", "account_spine"]
