"""Plan-shape assertions: the properties that matter at scale."""

import re

from event_docs import doc

from funnelforge.operators import staging
from funnelforge.plans.warehouse import Warehouse
from funnelforge.sources import testdata

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_document_parsed_once(raw_events):
    p = _plan(staging.stg_events(raw_events([doc()])))
    assert len(re.findall(r"parseJson", p)) == 1


def test_dedup_uses_group_limit_before_shuffle(raw_events):
    p = staging.stg_events(raw_events([doc()]))._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in p


def test_no_python_udfs_in_catalogue(spark):
    from funnelforge.plans import catalog
    qs = catalog.queries()
    for name in qs:
        if name.startswith(("st", "w", "q5", "q6", "da_from", "df_incremental")):
            continue  # these write and read back; their parts are planned by the others
        p = _plan(qs[name](spark, SF))
        assert "EvalPython" not in p and "PythonUDF" not in p, name


def test_null_identity_keys_are_spread(spark):
    w = Warehouse.from_testdata(spark, SF)
    p = w.fct_events._jdf.queryExecution().optimizedPlan().toString()
    assert "_jn" in p  # joins carry the null-marker key


def test_scan_prunes_columns(spark):
    w = Warehouse(testdata.raw_tables(spark, SF))
    p = _plan(w.fct_mrr_monthly)
    # orders scan reads only what the invoice adapter needs
    m = re.search(r"ReadSchema: struct<([^>]*)>", p.split("orders.parquet")[-1] if "orders.parquet" in p else p)
    assert "o_orderpriority" not in p


def test_every_query_has_an_oracle():
    from funnelforge.plans import catalog
    missing = set(catalog.queries()) - set(catalog.oracle_sql())
    assert not missing, missing


def _exchanged(df) -> list[str]:
    """The columns of every exchange of a plan."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", text)


def test_dedup_shuffles_no_document(raw_events):
    columns = _exchanged(staging.stg_events(raw_events([doc()])))
    assert columns and all("raw_json" not in c for c in columns)


def test_retention_computes_the_ledger_once(spark):
    p = _plan(Warehouse(testdata.raw_tables(spark, SF)).fct_ndr)
    assert p.count("orders.parquet") == 1


def test_contract_extracts_every_key_once(raw_events):
    from funnelforge.functions.contract import contract_keys, PRODUCT_EVENT_V1, validate
    p = _plan(validate(raw_events([doc()])).filter("size(violations) > 0"))
    assert len(re.findall(r"parseJson", p)) == 1
    assert p.count("map<string,variant>") <= 2 and len(contract_keys(PRODUCT_EVENT_V1)) > 5
