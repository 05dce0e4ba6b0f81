"""The registered queries: contract columns, and SQL where it can say the same."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracles import rows_key  # noqa: E402

from funnelforge.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op3_html_extract": ["page_id", "url", "text", "n_chars"],
    "op4_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op5_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op7_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op8_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op9_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op10_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
}
TABLE = {"op2_nearest_neighbours": "embeddings", "op3_html_extract": "pages", "op6_url_filter": "pages"}


@pytest.mark.parametrize("name", COLUMNS)
def test_contract_columns_and_whole_table(spark, name):
    got = queries.queries()[name](spark, SF)
    assert got.columns[:len(COLUMNS[name])] == COLUMNS[name]
    rows = got.collect()
    there = spark.read.parquet(f"{SF}/{TABLE.get(name, 'documents')}.parquet").count()
    if name == "op2_nearest_neighbours":
        assert len({r.query_id for r in rows}) == -(-there // 20) and all(1 <= r.rank <= 20 for r in rows)
    elif name == "op7_packing":
        assert len({r.doc_id for r in rows}) == there
    else:
        assert len(rows) == there
    if sql := queries.oracle_sql().get(name):
        con = duckdb.connect()
        for t in ("documents", "benchmark"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        want = con.sql(sql)
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_key(got.columns, [tuple(r) for r in rows]) == rows_key(want.columns, want.fetchall())
