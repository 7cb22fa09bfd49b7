"""A choice of registered queries against their SQL twins, on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.verify import TABLES, rows_of

SF = "/root/testdata/sf0.001"
CHOICE = [
    "key_census", "type_census", "normalize_cardinality", "documented_members", "packed_records", "rich_text_to_plain", "match_ladder", "match_multiset",
    "match_tiered", "member_diff", "asof_owner", "asof_owner_hot_groups", "explain_extra_by_prefix", "compare_attributes", "pair_results", "clean_pairs",
    "compare_primary_key_conceptual", "compare_foreign_keys", "compare_columns", "two_pass", "cell_reconcile", "infer_property_schema", "capped_exceptions",
    "content_inventory", "audit_steps", "stream_reconcile", "stream_cells_vs_baseline", "quarantine_parse_errors",
]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHOICE)
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    rel = db.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == rows_of(rel.columns, rel.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
