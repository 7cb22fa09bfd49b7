"""Every query of the package runs over the smallest tables, and the digests are what the contract says."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from tests.llm import test_pii, test_secrets
from tools.verify import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in entry.LLM_QUERIES])
def test_runs(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() > 0


@pytest.mark.parametrize("name, brute", [("op1_secrets", test_secrets.brute_base), ("op4_pii", test_pii.brute)])
def test_digests(spark, name, brute):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = entry.queries()[name](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))


@pytest.mark.parametrize("name", [n for n in entry.LLM_ORACLES])
def test_equals_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, rel = entry.queries()[name](spark, SF), db.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(rel.columns, rel.fetchall())
