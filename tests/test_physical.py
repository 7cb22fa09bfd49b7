"""Physical comparison, repair and counts: whole results, and inputs that are read once."""

from pyspark.sql import functions as F

from veritwin.config import PHYSICAL
from veritwin.operators import matching as m
from veritwin.plans import flow, scoring
from veritwin.plans import physical as ph

COLUMN = "pair_id string, `table` string, `column` string, ord long, data_type string, not_null boolean, default_value string"
S = [("a", "T1", "C1", 1, "INTEGER", True, None), ("a", "T1", "C2", 2, "DATE", True, ""), ("a", "T1", "C2", 3, "INTEGER", True, ""),
     ("a", "T2", "C1", 1, "INTEGER", True, ""), ("b", "T1", "C1", 1, "INTEGER", None, ""), (None, "T1", "C1", 1, "INTEGER", True, "")]
T = [("a", "T1", "C1", 1, "int", True, None), ("b", "T1", "C1", 1, "int", None, ""), ("b", "T1", "C1", 0, "DATE", None, "")]


def written(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_two_pass_goes_on_from_what_it_wrote(spark, tmp_path):
    s, t = written(spark, tmp_path / "s", S, COLUMN), written(spark, tmp_path / "t", T, COLUMN)
    out = flow.two_pass(s, t, PHYSICAL)
    # The last duplicate is compared and comes back; a table that is gone does not.
    assert {tuple(r) for r in out["actions"].where("pair_id is not null").collect()} == {
        ("a", "T1", "C2", "RESTORED"), ("a", "T2", "C1", "TABLE_MISSING")}
    back = out["snapshot"].where("`column` = 'C2'").collect()
    assert [(r["ord"], r["data_type"]) for r in back] == [(3, "INTEGER")]
    stage = {r["pair_id"]: (r["stage"], r["columns_s"], r["columns_missing"]) for r in out["final"].collect() if r["pair_id"]}
    assert stage == {"a": ("2_preprocessed", 3, 1), "b": ("3_final", 1, 0)}
    repaired = flow.as_imported(out["initial_findings"], out["final_findings"]).where("pair_id = 'a' and category = 'COLUMN_MISSING'")
    assert {(r["object_name"], r["member"]): r["repaired"] for r in repaired.collect()} == {("T1", "C2"): True, ("T2", "C1"): False}
    # Neither snapshot is read again after the first pass.
    for name in ("actions", "snapshot", "final", "initial_findings", "final_findings"):
        assert not [f for f in out[name].inputFiles() if f"{tmp_path}/" in f], name
        assert out[name].inputFiles(), name


def test_references_are_read_once(spark, tmp_path):
    schema = "pair_id string, ord long, name string, parent_table string, child_table string, joins array<struct<parent_col: string, child_col: string>>"
    rows = [("a", i, f"F{i}", "p", "c", [("x", "y")]) for i in range(3)] + [(None, 9, "F9", "p", "c", [("x", "y")])]
    s = ph.with_fk_signature(written(spark, tmp_path / "s", rows, schema))
    t = ph.with_fk_signature(written(spark, tmp_path / "t", rows[1:], schema))
    records, found = ph.compare_foreign_keys(s, t)
    # Rows without a pair meet nobody.
    assert sorted(r["status"] for r in records.collect()) == ["EXTRA", "MATCHED", "MATCHED", "MISSING", "MISSING"]
    many = found.where("category = 'FOREIGN_KEY_DUPLICATE'").collect()
    assert [(r["pair_id"], r["message"], r["t_value"]) for r in many] == [("a", "3 references share one signature", "2")]
    assert records.columns == m.match_multiset(s.drop("joins"), t.drop("joins"), ["pair_id", "signature"], ["ord"], ["ord"]).columns
    assert not [f for f in found.inputFiles() if f"{tmp_path}/" in f]


def test_totals_and_repeats_are_counted_in_one_scan(spark, tmp_path):
    s = written(spark, tmp_path / "s", [(*r, 0) for r in S], COLUMN + ", only_s int")
    t = written(spark, tmp_path / "t", T, COLUMN)
    tables = spark.createDataFrame([("a", "T1", 0, 2), ("a", "T1", 1, 2), ("b", "T1", 0, 1)], "pair_id string, `table` string, ord int, n_columns int")
    refs = spark.createDataFrame([("a", "MATCHED")], "pair_id string, status string")
    records = flow.stored(ph.column_records(s, t), "records")
    found = ph.physical_counters(ph.compare_tables(tables, tables, PHYSICAL)[0], records, tables, tables, s, t, refs)
    row = found.where("pair_id = 'a'").first()
    assert [row[c] for c in ("tables_s", "tables_duplicate_s", "columns_s", "columns_duplicate_s", "columns_t", "columns_matched", "columns_missing", "fks_s")] == [2, 1, 4, 1, 1, 1, 2, 1]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("only_s#") == 1
    assert found.where(F.col("pair_id") == "b").first()["columns_duplicate_t"] == 1


def test_totals_of_references_are_counted_from_the_references(spark):
    """A record that is lost or there twice breaks the identity of its side; so does a total that is not known."""
    schema = "pair_id string, ord long, name string, parent_table string, child_table string, joins array<struct<parent_col: string, child_col: string>>"
    rows = [(p, i, f"F{i}", "p", f"c{i // 2}", [("x", "y")]) for p in "abc" for i in range(4)]
    s, t = (ph.with_fk_signature(spark.createDataFrame(r, schema)) for r in (rows, rows[:-2]))
    records = ph.compare_foreign_keys(s, t)[0]
    tables = spark.createDataFrame([(p, "T", 0, 0) for p in "abc"], "pair_id string, `table` string, ord int, n_columns int")
    columns = spark.createDataFrame([], COLUMN)

    def broken(refs):
        found = ph.physical_counters(ph.compare_tables(tables, tables, PHYSICAL)[0], ph.column_records(columns, columns), tables, tables, columns, columns, refs, s, t)
        return {r["pair_id"]: (r["fks_s"], r["fks_t"], r["broken"]) for r in scoring.count_identities(found, ["tables", "columns", "fks"]).collect()}

    assert broken(records) == {"a": (4, 4, []), "b": (4, 4, []), "c": (4, 2, [])}
    lost = records.where("not (pair_id = 'a' and s_name = 'F1')")
    assert broken(lost) == {"a": (4, 4, ["fks_s", "fks_t"]), "b": (4, 4, []), "c": (4, 2, [])}
    twice = records.union(records.where("status = 'MISSING' and s_name = 'F3'"))
    assert broken(twice) == {"a": (4, 4, []), "b": (4, 4, []), "c": (4, 2, ["fks_s"])}
    unknown = spark.createDataFrame([("a", None, 1, 1, 0, 0)], "pair_id string, x_s int, x_t int, x_matched int, x_missing int, x_extra int")
    assert scoring.count_identities(unknown, ["x"]).first()["broken"] == ["x_s"]
