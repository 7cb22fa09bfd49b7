"""Comparison of physical models: tables, columns, keys, references, indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Tier
from ..functions import types as ty
from ..functions.text import ABSENT, compare_key, fk_signature, index_signature, text, trim_ws
from ..operators import matching as m
from ..operators.shaping import dedupe_objects, duplicate_report
from ..session import stored
from .findings import check, emit, or_none

PAIR = ["pair_id"]
TABLE = ["pair_id", "table"]


def keyed(df: DataFrame, code: str, out: str, case_insensitive: bool = True) -> DataFrame:
    return df.withColumn(out, compare_key(code, case_insensitive))


def compare_tables(s: DataFrame, t: DataFrame, tier: Tier) -> tuple[DataFrame, DataFrame]:
    """(table records, findings). Input (pair_id, table, ord, n_columns).

    The first table of a name is compared, the others are counted and reported.
    """
    records = m.reconcile_keyed(
        dedupe_objects(s, TABLE, ["ord"]).select(*TABLE, "n_columns"),
        dedupe_objects(t, TABLE, ["ord"]).select(*TABLE, "n_columns"), TABLE)
    status = F.col("status")
    at = dict(object_type="TABLE", object_name=F.col("table"))
    sized = [F.concat(F.col(f"{x}_n_columns").cast("string"), F.lit(" columns")) for x in ("s", "t")]
    checks = []
    if tier.tables:
        checks = [
            check(status == "MISSING", "TABLE_MISSING", "table only in source", F.col("table"), ABSENT, **at),
            check(status == "EXTRA", "TABLE_EXTRA", "table only in target", ABSENT, F.col("table"), **at),
            check(status == "MATCHED", "TABLE_VERIFIED", "table in both", sized[0], sized[1], **at),
        ]
    n = F.concat(F.col("objects").cast("string"), F.lit(" tables"))
    one = F.lit("1 compared")

    def repeated(df, s_value, t_value):
        return emit(duplicate_report(df, TABLE), PAIR,
                    [check(F.lit(True), "TABLE_DUPLICATE", "tables share one name", s_value, t_value, **at)])

    found = repeated(s, n, one).unionByName(repeated(t, one, n))
    return records, (emit(records, PAIR, checks).unionByName(found) if checks else found)


def column_records(s: DataFrame, t: DataFrame, positions: bool = False, s_unique: bool = False) -> DataFrame:
    """Columns of tables both sides hold, by (pair, table, column); the last duplicate counts.

    Input (pair_id, table, column, ord, data_type, not_null, default_value). ``positions``
    keeps ``ord`` of both sides; with ``s_unique`` S has no duplicates.
    """
    key = ["_hash", *TABLE, "column"]
    cols = [*key, *(["ord"] if positions else []), "data_type", "not_null", "default_value"]

    def side(df, unique):
        # Sorted by a number first: codes begin alike, and comparing them is most of the sort.
        df = df.withColumn("_hash", F.xxhash64(*TABLE, "column"))
        return (df if unique else dedupe_objects(df, key, ["ord"], "last")).select(*cols)

    return m.reconcile_keyed(side(s, s_unique), side(t, False), key).drop("_hash")


def _with_types(df: DataFrame, tier: Tier) -> DataFrame:
    if "_change" in df.columns:
        return df
    df = ty.with_physical_type(ty.with_physical_type(df, "s_data_type", "_s_"), "t_data_type", "_t_")
    return df.withColumn("_change", ty.type_change_class("_s_", "_t_", tier.abstract_types))


def with_types(records: DataFrame, tier: Tier) -> DataFrame:
    """Records with what ``compare_columns`` needs of their types; types are read once, not by each of its readers."""
    return _with_types(records, tier).select(*records.columns, "_s_type", "_t_type", "_change")


def column_checks(tier: Tier) -> list[Column]:
    """Differences of a matched column whose types were read by ``_with_types``."""
    at = dict(object_type="COLUMN", object_name=F.col("table"), member=F.col("column"))
    checks = []
    if tier.data_types:
        change = F.col("_change")
        category = F.when(change == "ABSTRACT", "DATA_TYPE_ABSTRACT").when(
            change == "LENGTH", "DATA_TYPE_LENGTH").otherwise("DATA_TYPE")

        def shown(side):
            return F.concat(F.col(f"{side}_data_type"), F.lit(" → "), F.col(f"_{side}_type"))

        checks.append(check(change.isNotNull(), category, "data type differs", shown("s"), shown("t"), **at))
    if tier.nullability:

        def word(c):
            return F.when(F.col(c), "NOT NULL").otherwise("NULL")

        checks.append(
            check(~F.col("s_not_null").eqNullSafe(F.col("t_not_null")), "NULLABILITY", "nullability differs",
                  word("s_not_null"), word("t_not_null"), **at))
    if tier.defaults:
        checks.append(
            check(compare_key("s_default_value", tier.case_insensitive) != compare_key("t_default_value", tier.case_insensitive),
                  "DEFAULT", "default differs", or_none(trim_ws("s_default_value")), or_none(trim_ws("t_default_value")), **at))
    return checks


def compare_columns(records: DataFrame, tier: Tier) -> DataFrame:
    """Findings of column records whose table exists on both sides, in one scan.

    VERIFIED means: no difference that the severity policy keeps.
    """
    status = F.col("status")
    at = dict(object_type="COLUMN", object_name=F.col("table"), member=F.col("column"))
    matched = status == "MATCHED"
    ignored = [k for k, v in tier.overrides.items() if v == "IGNORE"]
    df = _with_types(records, tier)
    names, clean = [], F.lit(True)
    for i, found in enumerate(column_checks(tier)):
        fired = F.when(matched & ~found["category"].isin(*ignored), found) if ignored else F.when(matched, found)
        names.append(f"_f{i}")
        df = df.withColumn(names[-1], fired)
        clean = clean & F.col(names[-1]).isNull()
    intact = check(matched & clean, "COLUMN_VERIFIED", "column intact", or_none(F.col("s_data_type"), "(untyped)"),
                   or_none(F.col("t_data_type"), "(untyped)"), **at)
    return emit(df, PAIR, [
        *[F.col(n) for n in names], intact,
        check(status == "MISSING", "COLUMN_MISSING", "column only in source", F.col("column"), ABSENT, **at),
        check(status == "EXTRA", "COLUMN_EXTRA", "column only in target", ABSENT, F.col("column"), **at),
    ])


def compare_duplicate_columns(s: DataFrame, t: DataFrame) -> DataFrame:
    """COLUMN_DUPLICATE for names a table defines more than once, one row per side."""
    key = [*TABLE, "column"]
    at = dict(object_type="COLUMN", object_name=F.col("table"), member=F.col("column"))

    def counted(df, name):
        return df.groupBy(*key).agg(F.count("*").alias(name))

    both = counted(s, "n_s").join(counted(t, "n_t"), key, "full")
    n_s, n_t = F.coalesce("n_s", F.lit(1)), F.coalesce("n_t", F.lit(1))
    many = [F.concat(n.cast("string"), F.lit(" columns share this name")) for n in (n_s, n_t)]
    return emit(both, PAIR, [
        check(n_s > 1, "COLUMN_DUPLICATE", "defined more than once in source", many[0], n_t.cast("string"), **at),
        check(n_t > 1, "COLUMN_DUPLICATE", "defined more than once in target", n_s.cast("string"), many[1], **at),
    ])


def compare_physical_pk(pairs: DataFrame) -> DataFrame:
    """Primary keys of matched tables, order ignored. (pair_id, table, s_members, t_members)."""

    def cols(c):
        return F.array_sort(F.array_distinct(F.transform(c, lambda x: compare_key(x))))

    s, t = cols("s_members"), cols("t_members")
    no_s, no_t = F.col("s_members").isNull(), F.col("t_members").isNull() | (F.size("t_members") == 0)
    shown = [F.concat_ws(",", x) for x in (s, t)]
    at = dict(object_type="PRIMARY_KEY", object_name=F.col("table"))
    return emit(pairs, PAIR, [
        check(no_s & F.col("t_members").isNotNull(), "PRIMARY_KEY_T_ONLY", "primary key only in target", "(none)", shown[1], **at),
        check(~no_s & no_t, "PRIMARY_KEY", "primary key lost", shown[0], "(none)", **at),
        check(~no_s & ~no_t & (s != t), "PRIMARY_KEY", "primary key columns differ", shown[0], shown[1], **at),
        check(~no_s & ~no_t & (s == t), "KEY_VERIFIED", "primary key intact", shown[0], shown[1], member=shown[0], **at),
    ])


def with_fk_signature(refs: DataFrame) -> DataFrame:
    """refs (pair_id, ord, name, parent_table, child_table, joins)."""
    return refs.withColumn("signature", fk_signature(F.col("parent_table"), F.col("child_table"), F.col("joins")))


def compare_foreign_keys(s: DataFrame, t: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reference records, findings): one object at a time, not one signature at a time."""
    key = ["pair_id", "signature"]
    cols = [*key, "ord", "name", "parent_table", "child_table"]
    # Written once: numbered from there, and counted by two of the columns.
    s, t = (stored(df.select(*cols), "references") for df in (s, t))
    records = m.match_multiset(s, t, key, ["ord"], ["ord"], written=True)
    status = F.col("status")
    ends = F.concat(F.coalesce("s_parent_table", "t_parent_table"), F.lit("→"), F.coalesce("s_child_table", "t_child_table"))
    at = dict(object_type="FOREIGN_KEY", object_name=ends, member=F.coalesce("s_name", "t_name"))
    found = emit(records, PAIR, [
        check(status == "MATCHED", "REFERENCE_VERIFIED", "reference intact", F.col("signature"), F.col("signature"), **at),
        check(status == "MISSING", "FOREIGN_KEY_MISSING", "reference only in source", F.col("signature"), ABSENT, **at),
        check(status == "EXTRA", "FOREIGN_KEY_EXTRA", "reference only in target", ABSENT, F.col("signature"), **at),
    ])
    counts = m.multiset_counts(s, t, key).where("n_s > 1")
    repeated = emit(counts, PAIR, [
        check(F.lit(True), "FOREIGN_KEY_DUPLICATE", F.concat(F.col("n_s").cast("string"), F.lit(" references share one signature")),
              F.col("signature"), F.col("n_t").cast("string"), object_type="FOREIGN_KEY", object_name=F.col("signature"))])
    return records, found.unionByName(repeated)


def compare_indexes(s: DataFrame, t: DataFrame, tier: Tier) -> DataFrame:
    """Indexes and non-primary keys of matched tables by their signature.

    Rows (pair_id, table, ord, name, is_unique, members, mirror, is_pk). A source
    index that mirrors a key is accounted for, not compared.
    """
    def signed(df):
        return df.where("not is_pk").withColumn("signature", index_signature(F.col("is_unique"), F.col("members")))

    left, right = signed(s), signed(t)
    at = dict(object_type="INDEX", object_name=F.col("table"))
    mirrored = F.coalesce("mirror", F.lit(False))
    cols = [*TABLE, "signature", "ord", "name"]
    kept = left.where(~mirrored) if tier.skip_mirror_indexes else left
    both = m.match_by_signature(kept.select(*cols), right.select(*cols), TABLE)
    status, sig = F.col("status"), F.col("signature")
    found = emit(both, PAIR, [
        check(status == "MATCHED", "INDEX_VERIFIED", "index intact", sig, sig, member=F.col("s_name"), **at),
        check(status == "MISSING", "INDEX_MISSING", "index only in source", sig, ABSENT, **at),
        check(status == "EXTRA", "INDEX_EXTRA", "index only in target", ABSENT, sig, **at),
    ])
    if not tier.skip_mirror_indexes:
        return found
    return found.unionByName(emit(left.where(mirrored), PAIR, [
        check(F.lit(True), "INDEX_MIRROR", "mirrors a key", sig, "(carried by the key)", member=text("name"), **at)]))


def physical_counters(
    tables: DataFrame, columns: DataFrame, s_tables: DataFrame, t_tables: DataFrame, s_columns: DataFrame, t_columns: DataFrame, references: DataFrame,
    s_references: DataFrame | None = None, t_references: DataFrame | None = None,
) -> DataFrame:
    """Counts per pair; every total is counted on its own, so the identities mean something.

    ``s_references`` and ``t_references`` are the rows that ``references`` pairs up; without them the totals of references
    can only be those of the records.
    """
    def parts(records, kind, wanted):
        status = F.col("status")
        return records.groupBy("pair_id").agg(
            *[m.count_when(status == label).alias(f"{kind}_{name}") for label, name in wanted])

    wanted = [("MATCHED", "matched"), ("MISSING", "missing"), ("EXTRA", "extra")]

    def totals(df, key, kind, side):
        return df.groupBy(*key).count().groupBy("pair_id").agg(
            F.sum("count").alias(f"{kind}_{side}"), F.sum(F.col("count") - 1).alias(f"{kind}_duplicate_{side}"))

    def objects(df, status, kind, side):
        rows = references.where(F.col("status").isin("MATCHED", status)) if df is None else df
        return rows.groupBy("pair_id").agg(F.count("*").alias(f"{kind}_{side}"))

    key = [*TABLE, "column"]
    pairs = s_tables.select("pair_id").union(t_tables.select("pair_id")).distinct()
    parts_list = [
        totals(s_tables, TABLE, "tables", "s"), totals(t_tables, TABLE, "tables", "t"), parts(tables, "tables", wanted),
        totals(s_columns, key, "columns", "s"), totals(t_columns, key, "columns", "t"), parts(columns, "columns", wanted),
        parts(references, "fks", wanted), objects(s_references, "MISSING", "fks", "s"), objects(t_references, "EXTRA", "fks", "t"),
    ]
    from .scoring import join_counts

    return join_counts(pairs, parts_list)
