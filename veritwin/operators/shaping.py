"""Operators that make relations comparable: references, keys, duplicates, inheritance of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_name, text, trim_ws
from .matching import count_when
from .ordered import keep_one, number_within


def resolve_refs(df: DataFrame, scope: Sequence[str], ref: str, dim: DataFrame, out: str, fallback: str = "UNKNOWN") -> DataFrame:
    """Internal id -> code. An unresolved id stays as it is, a blank one becomes ``fallback``.

    ``dim`` (scope…, oid, code) has one row per id.
    """
    looked = dim.select(*scope, F.col("oid").cast("string").alias("_ref"), F.col("code").alias("_code"))
    joined = df.withColumn("_ref", trim_ws(ref)).join(looked, [*scope, "_ref"], "left")
    resolved = F.coalesce("_code", F.nullif(F.col("_ref"), F.lit("")), F.lit(fallback))
    return joined.withColumn(out, resolved).drop("_ref", "_code")


def inherit_scalar(df: DataFrame, domains: DataFrame, scope: Sequence[str], link: str, items: DataFrame | None = None, item_link: str | None = None) -> DataFrame:
    """Fill data_type, length, precision from the linked domain, then the data item.

    Length and precision are borrowed only together with the type.
    """
    out = df
    sources = [(domains, link)] + ([(items, item_link)] if items is not None else [])
    for source, key in sources:
        dim = source.select(
            *scope, F.col("oid").alias(key), *[F.col(c).alias(f"_{c}") for c in ("data_type", "length", "precision")])
        joined = out.join(dim, [*scope, key], "left")
        borrow = (text("data_type") == "") & (text("_data_type") != "")
        for c in ("length", "precision"):
            joined = joined.withColumn(f"_{c}", F.when(borrow & (text(c) == ""), text(f"_{c}")).otherwise(text(c)))
        joined = joined.withColumn("data_type", F.when(borrow, text("_data_type")).otherwise(text("data_type")))
        joined = joined.drop("length", "precision", "_data_type")
        out = joined.withColumnsRenamed({"_length": "length", "_precision": "precision"})
    return out


def mark_primary(identifiers: DataFrame, attributes: DataFrame, pointers: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Which identifier of each entity is primary, and by what evidence.

    ``identifiers`` (scope…, oid, ord, members), ``attributes`` (scope…, code,
    is_primary), ``pointers`` (scope…, primary_oid); scope ends in the entity.
    Without a valid pointer the first identifier whose members are exactly the
    flagged attributes is primary.
    """
    scope = list(scope)
    flags = attributes.where("is_primary").select(*scope, F.upper("code").alias("_code")).distinct()
    members = identifiers.select(*scope, "oid", F.explode("members").alias("_m")).select(*scope, "oid", F.upper("_m").alias("_code")).distinct()
    hits = members.join(flags.withColumn("_hit", F.lit(1)), [*scope, "_code"], "left").groupBy(*scope, "oid").agg(
        F.count("*").alias("_members"), F.count("_hit").alias("_hits"))
    joined = identifiers.join(pointers, scope, "left").join(hits, [*scope, "oid"], "left").join(
        flags.groupBy(*scope).agg(F.count("*").alias("_flagged")), scope, "left")
    same = (F.col("_hits") == F.col("_members")) & (F.col("_hits") == F.col("_flagged"))
    rated = joined.withColumn("_evidence", F.when(F.col("oid") == F.col("primary_oid"), 1).when(same, 2))
    best = rated.where("_evidence is not null").groupBy(*scope).agg(
        F.min(F.struct("_evidence", "ord", "oid")).alias("_best"))
    chosen = rated.join(best, scope, "left")
    primary = F.coalesce(F.col("oid") == F.col("_best.oid"), F.lit(False))
    how = F.when(primary & (F.col("_evidence") == 1), "POINTER").when(primary, "FLAGS")
    return chosen.withColumn("is_primary", primary).withColumn("evidence", how).drop(
        "_members", "_hits", "_flagged", "_evidence", "_best", "primary_oid")


def derive_identifying(rel: DataFrame, keys: DataFrame, scope: Sequence[str]) -> DataFrame:
    """A relationship is identifying when the child's key shares a member with the parent's.

    ``rel`` (scope…, parent, child, …), ``keys`` (scope…, entity, members).
    """
    scope = list(scope)

    def of(side):
        return keys.select(*scope, F.col("entity").alias(side), F.col("members").alias(f"_{side}"))

    joined = rel.join(of("parent"), [*scope, "parent"], "left").join(of("child"), [*scope, "child"], "left")
    upper = [F.transform(f"_{s}", lambda x: F.upper(x)) for s in ("parent", "child")]
    shared = F.coalesce(F.arrays_overlap(*upper), F.lit(False))
    return joined.withColumn("identifying", shared).drop("_parent", "_child")


def subtype_trees(rel: DataFrame, scope: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """SUBTYPE relationships -> (trees, children).

    One tree per parent; a child counts once, at its first position. The
    children stay rows, so a parent of any size spreads over tasks.
    """
    scope = list(scope)
    sub = rel.where("type = 'SUBTYPE'")
    children = sub.groupBy(*scope, "parent", "child").agg(F.min("ord").alias("ord"))
    trees = children.groupBy(*scope, "parent").agg(F.count("*").alias("children"), F.min("ord").alias("ord"))
    return trees, children


def drop_hidden_duplicates(attributes: DataFrame) -> DataFrame:
    """Attributes to compare: not hidden, and their own lead (or no lead at all)."""
    lead = trim_ws("lead_ref")
    return attributes.where(~F.coalesce("hidden", F.lit(False)) & ((lead == "") | (lead == F.col("oid").cast("string"))))


# Fixed value: key group types the target tool makes for its own use.
TOOL_KEY_GROUPS = r"(?i)^(?:IF\d*|IE|INVERSION ENTRY|INDEX)$"


def drop_tool_objects(df: DataFrame, built_in: str | None = None, key_group: str | None = None) -> DataFrame:
    """Leave out built-in objects and key groups the tool made."""
    keep = F.lit(True)
    if built_in:
        keep = keep & trim_ws(built_in).isin("", "0")
    if key_group:
        keep = keep & ~trim_ws(key_group).rlike(TOOL_KEY_GROUPS)
    return df.where(keep)


# Spellings of true.
TRUE_TOKENS = ("1", "true", "yes", "y", "t", "on")


def is_migrated_key(flags: Sequence[str], key_type: str | None = None, parent_ref: str | None = None) -> Column:
    """Evidence that the tool moved an attribute in: a flag, its type, or a parent reference."""
    hit = F.lit(False)
    for flag in flags:
        hit = hit | F.lower(trim_ws(flag)).isin(*TRUE_TOKENS)
    if key_type:
        hit = hit | F.upper(trim_ws(key_type)).isin("FK", "FOREIGN KEY")
    if parent_ref:
        hit = hit | (trim_ws(parent_ref) != "")
    return hit


def unique_object_keys(df: DataFrame, scope: Sequence[str], code: str, order: Sequence[str], out: str = "object_key") -> DataFrame:
    """CODE, CODE#2, CODE#3 …: a key per object however often its code repeats."""
    keyed = df.withColumn("_key", F.upper(trim_ws(code)))
    numbered = number_within(keyed, [*scope, "_key"], list(order), "_n")
    suffix = F.when(F.col("_n") > 1, F.concat(F.lit("#"), F.col("_n").cast("string"))).otherwise("")
    return numbered.withColumn(out, F.concat("_key", suffix)).drop("_key", "_n")


def collision_warnings(df: DataFrame, scope: Sequence[str], code: str) -> DataFrame:
    """One row per repeated code: how many objects carry it."""
    key = F.upper(trim_ws(code)).alias("code")
    return df.groupBy(*scope, key).agg(F.count("*").alias("objects")).where("objects > 1")


def dedupe_objects(df: DataFrame, key: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One object per key: the first or the last in ``order``."""
    how = [F.asc(c) if keep == "first" else F.desc(c) for c in order]
    return keep_one(df, list(key), how)


def duplicate_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("objects")).where("objects > 1")


def physical_fk_joins(explicit: DataFrame, migrated: DataFrame, key: Sequence[str]) -> DataFrame:
    """Join columns of references: the explicit list, else the migrated attributes.

    Both carry (key…, ord, parent_col, child_col); a reference with explicit
    rows does not look at its migrated ones.
    """
    rest = migrated.join(explicit.select(*key).distinct(), list(key), "left_anti")
    return explicit.withColumn("evidence", F.lit("EXPLICIT")).unionByName(
        rest.withColumn("evidence", F.lit("MIGRATED")))


def key_census(df: DataFrame, scope: Sequence[str], keys: dict[str, Column]) -> DataFrame:
    """Per scope and match key: rows, blanks, distinct keys, and rows whose key is shared."""
    scope = list(scope)
    long = df.select(
        *scope, F.explode(F.array(*[F.struct(F.lit(n).alias("basis"), k.alias("key")) for n, k in keys.items()])).alias("k")
    ).select(*scope, "k.*")
    per_key = long.groupBy(*scope, "basis", "key").agg(F.count("*").alias("n"))
    filled = F.col("key") != ""
    return per_key.groupBy(*scope, "basis").agg(
        F.sum("n").alias("objects"),
        F.sum(F.when(~filled, F.col("n")).otherwise(0)).alias("blank"),
        count_when(filled).alias("distinct_keys"),
        count_when(filled & (F.col("n") > 1)).alias("ambiguous_keys"),
        F.sum(F.when(filled & (F.col("n") > 1), F.col("n")).otherwise(0)).alias("ambiguous_objects"),
    )


def type_census(df: DataFrame, type_col: str, scope: Sequence[str] = ()) -> DataFrame:
    """Raw spelling, canonical type, family, known or not, and how often."""
    from ..functions import types as ty

    counts = df.groupBy(*scope, F.col(type_col).alias("spelling")).agg(F.count("*").alias("objects"))
    base = ty.split_type("spelling")["base"]
    known = ty.lookup(ty.CANONICAL, base).isNotNull() | base.isin(*ty.NO_TYPE)
    return counts.withColumns(
        {"canonical": ty.canonical_type("spelling"), "family": ty.type_family("spelling"), "known": known}
    )


def exclude(df: DataFrame, patterns: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Drop rows whose name or code matches an exclusion pattern."""
    from ..functions.text import any_pattern

    return df.where(~any_pattern(patterns, *cols)) if patterns else df


def with_name_keys(df: DataFrame, plurals: bool = True) -> DataFrame:
    return df.withColumns({"norm_name": normalize_name("name", plurals), "norm_code": normalize_name("code", plurals)})
