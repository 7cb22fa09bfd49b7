"""The whole semantic comparison of a fleet of model pairs, as one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Tier
from ..functions import cardinality as card
from ..functions.text import normalize_name, object_label
from ..operators import matching as m
from ..operators.shaping import drop_tool_objects
from ..session import cut, stored
from . import physical as ph
from . import scoring
from . import semantic as sem
from .findings import apply_severity, with_remedy

SCOPE = ["pair_id"]


def _rest(match: m.Match, s: DataFrame, t: DataFrame, scope: list[str]) -> tuple[DataFrame, DataFrame]:
    return (
        match.s_only.withColumnRenamed("s_id", "id").join(s, [*scope, "id"]),
        match.t_only.withColumnRenamed("t_id", "id").join(t, [*scope, "id"]),
    )


def compare_models(s: dict[str, DataFrame], t: dict[str, DataFrame], tier: Tier) -> dict[str, DataFrame]:
    """Findings, object records and results of all pairs.

    Each side holds entities and attributes, and optionally identifiers (with
    members), relationships, inheritances with children, domains, business_rules,
    shortcuts and areas (subject areas in use). Pairs that cannot be compared are routed away
    first and become ERROR; the only barrier after that is the entity match,
    whose alias all other comparisons read.
    """
    keys = m.name_code_keys(tier.match_key, tier.plurals, tier.case_insensitive)
    every = s["entities"].select("pair_id", F.lit("S").alias("side")).unionByName(
        t["entities"].select("pair_id", F.lit("T").alias("side")))
    # A document that cannot be read makes its pair an ERROR, also where nothing of it was read.
    models = every.select("pair_id", "side", F.lit(None).cast("string").alias("parse_error")).distinct()
    for side, label in ((s, "S"), (t, "T")):
        if "documents" in side:
            models = models.unionByName(side["documents"].select("pair_id", F.lit(label).alias("side"), "parse_error"))
    guarded = cut(sem.guard_pairs(models, every))
    good = guarded.where("error is null").select("pair_id")

    def usable(df):
        return df.join(good, SCOPE, "left_semi")

    s_ent, t_ent = usable(s["entities"]), usable(t["entities"])
    found = m.match_ladder(s_ent, t_ent, SCOPE, keys)
    # Pairs are written before they are compared: checks fused with the joins make methods too large to be compiled.
    pairs = stored(m.attach(found, s_ent, t_ent, SCOPE), "pairs")
    s_only, t_only = _rest(found, s_ent, t_ent, SCOPE)
    alias = cut(m.alias_of(pairs, SCOPE))
    areas = None
    if "areas" in s and "areas" in t:
        areas = s["areas"].select("pair_id").intersect(t["areas"].select("pair_id"))
    findings = [sem.guard_findings(guarded), sem.compare_entities(pairs, s_only, t_only, tier, areas)]
    records = [_records(found, "entities")]

    if tier.attributes:
        # Attributes meet inside matched entities; both sides carry the S entity.
        link = found.pairs.select("pair_id", F.col("s_id").alias("entity"), F.col("t_id").alias("_t"))
        scope = ["pair_id", "entity"]
        s_att = s["attributes"].join(link.select(*scope), scope, "left_semi")
        t_all = sem.drop_ignored_migrated(t["attributes"], tier).withColumnRenamed("entity", "_t")
        t_att = t_all.join(link, ["pair_id", "_t"]).drop("_t")
        inner = m.match_ladder(s_att, t_att, scope, keys)
        a_pairs = stored(m.attach(inner, s_att, t_att, scope), "pairs")
        a_s, a_t = _rest(inner, s_att, t_att, scope)
        findings += [
            sem.compare_attributes(a_pairs, tier, object_name=F.col("entity").cast("string")),
            sem.attribute_presence(a_s, a_t, tier, object_name=F.col("entity").cast("string"))]
        records.append(_records(inner, "attributes"))
        # The score counts all attributes of the source, those of missing entities as well.
        records.append(usable(s["attributes"]).groupBy("pair_id").agg(F.count("*").alias("attributes_all_s")))
    if "identifiers" in s:
        own_keys = usable(s["identifiers"])
        records.append(own_keys.groupBy("pair_id").agg(F.count("*").alias("identifiers_s")))
        findings += _compare_keys(found, pairs, own_keys, t, s.get("children"), tier)
    if tier.relationships and "relationships" in s:
        s_rel = card.with_signatures(m.rewrite_endpoints(usable(s["relationships"]), SCOPE, alias))
        t_rel = card.with_signatures(usable(t["relationships"]))
        rels = m.match_ladder(s_rel, t_rel, SCOPE, m.relationship_keys())
        findings.append(sem.compare_relationships(m.attach(rels, s_rel, t_rel, SCOPE), *_rest(rels, s_rel, t_rel, SCOPE), tier))
        records.append(_records(rels, "relationships"))
    if tier.inheritance and "inheritances" in s:
        s_tree = m.rewrite_column(usable(s["inheritances"]), SCOPE, F.col("parent"), alias, "parent")
        s_kids = m.rewrite_column(usable(s["children"]), SCOPE, F.col("child"), alias, "child")
        t_tree = usable(t["inheritances"])
        trees = m.match_ladder(s_tree, t_tree, SCOPE, m.hierarchy_keys())
        census = sem.hierarchy_census(m.attach(trees, s_tree, t_tree, SCOPE), s_kids, usable(t["children"]))
        findings.append(sem.compare_hierarchies(census, *_rest(trees, s_tree, t_tree, SCOPE), tier))
        records.append(_records(trees, "inheritances"))
    if tier.model_quality and "relationships" in t:
        ends = usable(t["relationships"]).select("pair_id", F.explode(F.array("end1.entity", "end2.entity")).alias("entity"))
        if "inheritances" in t:
            ends = ends.unionByName(usable(t["inheritances"]).select("pair_id", F.col("parent").alias("entity"))).unionByName(
                usable(t["children"]).select("pair_id", F.col("child").alias("entity")))
        findings.append(sem.check_quality(t_ent, ends, s_ent))
    if tier.shortcuts and "shortcuts" in s:
        findings.append(sem.list_external_references(usable(s["shortcuts"])))
    for name, ladder, compare in (
        ("domains", m.domain_keys(), lambda p, a, b: sem.compare_domains(p, a, b, tier)),
        ("business_rules", m.rule_keys(), sem.compare_business_rules),
    ):
        if name in s and getattr(tier, name):
            a, b = usable(s[name]), usable(t[name])
            got = m.match_ladder(a, b, SCOPE, ladder)
            findings.append(compare(m.attach(got, a, b, SCOPE), *_rest(got, a, b, SCOPE)))

    rows = findings[0]
    for f in findings[1:]:
        rows = rows.unionByName(f)
    rows = cut(with_remedy(apply_severity(rows, tier)))
    counters = scoring.join_counts(models, [*records, scoring.severity_counts(rows)])
    counters = counters.join(guarded.select("pair_id", F.col("error").isNotNull().alias("_error")), SCOPE, "left")
    objects = F.lit(0)
    kinds = [k for k in ("entities", "attributes", "relationships", "inheritances") if f"{k}_s" in counters.columns]
    for k in ["attributes_all" if k == "attributes" else k for k in kinds] + ["identifiers"]:
        if f"{k}_s" in counters.columns:
            objects = objects + F.col(f"{k}_s")
    scored = scoring.fidelity_score(counters, tier, objects, F.col("_error")).drop("_error")
    results = scoring.gate(scoring.count_identities(scored, kinds), tier.promotion_target, strict=False)
    return {"findings": rows, "results": results, "alias": alias, "guard": guarded}


def _compare_keys(found: m.Match, pairs: DataFrame, s_keys: DataFrame, t: dict[str, DataFrame], children: DataFrame | None, tier: Tier) -> list[DataFrame]:
    """Primary and alternate identifiers of matched entities."""
    link = found.pairs.select("pair_id", F.col("s_id").alias("entity"), F.col("t_id").alias("_t"))
    t_keys = t["identifiers"].withColumnRenamed("entity", "_t").join(link, ["pair_id", "_t"]).drop("_t")
    scope = ["pair_id", "entity"]

    def primary(keys, side):
        comment = F.col("comment") if "comment" in keys.columns else F.lit("")
        best = keys.where("is_primary").withColumn("_c", comment).groupBy(*scope).agg(F.min_by(F.struct("name", "members", "_c"), "ord").alias("_k"))
        return best.select(*scope, F.col("_k.name").alias(f"{side}_key_name"), F.col("_k.members").alias(f"{side}_members"), F.col("_k._c").alias(f"{side}_comment"))

    moved = t["attributes"].where("is_migrated").withColumnRenamed("entity", "_t").join(link, ["pair_id", "_t"]).groupBy(*scope).agg(
        F.collect_set("code").alias("t_migrated"), F.collect_set(F.array("code", "name")).alias("t_aliases"))
    label = pairs.select(
        "pair_id", F.col("s_id").alias("entity"), object_label("s_name", "s_code").alias("object_name"),
        normalize_name(F.coalesce(F.nullif("s_code", F.lit("")), "s_name")).alias("_key"),
        (F.col("s_is_associative") | F.col("t_is_associative")).alias("is_associative") if "s_is_associative" in pairs.columns else F.lit(False).alias("is_associative"))
    df = label.join(primary(s_keys, "s"), scope, "left").join(primary(t_keys, "t"), scope, "left").join(moved, scope, "left")
    if children is None:
        df = df.withColumn("is_subtype", F.lit(False))
    else:
        subtypes = children.select("pair_id", normalize_name("child").alias("_key")).distinct().withColumn("_sub", F.lit(True))
        df = df.join(subtypes, ["pair_id", "_key"], "left").withColumn("is_subtype", F.coalesce("_sub", F.lit(False)))
    df = df.withColumn("t_migrated", F.coalesce("t_migrated", F.array().cast("array<string>"))).withColumn(
        "t_aliases", F.coalesce("t_aliases", F.array().cast("array<array<string>>")))
    out = []
    if tier.primary_identifiers:
        out.append(sem.compare_primary_key(df, tier))
    if tier.alternate_identifiers:
        inside = s_keys.where("not is_primary").join(link.select(*scope), scope, "left_semi")
        other = t_keys.where("not is_primary")
        if "key_group" in other.columns:
            out += [sem.list_inversion_entries(_inversions(other))] if tier.inversion_entries else []
            other = drop_tool_objects(other, key_group="key_group")
        cols = [*scope, "ord", "name", "members"]
        out.append(sem.compare_alternate_keys(inside.select(*cols), other.select(*cols), scope).drop("entity"))
    return out


def _inversions(keys: DataFrame) -> DataFrame:
    made = ~F.coalesce(F.col("key_group"), F.lit("")).isin("PK", "AK")
    return keys.withColumn("is_inversion_entry", made).withColumnRenamed("entity", "entity_key")


def _records(found: m.Match, kind: str) -> DataFrame:
    rows = (
        found.pairs.select("pair_id", F.lit("MATCHED").alias("status"))
        .unionByName(found.s_only.select("pair_id", F.lit("MISSING").alias("status")))
        .unionByName(found.t_only.select("pair_id", F.lit("EXTRA").alias("status"))))
    return scoring.count_by_status(rows, kind)


def compare_physical_models(s: dict[str, DataFrame], t: dict[str, DataFrame], tier: Tier) -> dict[str, DataFrame]:
    """Findings and results of all physical pairs: tables, columns, keys, references, indexes.

    Columns, keys and indexes are compared inside tables both sides hold; the
    columns of a missing table count as missing without a finding each.
    """
    table = ["pair_id", "table"]
    tables, findings = ph.compare_tables(s["tables"], t["tables"], tier)
    tables = cut(tables)
    common = tables.where("status = 'MATCHED'").select(*table)
    columns = cut(ph.column_records(s["columns"], t["columns"]))

    def shared(df):
        return df.join(common, table, "left_semi")

    parts = [findings]
    if tier.columns:
        parts.append(ph.compare_columns(shared(columns), tier))
        parts.append(ph.compare_duplicate_columns(shared(s["columns"]), shared(t["columns"])))
    if tier.primary_keys:

        def primary(side, name):
            first = side["keys"].where("is_pk").groupBy(*table).agg(F.min_by("members", "ord").alias(name))
            return first

        keys = common.join(primary(s, "s_members"), table, "left").join(primary(t, "t_members"), table, "left")
        parts.append(ph.compare_physical_pk(keys))
    if tier.indexes:
        own, other = (shared(x["indexes"].unionByName(x["keys"])) for x in (s, t))
        parts.append(ph.compare_indexes(own, other, tier))
    s_refs, t_refs = (ph.with_fk_signature(x["references"]) for x in (s, t))
    references, fk_findings = ph.compare_foreign_keys(s_refs, t_refs)
    if tier.foreign_keys:
        parts.append(fk_findings)
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = cut(with_remedy(apply_severity(rows, tier)))
    counters = ph.physical_counters(tables, columns, s["tables"], t["tables"], s["columns"], t["columns"], references, s_refs, t_refs)
    counters = counters.join(scoring.severity_counts(rows), SCOPE, "left").fillna(0)
    objects = F.col("tables_s") + F.col("columns_s") + F.col("fks_s")
    scored = scoring.count_identities(scoring.fidelity_score(counters, tier, objects), ["tables", "columns", "fks"])
    return {"findings": rows, "results": scoring.gate(scored, tier.promotion_target)}
