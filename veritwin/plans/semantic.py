"""Comparison of logical and conceptual models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Tier
from ..functions import cardinality as card
from ..functions import types as ty
from ..functions.similarity import distance_within, similarity_of_normalized
from ..functions.text import (
    ABSENT, documented_members, is_blank, names_equivalent, normalize_definition, normalize_name,
    object_label, text, trim_ws,
)
from ..operators import matching as m
from .findings import check, emit, or_none

PAIR = ["pair_id"]


def _given(a: str, b: str) -> Column:
    return F.when(text(a) != "", text(a)).otherwise(text(b))


# --- guards ---------------------------------------------------------------------------


def guard_pairs(models: DataFrame, entities: DataFrame) -> DataFrame:
    """One row per pair: why it cannot be compared, or NULL.

    A side that failed to parse or holds no entity makes the pair an ERROR
    instead of one missing finding per object. ``models`` (pair_id, side,
    parse_error), ``entities`` (pair_id, side).
    """
    counts = entities.groupBy("pair_id").agg(
        m.count_when(F.col("side") == "S").alias("entities_s"),
        m.count_when(F.col("side") == "T").alias("entities_t"),
    )
    faults = models.groupBy("pair_id").agg(
        F.max(F.when(F.col("side") == "S", F.col("parse_error"))).alias("_s"),
        F.max(F.when(F.col("side") == "T", F.col("parse_error"))).alias("_t"),
    )
    joined = faults.join(counts, "pair_id", "left").fillna(0, subset=["entities_s", "entities_t"])
    no_s, no_t = F.col("entities_s") == 0, F.col("entities_t") == 0
    reason = (
        F.when(F.col("_s").isNotNull(), F.concat(F.lit("source parse error: "), F.col("_s")))
        .when(F.col("_t").isNotNull(), F.concat(F.lit("target parse error: "), F.col("_t")))
        .when(no_s & no_t, "neither side holds an entity")
        .when(no_t, "the target holds no entity")
        .when(no_s, "the source holds no entity")
    )
    return joined.select("pair_id", "entities_s", "entities_t", reason.alias("error"))


def guard_findings(guarded: DataFrame, warnings: DataFrame | None = None) -> DataFrame:
    """PARSE_ERROR for pairs that cannot be compared, PARSE_WARNING for the others' warnings."""
    sizes = [F.concat(F.col(f"entities_{s}").cast("string"), F.lit(" entities")) for s in ("s", "t")]
    out = emit(
        guarded, PAIR,
        [check(F.col("error").isNotNull(), "PARSE_ERROR", F.col("error"), sizes[0], sizes[1],
               object_type="MODEL", object_name=F.lit("(model)"), severity="CRITICAL")],
    )
    if warnings is None:
        return out
    comparable = warnings.join(guarded.where("error is null"), PAIR, "left_semi")
    noted = emit(
        comparable, PAIR,
        [check(F.lit(True), "PARSE_WARNING", F.col("warning"), "", "", object_type="MODEL",
               object_name=F.lit("(model)"))],
    )
    return out.unionByName(noted)


# --- definitions ----------------------------------------------------------------------


def with_similarity(df: DataFrame, s_text: str, t_text: str, tier: Tier, out: str = "similarity") -> DataFrame:
    """Normalise both texts, then measure once; the number serves check and message.

    The edit distance is first sought within the band that the threshold allows, which costs the length times the band;
    only texts that differ by more, which are reported, are measured in full.
    """
    df = df.withColumn("_sn", normalize_definition(s_text)).withColumn("_tn", normalize_definition(t_text))
    if tier.similarity_method == "levenshtein":
        df = df.withColumn("_d", distance_within("_sn", "_tn", tier.similarity_threshold))
        measured = similarity_of_normalized(F.col("_sn"), F.col("_tn"), distance=F.col("_d"))
    else:
        measured = similarity_of_normalized(F.col("_sn"), F.col("_tn"), tier.similarity_method)
    return df.withColumn(out, measured).drop("_sn", "_tn", "_d")


def definition_checks(tier: Tier, object_type: str, object_name: Column, member: Column, s="s_definition", t="t_definition") -> list[Column]:
    """Checks over a row that already has ``similarity``."""
    no_s, no_t = is_blank(s), is_blank(t)
    at = dict(object_type=object_type, object_name=object_name, member=member)
    percent = F.round(F.col("similarity") * 100, 0).cast("int").cast("string")
    lost = F.lit(tier.definition_loss) & ~no_s & no_t
    new = F.lit(tier.definition_loss) & no_s & ~no_t
    differs = ~lost & ~new & ~(no_s & no_t) & (F.col("similarity") < tier.similarity_threshold)
    return [
        check(lost, "DEFINITION_LOSS", "definition lost", text(s), ABSENT, **at),
        check(new, "DEFINITION", "definition only in target", ABSENT, text(t), **at),
        check(differs, "DEFINITION", F.concat(F.lit("definition differs, similarity "), percent, F.lit("%")),
              text(s), text(t), **at),
    ]


def compare_definition(pairs: DataFrame, tier: Tier, keep: Sequence[str] = ("pair_id",), object_type="ENTITY", object_name: Column | None = None, s="s_text", t="t_text") -> DataFrame:
    name = F.col("id").cast("string") if object_name is None else object_name
    measured = with_similarity(pairs, s, t, tier)
    return emit(measured, list(keep), definition_checks(tier, object_type, name, F.lit(""), s, t))


# --- attributes -----------------------------------------------------------------------


def compare_attributes(pairs: DataFrame, tier: Tier, keep: Sequence[str] = ("pair_id",), object_name: Column | None = None, object_type: str = "ATTRIBUTE") -> DataFrame:
    """Findings of matched attribute pairs (s_*, t_*, basis)."""
    label = _given("s_code", "s_name")
    at = dict(object_type=object_type, object_name=F.lit("") if object_name is None else object_name, member=label)
    df = ty.with_type_parts(pairs, "s_data_type", "_s_", "s_length", "s_precision")
    df = ty.with_type_parts(df, "t_data_type", "_t_", "t_length", "t_precision")
    df = df.withColumn("_type_ok", ty.types_match("_s_", "_t_", tier.type_mode, tier.approved_matrix))
    checks = []
    if tier.report_fallback:
        checks.append(
            check(F.col("basis") != "code", "FALLBACK_MATCH",
                  F.concat(F.lit("matched on "), F.col("basis"), F.lit(", not on code")),
                  F.concat(text("s_name"), F.lit(" / "), text("s_code")),
                  F.concat(text("t_name"), F.lit(" / "), text("t_code")), **at))
    if tier.business_names:
        checks.append(
            check(~names_equivalent("s_name", "t_name", tier.plurals), "BUSINESS_NAME", "business name differs",
                  or_none(F.col("s_name")), or_none(F.col("t_name")), **at))
    if tier.data_types:
        checks.append(
            check(~F.col("_type_ok"), "DATA_TYPE", "data type differs",
                  ty.describe_type("_s_"), ty.describe_type("_t_"), **at))
    if tier.length_precision:
        wrong = ~ty.dimensions_match("_s_", "_t_")
        if tier.length_only_if_type_agrees:
            wrong = wrong & F.col("_type_ok")

        def dims(p):
            return F.concat(
                F.lit("len="), or_none(F.col(f"{p}length"), "-"), F.lit(", prec="), or_none(F.col(f"{p}precision"), "-"))

        checks.append(check(wrong, "LENGTH_PRECISION", "length or precision differs", dims("_s_"), dims("_t_"), **at))
    if tier.mandatory:

        def flag(c):
            return F.when(F.col(c), "Mandatory").otherwise("Optional")

        checks.append(
            check(F.coalesce("s_mandatory", F.lit(False)) != F.coalesce("t_mandatory", F.lit(False)), "MANDATORY",
                  "mandatory flag differs", flag("s_mandatory"), flag("t_mandatory"), **at))
    if tier.domains:
        checks.append(
            check((~is_blank("s_domain") | ~is_blank("t_domain")) & ~names_equivalent("s_domain", "t_domain", tier.plurals),
                  "DOMAIN", "domain differs", or_none(trim_ws("s_domain"), "(no domain)"),
                  or_none(trim_ws("t_domain"), "(no domain)"), **at))
    if tier.definitions:
        df = with_similarity(df, "s_definition", "t_definition", tier)
        checks += definition_checks(tier, at["object_type"], at["object_name"], label)
    if tier.attribute_order:
        checks.append(
            check(F.col("s_ord") != F.col("t_ord"), "ATTRIBUTE_ORDER", "declaration order differs",
                  F.col("s_ord").cast("string"), F.col("t_ord").cast("string"), **at))
    return emit(df, list(keep), checks)


def attribute_presence(s_only: DataFrame, t_only: DataFrame, tier: Tier, keep: Sequence[str] = ("pair_id",), object_name: Column | None = None) -> DataFrame:
    """Missing and extra attributes; rows carry the attribute's own columns.

    Migrated keys of the target are reconciled by their relationship when the
    tier says so: they become FALLBACK_MATCH instead of extra.
    """
    name = F.lit("") if object_name is None else object_name
    at = dict(object_type="ATTRIBUTE", object_name=name, member=_given("code", "name"))
    s_only, t_only = (ty.with_type_parts(d, "data_type", "_p_", "length", "precision") for d in (s_only, t_only))
    typed = ty.describe_type("_p_")
    missing = emit(
        s_only, list(keep), [check(F.lit(True), "ATTRIBUTE_MISSING", "attribute only in source", typed, ABSENT, **at)]
    )
    migrated = F.coalesce("is_migrated", F.lit(False)) & F.lit(tier.migrated_keys in ("info", "relationship"))
    extra = emit(
        t_only, list(keep),
        [
            check(migrated, "FALLBACK_MATCH", "key migrated by a relationship", ABSENT, _given("code", "name"), **at),
            check(~migrated, "ATTRIBUTE_EXTRA", "attribute only in target", ABSENT, typed, **at),
        ],
    )
    return missing.unionByName(extra)


def drop_ignored_migrated(attributes: DataFrame, tier: Tier) -> DataFrame:
    """Target attributes to compare: a tier that ignores migrated keys leaves them out."""
    if tier.migrated_keys != "ignore":
        return attributes
    return attributes.where(~F.coalesce("is_migrated", F.lit(False)))


# --- entities -------------------------------------------------------------------------


def compare_entities(pairs: DataFrame, s_only: DataFrame, t_only: DataFrame, tier: Tier, areas: DataFrame | None = None) -> DataFrame:
    """Entity findings. ``areas`` (pair_id) lists pairs where both models use subject areas."""
    label = object_label("s_name", "s_code")
    at = dict(object_type="ENTITY", object_name=label)
    df, checks = pairs, []
    if tier.report_fallback:
        checks.append(
            check(F.col("basis") != "code", "FALLBACK_MATCH",
                  F.concat(F.lit("matched on "), F.col("basis"), F.lit(", not on code")),
                  F.concat(text("s_name"), F.lit(" / "), text("s_code")),
                  F.concat(text("t_name"), F.lit(" / "), text("t_code")), **at))
    if tier.business_names:
        checks.append(
            check(~names_equivalent("s_name", "t_name", tier.plurals), "BUSINESS_NAME", "business name differs",
                  or_none(F.col("s_name")), or_none(F.col("t_name")), **at))
    if tier.subject_areas and areas is not None:
        df = df.join(areas.select("pair_id").distinct().withColumn("_areas", F.lit(True)), "pair_id", "left")
        stated = ~is_blank("s_subject_area") | ~is_blank("t_subject_area")
        checks.append(
            check(F.coalesce("_areas", F.lit(False)) & stated & ~names_equivalent("s_subject_area", "t_subject_area"),
                  "SUBJECT_AREA", "subject area differs", or_none(trim_ws("s_subject_area")),
                  or_none(trim_ws("t_subject_area")), **at))
    if tier.definitions:
        df = with_similarity(df, "s_definition", "t_definition", tier)
        checks += definition_checks(tier, "ENTITY", label, F.lit(""))
    found = emit(df, PAIR, checks)
    if not tier.entities:
        return found
    own = dict(object_type="ENTITY", object_name=object_label("name", "code"))
    size = F.concat(
        F.col("n_attributes").cast("string"), F.lit(" attributes, "), F.col("n_identifiers").cast("string"),
        F.lit(" identifiers"))
    missing = emit(s_only, PAIR, [check(F.lit(True), "ENTITY_MISSING", "entity only in source", size, ABSENT, **own)])
    extra = emit(t_only, PAIR, [check(F.lit(True), "ENTITY_EXTRA", "entity only in target", ABSENT, size, **own)])
    return found.unionByName(missing).unionByName(extra)


def pairs_with_areas(entities: DataFrame) -> DataFrame:
    """Pairs whose both sides assign at least one subject area; (pair_id, side, subject_area)."""
    used = entities.groupBy("pair_id").agg(
        F.max((F.col("side") == "S") & ~is_blank("subject_area")).alias("_s"),
        F.max((F.col("side") == "T") & ~is_blank("subject_area")).alias("_t"),
    )
    return used.where("_s and _t").select("pair_id")


# --- identifiers ----------------------------------------------------------------------


def _members(name: Column, members: Column) -> Column:
    shown = F.when(text(name) == "", "(unnamed)").otherwise(text(name))
    listed = F.when(F.size(members) == 0, "(no members)").otherwise(F.concat_ws(", ", members))
    return F.when(members.isNull(), "(none)").otherwise(F.concat(shown, F.lit(" → "), listed))


def compare_primary_key(pairs: DataFrame, tier: Tier, keep: Sequence[str] = ("pair_id",)) -> DataFrame:
    """Primary identifiers of matched entities.

    Columns: object_name, s_key_name, s_members, t_key_name, t_members (NULL
    members = no key), t_migrated (codes of migrated attributes), is_subtype,
    is_associative, and with key migration recognised s_comment, t_comment and
    t_aliases (array of arrays: spellings of one attribute).
    """
    at = dict(object_type="IDENTIFIER", object_name=F.col("object_name"))
    df = pairs.withColumn("_diff", m.member_diff(F.col("s_members"), F.col("t_members")))
    lost, added, relation = (F.col("_diff")[f] for f in ("lost", "added", "relation"))
    no_s, no_t = F.col("s_members").isNull(), F.col("t_members").isNull()
    both = ~no_s & ~no_t
    s_text, t_text = (_members(F.col(f"{x}_key_name"), F.col(f"{x}_members")) for x in ("s", "t"))

    migrated = F.transform("t_migrated", lambda x: normalize_name(x))
    upper_migrated = F.transform("t_migrated", lambda x: F.upper(x))
    inherited = (F.size("t_members") > 0) & (
        F.size(F.array_except(F.transform("t_members", lambda x: F.upper(x)), upper_migrated)) == 0
    )
    accounted = inherited & (F.col("is_subtype") | F.col("is_associative"))
    checks = []
    if tier.model_quality:
        checks.append(
            check(no_s & no_t, "MODEL_QUALITY", "no primary identifier on either side", "(none)", "(none)",
                  severity="INFO", **at))
    checks += [
        check(no_s & ~no_t & accounted, "INHERITED_IDENTITY", "identity inherited from the parent", "(inherited)", t_text, **at),
        check(no_s & ~no_t & ~accounted, "PRIMARY_IDENTIFIER", "primary identifier only in target", "(none)", t_text, **at),
        check(~no_s & no_t, "PRIMARY_IDENTIFIER", "primary identifier lost", s_text, "(none)", **at),
    ]
    changed = both & (relation == "COMPOSITION")
    if tier.recognise_key_migration:
        moved = (F.size(lost) == 0) & (F.size(added) > 0) & (F.size(F.array_except(added, migrated)) == 0)
        known = F.array_union(
            F.transform(documented_members("s_comment"), lambda x: normalize_name(x)),
            F.transform(documented_members("t_comment"), lambda x: normalize_name(x)),
        )
        aliases = F.transform("t_aliases", lambda g: F.transform(g, lambda x: normalize_name(x)))
        documented = F.forall(
            added,
            lambda a: F.array_contains(known, a)
            | F.exists(aliases, lambda g: F.array_contains(g, a) & F.arrays_overlap(g, known)),
        )
        checks += [
            check(changed & moved & documented, "IDENTIFIER_UNDERSPECIFIED", "key members documented, not built",
                  s_text, t_text, member=F.col("s_key_name"), **at),
            check(changed & moved & ~documented, "IDENTIFYING_KEY_MIGRATION", "key extended by migrated parent keys",
                  s_text, t_text, member=F.col("s_key_name"), **at),
        ]
        changed = changed & ~moved
    checks += [
        check(changed, "PRIMARY_IDENTIFIER",
              F.concat(F.lit("members differ: lost "), F.concat_ws(",", lost), F.lit("; added "), F.concat_ws(",", added)),
              s_text, t_text, **at),
        check(both & (relation == "ORDER"), "ALTERNATE_IDENTIFIER", "member order differs", s_text, t_text, **at),
        check(both & (relation == "EQUAL"), "IDENTIFIER_VERIFIED", "primary identifier intact", s_text, t_text,
              member=F.col("s_key_name"), **at),
    ]
    return emit(df, list(keep), checks)


def key_signature(members: Column) -> Column:
    return F.concat_ws("|", F.array_sort(F.transform(members, lambda x: normalize_name(x))))


def compare_alternate_keys(s: DataFrame, t: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Alternate identifiers by their sorted members. Rows: scope…, ord, name, members."""
    scope = list(scope)

    def side(df):
        return df.select(*scope, "ord", "name", "members", key_signature(F.col("members")).alias("signature"))

    both = m.match_by_signature(side(s), side(t), scope)
    status = F.col("status")
    at = dict(object_type="IDENTIFIER", object_name=F.lit(""))
    named = [_members(F.col(f"{x}_name"), F.col(f"{x}_members")) for x in ("s", "t")]
    return emit(
        both, scope,
        [
            check(status == "MATCHED", "IDENTIFIER_VERIFIED", "alternate identifier intact", named[0], named[1],
                  member=F.col("s_name"), **at),
            check(status == "MISSING", "ALTERNATE_IDENTIFIER", "alternate identifier only in source", named[0], ABSENT,
                  member=F.col("s_name"), **at),
            check(status == "EXTRA", "ALTERNATE_IDENTIFIER", "alternate identifier only in target", ABSENT, named[1],
                  member=F.col("t_name"), **at),
        ],
    )


def list_inversion_entries(t_identifiers: DataFrame, keep: Sequence[str] = ("pair_id",)) -> DataFrame:
    """Key groups the target tool made for its foreign keys, one INFO row each."""
    return emit(
        t_identifiers.where("is_inversion_entry"), list(keep),
        [check(F.lit(True), "INVERSION_ENTRY", "index made by the tool", ABSENT,
               _members(F.col("name"), F.col("members")), object_type="IDENTIFIER",
               object_name=F.col("entity_key"), member=_given("name", "code"))],
    )


# --- relationships --------------------------------------------------------------------


def with_ends_compared(pairs: DataFrame) -> DataFrame:
    """Matched relationships with their label, alignment and degrees, worked out once."""
    s1, s2, t1, t2 = (F.col(c) for c in ("s_end1", "s_end2", "t_end1", "t_end2"))
    df = pairs.withColumns({
        "label": card.relationship_label(F.col("s_name"), F.col("s_code"), s1, s2),
        "aligned": card.ends_aligned(s1, s2, t1, t2),
        "same_ends": F.col("s_ends_key") == F.col("t_ends_key"),
        "s_degree": card.degree(s1["cardinality"], s2["cardinality"]),
        "_t_degree": card.degree(t1["cardinality"], t2["cardinality"])})
    t_degree = F.when(F.col("aligned"), F.col("_t_degree")).otherwise(card.invert_degree(F.col("_t_degree")))
    return df.withColumn("t_degree", t_degree).drop("_t_degree")


def relationship_census(pairs: DataFrame, s_only: DataFrame, t_only: DataFrame) -> DataFrame:
    """One row per relationship: label, degrees, basis and status."""
    status = (
        F.when(~F.col("same_ends"), "ENDPOINTS_CHANGED")
        .when(F.col("s_degree") != F.col("t_degree"), "CARDINALITY_CHANGED")
        .otherwise("MATCHED")
    )
    columns = ["pair_id", "s_id", "t_id", "label", "basis", "s_degree", "t_degree", "status"]

    def single(df, own, other, label):
        one, two = F.col("end1"), F.col("end2")
        return df.select(
            "pair_id", f"{own}_id", F.lit(None).cast(df.schema[f"{own}_id"].dataType).alias(f"{other}_id"),
            card.relationship_label(F.col("name"), F.col("code"), one, two).alias("label"),
            F.lit("UNMATCHED").alias("basis"),
            card.degree(one["cardinality"], two["cardinality"]).alias(f"{own}_degree"),
            F.lit(None).cast("string").alias(f"{other}_degree"), F.lit(label).alias("status"),
        ).select(*columns)

    return (
        with_ends_compared(pairs).withColumn("status", status).select(*columns)
        .unionByName(single(s_only, "s", "t", "MISSING"))
        .unionByName(single(t_only, "t", "s", "EXTRA"))
    )


def compare_relationships(pairs: DataFrame, s_only: DataFrame, t_only: DataFrame, tier: Tier) -> DataFrame:
    """Findings of matched relationships, their ends, and of those without a partner."""
    at = dict(object_type="RELATIONSHIP", object_name=F.col("label"))
    df = with_ends_compared(pairs).withColumns({
        "_s_text": card.describe_relationship(F.col("s_end1"), F.col("s_end2")),
        "_t_text": card.describe_relationship(F.col("t_end1"), F.col("t_end2"))})
    same, s_text, t_text = F.col("same_ends"), F.col("_s_text"), F.col("_t_text")
    checks = [check(~same, "RELATIONSHIP_MISSING", "connects different entities", s_text, t_text, **at)]
    if tier.cardinality:
        checks.append(
            check(same & (F.col("s_degree") != F.col("t_degree")), "CARDINALITY",
                  F.concat(F.lit("cardinality changed from "), F.col("s_degree"), F.lit(" to "), F.col("t_degree")),
                  s_text, t_text, **at))
    if tier.associations:
        checks.append(
            check(F.col("s_kind") != F.col("t_kind"), "ASSOCIATION", "an association on one side only",
                  F.col("s_kind"), F.col("t_kind"), **at))
    if tier.definitions:
        df = with_similarity(df, "s_definition", "t_definition", tier)
        checks += definition_checks(tier, "RELATIONSHIP", F.col("label"), F.lit(""))
    found = emit(df, PAIR, checks).unionByName(_compare_ends(df.where("same_ends"), tier))
    if not tier.relationships:
        return found

    def single(side, category, message, source):
        one, two = F.col("end1"), F.col("end2")
        own = side.withColumns({
            "_label": card.relationship_label(F.col("name"), F.col("code"), one, two), "_text": card.describe_relationship(one, two)})
        values = (F.col("_text"), ABSENT) if source else (ABSENT, F.col("_text"))
        return emit(own, PAIR, [check(F.lit(True), category, message, *values, object_type="RELATIONSHIP", object_name=F.col("_label"))])

    return found.unionByName(
        single(s_only, "RELATIONSHIP_MISSING", "relationship only in source", True)
    ).unionByName(single(t_only, "RELATIONSHIP_EXTRA", "relationship only in target", False))


def compare_relationship_ends(pairs: DataFrame, tier: Tier) -> DataFrame:
    """End checks of matched relationships that connect the same entities."""
    return _compare_ends(with_ends_compared(pairs).where("same_ends"), tier)


def _compare_ends(pairs: DataFrame, tier: Tier) -> DataFrame:
    s1, s2, t1, t2 = (F.col(c) for c in ("s_end1", "s_end2", "t_end1", "t_end2"))
    aligned = F.col("aligned")
    ends = F.array(
        F.struct(F.lit("end 1").alias("position"), s1.alias("s"), F.when(aligned, t1).otherwise(t2).alias("t")),
        F.struct(F.lit("end 2").alias("position"), s2.alias("s"), F.when(aligned, t2).otherwise(t1).alias("t")),
    )
    df = pairs.select(
        "pair_id", "label", ((F.col("s_kind") == "ASSOCIATION") | (F.col("t_kind") == "ASSOCIATION")).alias("_assoc"),
        F.explode(ends).alias("e"),
    )
    s, t, assoc = F.col("e")["s"], F.col("e")["t"], F.col("_assoc")
    at = dict(
        object_type="RELATIONSHIP", object_name=F.col("label"),
        member=F.concat(F.col("e")["position"], F.lit(" ("), s["entity"], F.lit(")")))
    sm, tm = card.is_mandatory(s["cardinality"]), card.is_mandatory(t["cardinality"])
    sd, td = F.coalesce(s["dependent"], F.lit(False)), F.coalesce(t["dependent"], F.lit(False))
    sr, tr = trim_ws(s["role"]), trim_ws(t["role"])
    checks = []
    if tier.optionality:
        checks.append(
            check(sm != tm, "OPTIONALITY", "participation differs",
                  F.when(sm, "Mandatory").otherwise("Optional"), F.when(tm, "Mandatory").otherwise("Optional"), **at))
    if tier.dependency:
        checks.append(
            check((sd != td) & ~(assoc & ~sd), "DEPENDENCY", "dependency differs",
                  F.when(sd, "Dependent").otherwise("Independent"), F.when(td, "Dependent").otherwise("Independent"), **at))
    if tier.role_names:
        checks.append(
            check(((sr != "") | (tr != "")) & ~names_equivalent(sr, tr) & ~(assoc & (sr == "")), "ROLE_NAME",
                  "role differs", or_none(sr), or_none(tr), **at))
    return emit(df, PAIR, checks)


def collapsed_variance(relationships: DataFrame, minimum: int = 3) -> DataFrame:
    """Pairs whose relationships all share one cardinality: a sign of a failed parse."""
    ends = F.struct(F.col("end1.cardinality").alias("a"), F.col("end2.cardinality").alias("b"))
    variety = relationships.groupBy("pair_id").agg(
        F.count("*").alias("relationships"), F.min(ends).alias("_lo"), F.max(ends).alias("_hi")
    )
    return variety.where((F.col("relationships") >= minimum) & (F.col("_lo") == F.col("_hi"))).select(
        "pair_id", "relationships", F.col("_lo.a").alias("end1"), F.col("_lo.b").alias("end2")
    )


def cardinality_census(relationships: DataFrame) -> DataFrame:
    """How often each raw cardinality value occurs, and what it folds to."""
    raw = relationships.select(
        "pair_id", F.explode(F.array("end1.cardinality", "end2.cardinality")).alias("raw")
    )
    return raw.groupBy("pair_id", "raw", card.normalize_cardinality("raw").alias("canonical")).agg(
        F.count("*").alias("ends")
    )


# --- hierarchies ----------------------------------------------------------------------


def hierarchy_census(trees: DataFrame, s_children: DataFrame, t_children: DataFrame) -> DataFrame:
    """Matched trees with counts of common, lost and new children.

    ``trees`` (pair_id, s_id, t_id, …); children (pair_id, id, child) with S
    children already in T codes. Children meet by (pair, S tree, child), so a
    tree with millions of children spreads over tasks.
    """
    key = normalize_name("child").alias("child")
    s = s_children.join(trees.select("pair_id", F.col("s_id").alias("id")), ["pair_id", "id"], "left_semi")
    s = s.select("pair_id", F.col("id").alias("s_id"), key).distinct()
    t = t_children.withColumnRenamed("id", "t_id").join(trees.select("pair_id", "s_id", "t_id"), ["pair_id", "t_id"])
    t = t.select("pair_id", "s_id", key).distinct()
    both = m.reconcile_keyed(s, t, ["pair_id", "s_id", "child"])
    counts = both.groupBy("pair_id", "s_id").agg(
        m.count_when(F.col("status") == "MATCHED").alias("common"),
        m.count_when(F.col("status") == "MISSING").alias("lost"),
        m.count_when(F.col("status") == "EXTRA").alias("added"),
    )
    joined = trees.join(counts, ["pair_id", "s_id"], "left").fillna(0, subset=["common", "lost", "added"])
    rules = (F.col("s_complete") != F.col("t_complete")) | (
        F.col("s_mutually_exclusive") != F.col("t_mutually_exclusive"))
    status = (
        F.when((F.col("lost") > 0) | (F.col("added") > 0), "STRUCTURE_DIFFERS")
        .when(rules, "CONSTRAINT_DIFFERS").otherwise("MATCHED"))
    return joined.withColumn("status", status)


def compare_hierarchies(census: DataFrame, s_only: DataFrame, t_only: DataFrame, tier: Tier) -> DataFrame:
    def label(name, parent):
        return F.when(text(name) != "", text(name)).otherwise(F.concat(text(parent), F.lit(" hierarchy")))

    at = dict(object_type="INHERITANCE", object_name=label("s_name", "s_parent"))
    sized = [
        F.concat((F.col("common") + F.col(x)).cast("string"), F.lit(" subtypes")) for x in ("lost", "added")
    ]

    def word(c, yes, no):
        return F.when(F.col(c), yes).otherwise(no)

    checks = [
        check(F.col("status") == "MATCHED", "INHERITANCE_VERIFIED", "hierarchy intact", sized[0], sized[1], **at),
        check(F.col("lost") > 0, "INHERITANCE_STRUCTURE",
              F.concat(F.col("lost").cast("string"), F.lit(" subtypes lost")), sized[0], sized[1], **at),
        check(F.col("added") > 0, "INHERITANCE_EXTRA",
              F.concat(F.col("added").cast("string"), F.lit(" subtypes added")), sized[0], sized[1], **at),
        check(F.col("s_complete") != F.col("t_complete"), "INHERITANCE_CONSTRAINT", "completeness differs",
              word("s_complete", "Complete", "Incomplete"), word("t_complete", "Complete", "Incomplete"), **at),
        check(F.col("s_mutually_exclusive") != F.col("t_mutually_exclusive"), "INHERITANCE_CONSTRAINT",
              "exclusivity differs", word("s_mutually_exclusive", "Exclusive", "Overlapping"),
              word("t_mutually_exclusive", "Exclusive", "Overlapping"), **at),
    ]
    if tier.report_fallback:
        checks.append(
            check(F.col("basis") != "supertype", "FALLBACK_MATCH", "hierarchy not matched on supertype",
                  F.col("s_parent"), F.col("t_parent"), **at))
    own = dict(object_type="INHERITANCE", object_name=label("name", "parent"))
    return (
        emit(census, PAIR, checks)
        .unionByName(emit(s_only, PAIR, [check(F.lit(True), "INHERITANCE_MISSING", "hierarchy only in source", F.col("parent"), ABSENT, **own)]))
        .unionByName(emit(t_only, PAIR, [check(F.lit(True), "INHERITANCE_EXTRA", "hierarchy only in target", ABSENT, F.col("parent"), **own)]))
    )


# --- domains, rules, quality, items ---------------------------------------------------


def compare_domains(pairs: DataFrame, s_only: DataFrame, t_only: DataFrame, tier: Tier) -> DataFrame:
    name = _given("s_name", "s_code")
    at = dict(object_type="DOMAIN", object_name=name)
    s_type, t_type = ty.describe_type("_s_"), ty.describe_type("_t_")
    df = ty.with_type_parts(pairs, "s_data_type", "_s_", "s_length", "s_precision")
    df = ty.with_type_parts(df, "t_data_type", "_t_", "t_length", "t_precision")
    df = df.withColumn("_ok", ty.types_match("_s_", "_t_", tier.type_mode, tier.approved_matrix))
    checks = [
        check(F.col("_ok"), "DOMAIN_VERIFIED", F.concat(F.lit("domain intact, by "), F.col("basis")), s_type, t_type, **at),
        check(~F.col("_ok"), "DOMAIN", "domain type differs", s_type, t_type, **at),
    ]
    if tier.definitions:
        df = with_similarity(df, "s_definition", "t_definition", tier)
        checks += definition_checks(tier, "DOMAIN", name, F.lit(""))
    own = dict(object_type="DOMAIN", object_name=_given("name", "code"))
    s_only, t_only = (ty.with_type_parts(d, "data_type", "_p_", "length", "precision") for d in (s_only, t_only))
    typed = ty.describe_type("_p_")
    return (
        emit(df, PAIR, checks)
        .unionByName(emit(s_only, PAIR, [check(F.lit(True), "DOMAIN", "domain only in source", typed, ABSENT, **own)]))
        .unionByName(emit(t_only, PAIR, [check(F.lit(True), "DOMAIN", "domain only in target", ABSENT, typed, **own)]))
    )


def compare_business_rules(pairs: DataFrame, s_only: DataFrame, t_only: DataFrame) -> DataFrame:
    a, b = normalize_definition("s_expression"), normalize_definition("t_expression")
    changed = check(
        (a != "") & (b != "") & (a != b), "BUSINESS_RULE", "expression differs", text("s_expression"),
        text("t_expression"), object_type="BUSINESS_RULE", object_name=F.col("s_name"))
    own = dict(object_type="BUSINESS_RULE", object_name=_given("name", "code"))
    shown = _given("expression", "definition")
    return (
        emit(pairs, PAIR, [changed])
        .unionByName(emit(s_only, PAIR, [check(F.lit(True), "BUSINESS_RULE", "rule only in source", shown, ABSENT, **own)]))
        .unionByName(emit(t_only, PAIR, [check(F.lit(True), "BUSINESS_RULE", "rule only in target", ABSENT, shown, **own)]))
    )


def check_quality(t_entities: DataFrame, endpoints: DataFrame, s_entities: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """Target entities in no relationship or hierarchy, or emptied by the migration.

    Entities (pair_id, id, name, code, n_attributes); endpoints (pair_id, entity).
    """
    touched = endpoints.select("pair_id", normalize_name("entity").alias("_key")).distinct()
    keyed = t_entities.withColumn("_key", normalize_name(_given("code", "name")))
    at = dict(object_type="ENTITY", object_name=object_label("name", "code"))
    alone = emit(
        m.orphans(keyed, touched, ["pair_id", "_key"]), PAIR,
        [check(F.lit(True), "MODEL_QUALITY", "entity in no relationship or hierarchy", "", "0 relationships", **at)])
    source = s_entities.where("n_attributes > 0").groupBy("pair_id", F.upper("code").alias("_code")).agg(
        F.max("n_attributes").alias("_n"))
    emptied = emit(
        t_entities.where("n_attributes = 0").withColumn("_code", F.upper(text("code"))).join(source, ["pair_id", "_code"]),
        PAIR,
        [check(F.lit(True), "MODEL_QUALITY", "entity lost all attributes",
               F.concat(F.col("_n").cast("string"), F.lit(" attributes")), "0 attributes", **at)])
    found = alone.unionByName(emptied)
    if models is None:
        return found
    named = emit(
        models, PAIR,
        [check((text("s_model") != "") & (text("t_model") != "") & ~names_equivalent("s_model", "t_model"),
               "MODEL_METADATA", "model names differ", F.col("s_model"), F.col("t_model"),
               object_type="MODEL", object_name=F.lit("(model)"))])
    return found.unionByName(named)


def resolve_owner_model(shortcuts: DataFrame, claims: DataFrame, attached: DataFrame) -> DataFrame:
    """Owner model of each external reference: its explicit claim, else the one attached model.

    ``claims`` (pair_id, id, target_model); ``attached`` (pair_id, model, is_extension).
    """
    single = (
        attached.where("not is_extension").groupBy("pair_id")
        .agg(F.count("*").alias("_n"), F.min("model").alias("_only")).where("_n = 1").drop("_n")
    )
    joined = shortcuts.join(claims, ["pair_id", "id"], "left").join(single, "pair_id", "left")
    return joined.withColumn("target_model", F.coalesce("target_model", "_only")).drop("_only")


def list_external_references(shortcuts: DataFrame) -> DataFrame:
    kind = or_none(F.col("type"), "Object")
    target = or_none(F.col("target_model"), "another model")
    return emit(
        shortcuts, PAIR,
        [check(F.lit(True), "SHORTCUT", F.concat(F.lit("reference to an object of "), target),
               F.concat(kind, F.lit(" in "), target), "(not applicable)", object_type="SHORTCUT",
               object_name=or_none(_given("name", "code"), "(unnamed)"), member=kind)])


def usage_census(items: DataFrame, attributes: DataFrame, t_attributes: DataFrame, alias: DataFrame, tier: Tier) -> DataFrame:
    """Every use of every reusable item, and whether it arrived in the target.

    items (pair_id, item, data_type); attributes (pair_id, id, entity, item,
    name, code, data_type); t_attributes (pair_id, entity, ord, name, code,
    data_type); alias as from ``alias_of``. Each use looks up the target
    attributes of its entity by normalised name or code; the lookup keys are
    unique, so no use multiplies.
    """
    used = attributes.withColumn("_item", F.upper(trim_ws("item")))
    known = items.select("pair_id", F.upper(trim_ws("item")).alias("_item"), F.col("data_type").alias("item_type"))
    known = known.groupBy("pair_id", "_item").agg(F.min("item_type").alias("item_type"))
    uses = used.join(known, ["pair_id", "_item"])
    uses = m.rewrite_column(uses, PAIR, F.col("entity"), alias, "_to").withColumn("_to", F.upper(trim_ws("_to")))

    def keys():
        return F.array_distinct(F.array(normalize_name(_given("code", "name")), normalize_name(_given("name", "code"))))

    targets = (
        t_attributes.select(
            "pair_id", F.upper(trim_ws("entity")).alias("_to"), F.explode(keys()).alias("_key"), "ord",
            F.col("data_type").alias("t_type"), F.lit(True).alias("_hit"))
        .groupBy("pair_id", "_to", "_key")
        .agg(F.min(F.struct("ord", "t_type")).alias("_t"))
    )
    looked = uses.select("pair_id", "id", "item", "item_type", "data_type", "_to", F.explode(keys()).alias("_key")).join(
        targets, ["pair_id", "_to", "_key"], "left")
    per_use = looked.groupBy("pair_id", "id").agg(
        F.first("item").alias("item"), F.first("item_type").alias("item_type"), F.first("data_type").alias("own_type"),
        F.min("_t").alias("_t"))
    declared = F.when(text("item_type") != "", text("item_type")).otherwise(text("own_type"))
    typed = per_use.withColumn("_declared", declared).withColumn("_arrived", F.col("_t.t_type"))
    typed = ty.with_type_parts(ty.with_type_parts(typed, "_declared", "_s_"), "_arrived", "_t_")
    ok = ty.types_match("_s_", "_t_", tier.type_mode, tier.approved_matrix)
    outcome = F.when(F.col("_t").isNull(), "NOT_FOUND").when(~ok, "TYPE_DIFFERS").otherwise("ARRIVED")
    return typed.select("pair_id", "id", F.upper(trim_ws("item")).alias("item"), outcome.alias("outcome"))


def compare_items(items: DataFrame, census: DataFrame) -> DataFrame:
    """Exactly one finding per item: verified, with gaps, or unused."""
    counts = census.groupBy("pair_id", "item").agg(
        F.count("*").alias("used"), m.count_when(F.col("outcome") == "NOT_FOUND").alias("not_found"),
        m.count_when(F.col("outcome") == "TYPE_DIFFERS").alias("type_differs"))
    df = items.withColumn("_label", F.col("item")).withColumn("item", F.upper(trim_ws("item"))).join(
        counts, ["pair_id", "item"], "left").fillna(0, subset=["used", "not_found", "type_differs"])
    gaps = F.col("not_found") + F.col("type_differs")
    at = dict(object_type="DATA_ITEM", object_name=F.col("_label"))
    uses = F.concat(F.lit("used by "), F.col("used").cast("string"))
    typed = or_none(F.col("data_type"), "(untyped)")
    detail = F.concat(
        F.col("not_found").cast("string"), F.lit(" not found, "), F.col("type_differs").cast("string"), F.lit(" with another type"))
    return emit(
        df, PAIR,
        [
            check(F.col("used") == 0, "DATA_ITEM", "item is not used", typed, "(unused)", **at),
            check((F.col("used") > 0) & (gaps > 0), "DATA_ITEM", detail, typed, "", member=uses, **at),
            check((F.col("used") > 0) & (gaps == 0), "DATA_ITEM_VERIFIED", "item arrived with all uses", typed, "", member=uses, **at),
        ],
    )
