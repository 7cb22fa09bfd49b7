"""Text fields: which text went where, and whether it arrived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import similarity_of_normalized
from ..functions.text import is_blank, normalize_definition, text, truncate
from ..operators.matching import count_when, match_tiered

# Mapping, source field, target field.
SEMANTIC_MAPPINGS = (
    ("Comment → Note", "comment", "note"),
    ("Description → Definition", "description", "definition"),
    ("Annotation → Extended Notes", "annotation", "extended_notes"),
)
PHYSICAL_MAPPINGS = (
    ("Comment → Comment", "comment", "comment"),
    ("Description → Definition", "description", "definition"),
    ("Annotation → Extended Notes", "annotation", "extended_notes"),
)
STATUSES = ("MATCHED", "MISMATCH", "MISSING_IN_T", "MISSING_IN_S", "BOTH_EMPTY")
DISPLAY_LIMIT = 500


def map_fields(pairs: DataFrame, keep: Sequence[str], mappings=SEMANTIC_MAPPINGS) -> DataFrame:
    """Unpivot matched objects (s_*, t_*) into one row per mapping."""
    rows = [
        F.struct(F.lit(name).alias("mapping"), text(f"s_{s}").alias("s_text"), text(f"t_{t}").alias("t_text"))
        for name, s, t in mappings
    ]
    return pairs.select(*keep, F.explode(F.array(*rows)).alias("r")).select(*keep, "r.*")


def map_target_only(t_only: DataFrame, keep: Sequence[str], mappings=SEMANTIC_MAPPINGS) -> DataFrame:
    """Texts that only target objects carry; blank ones are not listed."""
    rows = [
        F.struct(F.lit(name).alias("mapping"), F.lit("").alias("s_text"), text(t).alias("t_text"))
        for name, _, t in mappings
    ]
    return t_only.select(*keep, F.explode(F.array(*rows)).alias("r")).select(*keep, "r.*").where(~is_blank("t_text"))


def map_fields_physical(objects: DataFrame, keep: Sequence[str], kind: str = "kind") -> DataFrame:
    """Like :func:`map_fields` for tables and columns of one full outer join.

    Comments always; the other mappings only where the source model uses the
    field anywhere. Columns without any text are left out, tables never.
    """
    used = objects.groupBy("pair_id").agg(
        *[F.max(~is_blank(f"s_{s}")).alias(f"_use_{s}") for _, s, _ in PHYSICAL_MAPPINGS[1:]])
    fields = [f"s_{s}" for _, s, _ in PHYSICAL_MAPPINGS] + [f"t_{t}" for _, _, t in PHYSICAL_MAPPINGS]
    silent = F.lit(True)
    for f in fields:
        silent = silent & is_blank(f)
    listed = objects.where((F.col(kind) == "TABLE") | ~silent)
    mapped = map_fields(listed, [*keep], PHYSICAL_MAPPINGS)
    gate = F.lit(True)
    for name, s, _ in PHYSICAL_MAPPINGS[1:]:
        gate = gate & ((F.col("mapping") != name) | F.col(f"_use_{s}"))
    return mapped.join(used, "pair_id").where(gate).select(*mapped.columns)


def classify_text(rows: DataFrame, rule: str = "threshold", threshold: float = 0.90, method: str = "levenshtein") -> DataFrame:
    """Adds ``status`` and ``similarity`` (percent).

    ``threshold``: matched when similar enough. ``equal``: matched only when
    equal but for case and blanks. ``exact``: equal but for blanks, no measuring.
    """
    mode = "exact" if rule == "exact" else "lower"
    df = rows.withColumn("_s", normalize_definition("s_text", mode)).withColumn(
        "_t", normalize_definition("t_text", mode))
    s, t = F.col("_s"), F.col("_t")
    if rule == "exact":
        status = _four(s, t, s == t, "TEXT_DIFFERS", "EXTRA_IN_T")
        return df.withColumn("status", status).drop("_s", "_t")
    df = df.withColumn("_r", similarity_of_normalized(s, t, method))
    same = (F.col("_r") >= threshold) if rule == "threshold" else (s == t)
    status = _four(s, t, same, "MISMATCH", "MISSING_IN_S")
    percent = (
        F.when(F.col("status") == "MATCHED", 100.0)
        .when(F.col("status") == "MISMATCH", F.round(F.col("_r") * 100, 2)).otherwise(0.0))
    return df.withColumn("status", status).withColumn("similarity", percent).drop("_s", "_t", "_r")


def _four(s: Column, t: Column, same: Column, differs: str, only_t: str) -> Column:
    return (
        F.when((s == "") & (t == ""), "BOTH_EMPTY").when(t == "", "MISSING_IN_T").when(s == "", only_t)
        .when(same, "MATCHED").otherwise(differs))


def shown_values(rows: DataFrame) -> DataFrame:
    """Adds report cells, one line cut for display; the whole texts stay beside them."""
    return rows.withColumn("s_value", truncate("s_text", DISPLAY_LIMIT)).withColumn(
        "t_value", truncate("t_text", DISPLAY_LIMIT))


def summarise_fields(rows: DataFrame, by: Sequence[str] = ("mapping",), statuses: Sequence[str] = STATUSES) -> DataFrame:
    return rows.groupBy(*by).agg(*[count_when(F.col("status") == s).alias(s.lower()) for s in statuses])


def field_coverage(objects: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per field: objects that carry text, all objects, percent."""
    total = objects.groupBy(*by).agg(
        F.count("*").alias("objects"), *[count_when(~is_blank(f)).alias(f) for f in fields])
    long = total.unpivot([*by, "objects"], list(fields), "field", "populated")
    percent = F.round(F.lit(100.0) * F.col("populated") / F.greatest(F.col("objects"), F.lit(1)), 2)
    return long.withColumn("percent", percent)


def content_inventory(objects: DataFrame) -> DataFrame:
    """Per pair and kind: totals, objects with text on each side, the gap, and a TOTAL row.

    objects (pair_id, kind, side, comment, definition, note); the physical kinds
    count whichever of note and definition the target filled more.
    """
    s, t = F.col("side") == "S", F.col("side") == "T"
    counts = [
        count_when(s).alias("objects"),
        count_when(s & ~is_blank("comment")).alias("with_comment"),
        count_when(s & ~is_blank("definition")).alias("with_definition"),
        count_when(t & ~is_blank("note")).alias("t_notes"),
        count_when(t & ~is_blank("definition")).alias("t_definitions"),
    ]
    base = objects.groupBy("pair_id", "kind").agg(*counts)
    physical = F.col("kind").isin("TABLE", "COLUMN")
    carried = F.when(physical, F.greatest("t_notes", "t_definitions")).otherwise(F.col("t_notes"))
    gap = base.withColumn("gap", F.greatest(F.col("with_comment") - carried, F.lit(0)))
    sums = ["objects", "with_comment", "with_definition", "t_notes", "t_definitions", "gap"]
    rolled = gap.rollup("pair_id", "kind").agg(
        F.grouping_id().alias("_g"), *[F.sum(c).alias(c) for c in sums])
    kept = rolled.where("_g < 3").withColumn("kind", F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("kind")))
    return kept.drop("_g")


def enrich_notes(t: DataFrame, s: DataFrame, scope: Sequence[str], on_existing: str = "skip", kinds: Sequence[str] = ("ENTITY", "ATTRIBUTE")) -> DataFrame:
    """Write S comments onto matched T objects.

    T (scope…, kind, id, ord, name, code, notes ARRAY), S (scope…, kind, id, name,
    code, comment). Driven from T; several T objects may take one S comment.
    Adds the new ``notes`` and what happened to each object.
    """
    if on_existing not in ("skip", "replace", "append"):
        raise ValueError(f"unknown on_existing {on_existing!r}")
    key = [*scope, "kind"]
    found = match_tiered(t, s, key, exclusive=False)
    hits = found.select(*key, F.col("s_id").alias("id"), "tier", F.col("t_id").alias("_partner"))
    comments = s.select(*key, F.col("id").alias("_partner"), text("comment").alias("comment"))
    df = t.join(hits, [*key, "id"], "left").join(comments, [*key, "_partner"], "left")
    has = F.size("notes") > 0
    reason = (
        F.when(F.col("tier").isNull(), "NO_PARTNER")
        .when(~F.col("kind").isin(*kinds), "KIND_EXCLUDED")
        .when(is_blank("comment"), "COMMENT_EMPTY")
        .when(has & F.lit(on_existing == "skip"), "NOTE_PRESENT")
        .when(has, "APPENDED" if on_existing == "append" else "REPLACED")
        .otherwise("INSERTED"))
    df = df.withColumn("reason", reason)
    written = F.col("reason").isin("APPENDED", "REPLACED", "INSERTED")
    status = F.when(F.col("reason") == "NO_PARTNER", "UNMATCHED").when(written, "UPDATED").otherwise("SKIPPED")
    fresh = F.array(F.col("comment"))
    notes = F.when(F.col("reason") == "APPENDED", F.concat("notes", fresh)).when(written, fresh).otherwise(F.col("notes"))
    return df.withColumn("status", status).withColumn("notes", notes).drop("_partner", "comment")


def unmatched_objects(s_only: DataFrame, t_only: DataFrame, explained: DataFrame | None, scope: Sequence[str]) -> DataFrame:
    """Objects without a partner on either side, target ones with a reason.

    ``explained`` (scope…, id, reason) as from ``explain_extra_by_prefix``.
    """
    left = s_only.select(F.lit("S").alias("side"), *scope, "id", "name", "code", F.lit("NOT_IN_TARGET").alias("reason"))
    right = t_only.select(*scope, "id", "name", "code")
    if explained is None:
        right = right.withColumn("reason", F.lit("NO_COUNTERPART"))
    else:
        right = right.join(explained.select(*scope, "id", "reason"), [*scope, "id"], "left").fillna(
            "NO_COUNTERPART", subset=["reason"])
    return left.unionByName(right.withColumn("side", F.lit("T")).select(*left.columns))


