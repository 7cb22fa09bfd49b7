"""Custom properties: one value per (owner, property), source against target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import is_blank, text, trim_ws, udp_full_name, udp_name
from ..operators.matching import count_when, occurrence_join
from ..operators.ordered import keep_one

STATUSES = ("PASS", "MISMATCH", "MISSING", "BLANK", "EXTRA")
RELIABILITY_FLOOR = 0.80
LIST_LIMIT = 12

# Outcomes a property writer reports.
VERIFIED, ALTERED, UNVERIFIED = "Applied - Verified", "Applied - Value Altered", "Applied - Not Verified"
NO_ENTITY, REJECTED = "Skipped - Entity Not Found In Target", "Skipped - Property Rejected By Target"
NOT_RUN = "Not Verified - No Injection Result"

# How property values are recognised.
GUID_FORM = r"^\{?[0-9A-Fa-f]{8}-"
DATE_FORM = r"^[0-9]{1,4}[-/][0-9]{1,2}[-/][0-9]{1,4}"
STRUCTURAL = (("Source_ObjectID", 40), ("Source_Extraction", 20), ("Source_Model", 120))

PAIR = ["pair_id"]
CELL = ["pair_id", "owner_key", "udp"]


def _cell_key(df: DataFrame) -> DataFrame:
    return df.withColumn("owner_key", F.lower(trim_ws("owner")))


def cell_reconcile(s: DataFrame, t: DataFrame, roots: DataFrame) -> DataFrame:
    """One row per cell with its status.

    s, t (pair_id, owner, udp, value, ord); roots (pair_id, root). A source row
    without an owner belongs to the model root. The first source value of a cell
    counts, and the last target value. A blank source cell is BLANK whatever the
    target holds.
    """
    named = s.where(text("udp") != "").join(roots, PAIR, "left")
    rooted = is_blank("owner")
    named = named.withColumn("applied_to", F.when(rooted, "Model Root").otherwise("Entity")).withColumn(
        "owner", F.when(rooted, F.col("root")).otherwise(F.col("owner")))
    left = keep_one(_cell_key(named), CELL, [F.asc("ord")]).select(
        *CELL, "applied_to", text("value").alias("s_value"), F.lit(True).alias("_s"))
    right = keep_one(_cell_key(t), CELL, [F.desc("ord")]).select(
        *CELL, text("value").alias("t_value"), F.lit(True).alias("_t"))
    owners = _cell_key(t).select("pair_id", "owner_key").distinct().withColumn("_known", F.lit(True))
    both = left.join(right, CELL, "full").join(owners, ["pair_id", "owner_key"], "left").join(roots, PAIR, "left")
    status = (
        F.when(F.col("_s").isNull(), "EXTRA")
        .when(is_blank("s_value"), "BLANK")
        .when(F.col("_t").isNull(), "MISSING")
        .when(F.col("s_value") == F.col("t_value"), "PASS")
        .otherwise("MISMATCH"))
    side = F.when(F.col("owner_key") == F.lower(trim_ws("root")), "Model Root").otherwise("Entity")
    absent = (F.col("status") == "MISSING") & (F.col("applied_to") == "Entity") & F.col("_known").isNull()
    return (
        both.withColumn("status", status)
        .withColumn("applied_to", F.coalesce("applied_to", side))
        .withColumn("owner_absent", absent)
        .select(*CELL, "applied_to", "s_value", "t_value", "status", "owner_absent"))


def collapse_warnings(s: DataFrame) -> DataFrame:
    """Per pair: source rows without an owner, and rows a cell could not keep."""
    named = s.where(text("udp") != "")
    per_cell = _cell_key(named).groupBy(*CELL).agg(F.count("*").alias("_n"))
    return per_cell.groupBy("pair_id").agg(
        F.sum(F.when(F.col("owner_key") == "", F.col("_n")).otherwise(0)).alias("nameless"),
        F.sum(F.col("_n") - 1).alias("collapsed"))


def _comparable() -> Column:
    return F.col("pass") + F.col("mismatch") + F.col("missing")


def by_property_rollup(cells: DataFrame, by: Sequence[str] = ("udp",)) -> DataFrame:
    counts = cells.groupBy(*by).agg(
        F.count("*").alias("rows"),
        *[count_when(F.col("status") == s).alias(s.lower()) for s in STATUSES])
    n = _comparable()
    rate = F.when(n == 0, 0.0).otherwise(F.round(F.col("pass") / n, 4))
    verdict = (
        F.when(n == 0, "NOTHING TO MIGRATE").when(F.col("pass") == n, "PASS")
        .when(F.col("pass") == 0, "FAIL - NONE MATCHED").otherwise("REVIEW REQUIRED"))
    return counts.withColumn("pass_rate", rate).withColumn("verdict", verdict)


def cell_verdict(cells: DataFrame, reliability: DataFrame) -> DataFrame:
    """One verdict per pair; ``reliability`` as from :func:`readback_reliability`."""
    counts = cells.groupBy("pair_id").agg(
        *[count_when(F.col("status") == s).alias(s.lower()) for s in STATUSES])
    joined = counts.join(reliability.select("pair_id", "reliable"), PAIR, "left")
    n = _comparable()
    verdict = (
        F.when(F.col("reliable").isNull(), "NOT VERIFIED - TARGET NOT READ")
        .when(~F.col("reliable"), "NOT VERIFIED - READBACK UNRELIABLE")
        .when(n == 0, "NO SOURCE VALUES")
        .when(F.col("pass") == n, "PASS")
        .when(F.col("pass") == 0, "FAIL - NONE MATCHED")
        .otherwise("REVIEW REQUIRED"))
    rate = F.when(n == 0, 0.0).otherwise(F.round(F.lit(100.0) * F.col("pass") / n, 2))
    return joined.withColumns({"comparable": n, "pass_rate": rate, "verdict": verdict})


def readback_reliability(s: DataFrame, t: DataFrame, floor: float = RELIABILITY_FLOOR) -> DataFrame:
    """Agreement of the cells both sides hold; below the floor the readback is not used.

    s, t (pair_id, owner_key, udp, value) with one row per cell.
    """
    paired = t.alias("t").join(s.alias("s"), CELL).select(
        "pair_id", (F.col("t.value") == F.col("s.value")).alias("_same"))
    checked = paired.groupBy("pair_id").agg(F.count("*").alias("checked"), count_when(F.col("_same")).alias("agreed"))
    every = t.groupBy("pair_id").agg(F.count("*").alias("decoded")).join(checked, PAIR, "left").fillna(
        0, subset=["checked", "agreed"])
    ratio = F.when(F.col("checked") > 0, F.col("agreed") / F.col("checked"))
    return every.withColumn("confidence", F.round(ratio, 4)).withColumn(
        "reliable", F.coalesce(ratio >= floor, F.lit(False)))


def gate_on_reliability(cells: DataFrame, reliability: DataFrame) -> DataFrame:
    """Cells of pairs whose readback can be trusted; the others are suppressed."""
    return cells.join(reliability.where("reliable").select("pair_id"), PAIR, "left_semi")


def persisted_status(log: DataFrame, readback: DataFrame) -> DataFrame:
    """What a writer logged against what was read back: yes, no, altered, blank source.

    log (pair_id, owner_key, udp, value, …), readback (pair_id, owner_key, udp, value).
    """
    disk = readback.select(*CELL, F.col("value").alias("persisted_value"), F.lit(True).alias("_found"))
    joined = log.join(disk, CELL, "left")
    status = (
        F.when(is_blank("value"), "blank source").when(F.col("_found").isNull(), "no")
        .when(F.col("persisted_value") == F.col("value"), "yes").otherwise("altered"))
    return joined.withColumn("persisted", status).drop("_found")


# --- profile and schema ---------------------------------------------------------------


def profile_properties(cells: DataFrame, by: Sequence[str] = ("path",)) -> DataFrame:
    """Exact profile of each property over all its values.

    Equal values are folded first, map-side, so a property that holds a third of
    all rows is profiled from its distinct values.
    """
    by = list(by)
    folded = cells.groupBy(*by, text("value").alias("value")).agg(F.count("*").alias("n"))
    trimmed = trim_ws("value")
    filled = trimmed != ""

    def all_filled(cond):
        return F.coalesce(F.min(F.when(filled, cond.cast("int"))), F.lit(0)) == 1

    return folded.groupBy(*by).agg(
        F.sum("n").alias("observed"),
        F.sum(F.when(filled, F.col("n")).otherwise(0)).alias("populated"),
        F.count("*").alias("distinct_values"),
        count_when(filled).alias("distinct_filled"),
        F.max(F.length("value")).alias("longest"),
        all_filled(F.lower(trimmed).isin("true", "false")).alias("all_boolean"),
        all_filled(trimmed.rlike(GUID_FORM)).alias("all_guid"),
        all_filled(trimmed.rlike(DATE_FORM)).alias("all_date"),
    ).withColumn("coverage", F.round(F.lit(100.0) * F.col("populated") / F.col("observed"), 2))


def value_lists(cells: DataFrame, by: Sequence[str] = ("path",), limit: int = LIST_LIMIT) -> DataFrame:
    """Sorted distinct non-blank values of properties that have at most ``limit`` of them."""
    by = list(by)
    values = cells.where(~is_blank("value")).select(*by, "value").distinct()
    rank = F.row_number().over(W.partitionBy(*by).orderBy("value"))
    few = values.withColumn("_rank", rank).where(F.col("_rank") <= limit + 1)
    lists = few.groupBy(*by).agg(F.max("_rank").alias("_n"), F.array_sort(F.collect_list("value")).alias("value_list"))
    return lists.where(F.col("_n") <= limit).drop("_n")


def infer_property_schema(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Type, length and value list of each property path; never a number.

    A leaf name that several paths share, or that a structural property uses, is
    kept once; the other paths take their full name.
    """
    by = list(by)
    profile = profile_properties(cells, [*by, "path"]).join(
        value_lists(cells, [*by, "path"]), [*by, "path"], "left")
    booleans = F.array(F.lit("true"), F.lit("false"))
    is_bool, is_guid, is_date = F.col("all_boolean"), F.col("all_guid"), F.col("all_date")
    short = (F.col("distinct_filled") > 0) & (F.col("distinct_filled") <= LIST_LIMIT)
    is_list = is_bool | (~is_guid & ~is_date & short)
    length = (
        F.when(is_bool, F.lit(None)).when(is_guid, 40).when(is_date, 60).when(is_list, F.lit(None))
        .otherwise(F.greatest(F.lit(60), F.least(F.lit(1024), F.col("longest") + 40))).cast("int"))
    leaf = udp_name("path")
    first = F.row_number().over(W.partitionBy(*by, leaf).orderBy("path"))
    taken = leaf.isin(*[name for name, _ in STRUCTURAL])
    inferred = profile.withColumn("_first", first).select(
        *by,
        F.when((F.col("_first") == 1) & ~taken, leaf).otherwise(udp_full_name("path")).alias("udp"),
        F.when(is_list, "List").otherwise("Text").alias("type"),
        length.alias("length"),
        F.when(is_bool, booleans).when(is_list, F.col("value_list")).alias("value_list"),
        F.col("path").alias("source_path"),
        "coverage",
        F.col("distinct_values").alias("distinct_observed"),
        F.when(is_list, "OBSERVED").otherwise("").alias("list_source"),
    )
    return inferred


def structural_schema(spark) -> DataFrame:
    """The three properties every model gets, whatever it holds."""
    rows = [(name, "Text", size) for name, size in STRUCTURAL]
    return spark.createDataFrame(rows, "udp string, type string, length int")


def build_manifest(objects: DataFrame, properties: DataFrame, schema: DataFrame) -> DataFrame:
    """All cells to migrate: three structural ones per object, one per property.

    objects (pair_id, object_id, name, code, extraction, model), properties
    (pair_id, object_id, path, value), schema (source_path, udp).
    """
    base = ["pair_id", "object_id", "name", "code"]
    values = ["object_id", "extraction", "model"]
    cells = [
        F.struct(F.lit(n).alias("udp"), F.col(v).cast("string").alias("value"), F.lit("").alias("source_path"))
        for (n, _), v in zip(STRUCTURAL, values)
    ]
    fixed = objects.select(*base, F.explode(F.array(*cells)).alias("c")).select(*base, "c.*")
    names = schema.select(F.col("source_path").alias("path"), "udp")
    own = properties.join(names, "path", "left").join(objects.select(*base), ["pair_id", "object_id"]).select(
        *base, F.coalesce("udp", udp_name("path")).alias("udp"), "value", F.col("path").alias("source_path"))
    return fixed.unionByName(own)


# --- outcome reports ------------------------------------------------------------------


def reconcile_outcomes(manifest: DataFrame, outcomes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Each manifest cell with the outcome recorded for the same occurrence of its key.

    manifest (owner_key, udp, source_path, value, …); outcomes add occurrence,
    outcome, target_value.
    """
    key = ["owner_key", "udp", "source_path"]
    joined = occurrence_join(manifest, outcomes, key, order)
    status = F.coalesce("outcome", F.lit(NOT_RUN))
    match = (
        F.when(status == VERIFIED, "Match").when(status == ALTERED, "Mismatch")
        .when(status == UNVERIFIED, "Unverified").otherwise("Not Applied"))
    return joined.withColumn("status", status).withColumn("match", match).drop("outcome")


def definition_rollup(schema: DataFrame, dictionary: DataFrame, recon: DataFrame) -> DataFrame:
    """Per property definition: owners, actions, expected, applied, verified, status.

    schema (udp, value_list), dictionary (udp, owner, action), recon (udp, status, match).
    The owner types of a property are a closed set, so the collected sets are small.
    """
    actions = dictionary.groupBy("udp").agg(
        F.array_join(F.array_sort(F.collect_set("owner")), ", ").alias("owners"),
        F.array_join(F.array_sort(F.collect_set(F.concat(F.initcap("action"), F.lit(" ("), "owner", F.lit(")")))), "; ").alias("actions"),
        F.max(F.col("action") == "failed").alias("_failed"))
    used = recon.groupBy("udp").agg(
        F.count("*").alias("expected"), count_when(F.col("status").startswith("Applied")).alias("applied"),
        count_when(F.col("match") == "Match").alias("verified"))
    joined = schema.join(actions, "udp", "left").join(used, "udp", "left").fillna(
        0, subset=["expected", "applied", "verified"])
    status = (
        F.when(F.col("owners").isNull(), "NOT CREATED").when(F.col("_failed"), "FAILED")
        .when(F.col("expected") == 0, "DEFINED - NO VALUES")
        .when(F.size("value_list") > 0, "DEFINED AS LIST").otherwise("DEFINED"))
    return joined.withColumn("definition_status", status).drop("_failed")


def exceptions(recon: DataFrame, dictionary: DataFrame, schema: DataFrame, entities: DataFrame, register: DataFrame) -> DataFrame:
    """Everything a reviewer must see, in one list: (severity, category, owner, udp)."""
    blank = F.lit("")

    def rows(df, severity, category, owner=blank, udp=blank):
        return df.select(F.lit(severity).alias("severity"), F.lit(category).alias("category"),
                         text(owner).alias("owner"), text(udp).alias("udp"))

    owner, udp = F.col("owner_key"), F.col("udp")
    empty = recon.where(is_blank("value"))
    has_id = F.col("udp") == STRUCTURAL[0][0]
    parts = [
        rows(dictionary.where("action = 'failed'"), "High", "Definition failed", blank, udp),
        rows(recon.where(F.col("status") == NO_ENTITY), "High", "Entity not found", owner, udp),
        rows(recon.where(F.col("status") == REJECTED), "High", "Property rejected", owner, udp),
        rows(recon.where(F.col("status") == ALTERED), "High", "Value altered", owner, udp),
        rows(recon.where(F.col("status") == NOT_RUN), "Medium", "Not verified", owner, udp),
        rows(empty.where(has_id), "Medium", "Missing object id", owner, udp),
        rows(empty.where(~has_id), "Low", "Empty source value", owner, udp),
        rows(entities.where(is_blank("name")), "Medium", "Unnamed entity", F.col("code")),
        rows(schema.where(F.size("value_list") > 0), "Low", "Inferred value list", blank, udp),
        rows(register.where("disposition in ('NOT_RECOVERABLE', 'OUT_OF_SCOPE')"), "Informational", "Not carried over", blank, F.col("construct")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def or_no_exceptions(rows: DataFrame) -> DataFrame:
    """The list itself, or one row that says there is nothing to report."""
    spark = rows.sparkSession
    nothing = spark.createDataFrame([("Informational", "No exceptions", "", "")], rows.schema)
    total = rows.agg(F.count("*").alias("_n"))
    # One row against one row: the count decides whether the fallback stays.
    fallback = nothing.withColumn("_k", F.lit(1)).join(total.withColumn("_k", F.lit(1)).where("_n = 0"), "_k", "left_semi")
    return rows.unionByName(fallback.drop("_k"))


def verification_rates(recon: DataFrame) -> DataFrame:
    """Application and verification rate, and the verdict of the whole migration."""
    counts = recon.groupBy("pair_id").agg(
        F.count("*").alias("total"), count_when(F.col("status").startswith("Applied")).alias("applied"),
        count_when(F.col("match") == "Match").alias("verified"),
        count_when(F.col("match") == "Mismatch").alias("altered"),
        count_when(F.col("status").startswith("Skipped")).alias("skipped"))
    verdict = (
        F.when((F.col("total") > 0) & (F.col("verified") == F.col("total")), "PASS")
        .when(F.col("applied") == 0, "FAIL - NOTHING APPLIED")
        .when((F.col("altered") > 0) | (F.col("skipped") > 0), "REVIEW REQUIRED").otherwise("PASS"))
    return counts.withColumns({
        "application_rate": F.round(F.col("applied") / F.col("total"), 4),
        "verification_rate": F.round(F.col("verified") / F.col("total"), 4),
        "verdict": verdict})
