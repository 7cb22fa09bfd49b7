"""Jobs around the comparison: repair, two passes, sign-off, audit, status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Tier
from ..functions.text import compare_key, text
from ..operators.matching import count_when
from ..operators.ordered import keep_one
from ..session import stored
from . import physical as ph
from . import scoring
from .findings import apply_severity, severity_rank

COLUMN = ["pair_id", "table", "column"]


def remediate_columns(s: DataFrame, t: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repaired T columns, actions). Missing columns of tables that exist come back from S.

    ``records`` are column records with their status: the findings are the work
    list. T is not changed; the result is a new snapshot.
    """
    back, actions = missing_columns(s, t, records)
    return t.unionByName(back.select(*t.columns)), actions


def missing_columns(s: DataFrame, t: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(columns that T gets back from S, actions); see ``remediate_columns``."""
    work = records.where("status = 'MISSING'").select(*COLUMN)
    tables = t.select("pair_id", "table").distinct()
    # Only rows of missing columns are ranked.
    back = keep_one(s.join(work, COLUMN, "left_semi").join(tables, ["pair_id", "table"], "left_semi"), COLUMN, [F.desc("ord")])
    actions = work.join(tables.withColumn("_t", F.lit(True)), ["pair_id", "table"], "left").select(
        *COLUMN, F.when(F.col("_t"), "RESTORED").otherwise("TABLE_MISSING").alias("action"))
    return back, actions


def remediate_keys(s_keys: DataFrame, t_keys: DataFrame, t_columns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repaired T primary keys, actions). Lost members return in S order.

    keys (pair_id, table, members ARRAY); a member whose column the target does
    not hold is not invented, it is reported.
    """
    on = ["pair_id", "table"]
    member = F.explode(F.transform("members", lambda x: compare_key(x))).alias("column")
    wanted = s_keys.select(*on, F.posexplode(F.transform("members", lambda x: compare_key(x))).alias("pos", "column"))
    held = t_keys.select(*on, member).distinct().withColumn("_held", F.lit(True))
    columns = t_columns.select(*on, compare_key("column").alias("column")).distinct().withColumn("_exists", F.lit(True))
    known = t_columns.select(*on).distinct()
    rated = wanted.join(known, on, "left_semi").join(held, [*on, "column"], "left").join(columns, [*on, "column"], "left")
    action = F.when(F.col("_held"), "KEPT").when(F.col("_exists"), "RELINKED").otherwise("COLUMN_MISSING")
    actions = rated.withColumn("action", action).select(*on, "pos", "column", "action")
    added = actions.where("action = 'RELINKED'").groupBy(*on).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "column"))), lambda x: x["column"]).alias("_new"))
    empty = F.array().cast("array<string>")
    repaired = t_keys.join(added, on, "full").select(
        *on, F.concat(F.coalesce("members", empty), F.coalesce("_new", empty)).alias("members"))
    return repaired, actions


def remediate_joins(missing: DataFrame, t_columns: DataFrame, t_edges: DataFrame) -> DataFrame:
    """What can be done for each lost join column of a lost reference.

    missing (pair_id, ref, parent_table, child_table, parent_col, child_col,
    resolves): a join is filled only when both columns exist, the tables still
    have an edge, and the pointer does not already resolve.
    """
    cols = t_columns.select("pair_id", "table", "column").distinct()

    def exists(df, side):
        dim = cols.select("pair_id", F.col("table").alias(f"{side}_table"), F.col("column").alias(f"{side}_col"),
                          F.lit(True).alias(f"_{side}"))
        return df.join(dim, ["pair_id", f"{side}_table", f"{side}_col"], "left")

    edge = ["pair_id", "parent_table", "child_table"]
    rated = exists(exists(missing, "parent"), "child").join(
        t_edges.select(*edge).distinct().withColumn("_edge", F.lit(True)), edge, "left")
    outcome = (
        F.when((text("parent_col") == "") | (text("child_col") == ""), "SOURCE_INCOMPLETE")
        .when(F.col("_edge").isNull(), "NO_EDGE")
        .when(F.col("_parent").isNull() | F.col("_child").isNull(), "COLUMN_MISSING")
        .when(F.col("resolves"), "KEPT").otherwise("FILLED"))
    return rated.withColumn("outcome", outcome).drop("_parent", "_child", "_edge")


def physical_pass(s: DataFrame, t: DataFrame, tier: Tier, s_unique: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(findings, records, results) of the column comparison of one snapshot pair.

    Every row of a side is in some record, so the records name all pairs.
    """
    records = stored(ph.with_types(ph.column_records(s, t, positions=True, s_unique=s_unique), tier), "records")
    findings = apply_severity(ph.compare_columns(records, tier), tier)
    counters = scoring.join_counts(
        records, [scoring.count_by_status(records, "columns"), scoring.severity_counts(findings)])
    results = scoring.gate(
        scoring.count_identities(scoring.fidelity_score(counters, tier, F.col("columns_s")), ["columns"]),
        tier.promotion_target)
    return findings, records, results


def two_pass(s: DataFrame, t: DataFrame, tier: Tier) -> dict[str, DataFrame]:
    """Compare, repair what is blocked, compare what was written, gate again.

    The repaired snapshot is written to the shared folder before the second
    pass, which therefore judges the written rows and not the intention. S is
    what the first pass has read of it: its columns stand in the written records.
    """
    found1, records1, results1 = physical_pass(s, t, tier)
    results1 = stored(results1, "results")
    blocked = results1.where("not promote").select("pair_id")
    held = records1.join(blocked, "pair_id", "left_semi")
    rest = [c for c in s.columns if c not in COLUMN]

    def source(records):
        return records.select(*COLUMN, *[F.col(f"s_{c}").alias(c) for c in rest])

    kept = stored(t.join(blocked, "pair_id", "left_semi"), "snapshot")
    back, actions = missing_columns(source(held.where("status = 'MISSING'")), kept, held)
    written = kept.unionByName(stored(back.select(*kept.columns), "snapshot"))
    found2, _, results2 = physical_pass(source(held.where("status <> 'EXTRA'")), written, tier, s_unique=True)
    final = results1.where("promote").withColumn("stage", F.lit("3_final")).unionByName(
        results2.withColumn("stage", F.when(F.col("promote"), "3_final").otherwise("2_preprocessed")))
    first_ok = found1.join(blocked, "pair_id", "left_anti")
    return {
        "initial": results1, "final": final, "initial_findings": found1,
        "final_findings": first_ok.unionByName(found2), "actions": actions, "snapshot": written,
    }


def as_imported(initial: DataFrame, final: DataFrame) -> DataFrame:
    """What the import lost, and whether the repair brought it back."""
    bad = F.col("severity").isin("CRITICAL", "WARNING")
    key = ["pair_id", "category", "_table", "_column"]

    def keyed(df):
        return df.where(bad).withColumn("_table", compare_key("object_name")).withColumn("_column", compare_key("member"))

    left = keyed(final).select(*key).distinct().withColumn("_left", F.lit(True))
    return keyed(initial).join(left, key, "left").withColumn("repaired", F.col("_left").isNull()).drop(
        "_left", "_table", "_column")


def sign_off(findings: DataFrame, reviews: DataFrame, strict: bool = False) -> DataFrame:
    """Per pair: may a person's review release it?

    findings (pair_id, finding_id, severity), reviews (finding_id, review). No
    critical finding, and every finding that is not INFO marked acceptable;
    ``strict`` asks the same of VERIFIED rows. Pairs are approved, scores stay.
    """
    context = ("INFO",) if strict else ("INFO", "VERIFIED")
    joined = findings.join(reviews, "finding_id", "left")
    critical = F.col("severity") == "CRITICAL"
    open_row = ~F.col("severity").isin(*context) & (F.lower(F.trim(text("review"))) != "acceptable")
    counts = joined.groupBy("pair_id").agg(
        count_when(critical).alias("critical"), count_when(open_row & ~critical).alias("unapproved"))
    return counts.withColumn("approved", (F.col("critical") == 0) & (F.col("unapproved") == 0))


def review_list(findings: DataFrame, include_info: bool = False) -> DataFrame:
    """Differences only, each with a sentence for the reviewer."""
    keep = ("CRITICAL", "WARNING", "INFO") if include_info else ("CRITICAL", "WARNING")
    where = F.concat_ws(".", F.nullif(text("object_name"), F.lit("")), F.nullif(text("member"), F.lit("")))
    place = F.when(where == "", "(model level)").otherwise(where)

    def shown(c):
        return F.when(text(c).isin("", "—"), "").otherwise(text(c))

    s, t = shown("s_value"), shown("t_value")

    def given(v):
        return F.when(v == "", "(none)").otherwise(v)

    values = F.when((s == "") & (t == ""), "").otherwise(
        F.concat(F.lit(" [S: "), given(s), F.lit(" vs T: "), given(t), F.lit("]")))
    sentence = F.concat(place, F.lit(" — "), F.col("message"), F.lit("."), values)
    return findings.where(F.col("severity").isin(*keep)).select(
        "pair_id", "severity", severity_rank().alias("rank"), "category", sentence.alias("review"))


def pair_verdicts(counters: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """A short text per pair from its counters; rules are (column, label)."""
    parts = F.filter(
        F.array(*[F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(f" {label}"))) for c, label in rules]),
        lambda p: p.isNotNull())
    verdict = F.concat_ws(", ", parts)
    return counters.withColumn("verdict", F.when(F.size(parts) == 0, "OK").otherwise(verdict))


def status_summary(parts: dict[str, DataFrame]) -> DataFrame:
    """All tiers in one list."""
    out = None
    for tier, results in parts.items():
        rows = results.select(
            F.lit(tier).alias("tier"), "pair_id", "status", "fidelity_score",
            F.when(F.col("promote"), "3_final").otherwise("1_initial").alias("stage"),
            F.concat_ws("; ", "blockers").alias("notes"))
        out = rows if out is None else out.unionByName(rows)
    return out


def config_snapshot(spark: SparkSession, tier: Tier) -> DataFrame:
    """The rules of a run, to be stored beside its results."""
    return spark.createDataFrame(
        [(tier.name, k, v) for k, v in tier.as_rows()], "tier string, setting string, value string")


# --- audit ----------------------------------------------------------------------------

# Who did a step, and whether it happened -> status text.
STATUS_TEXT = {
    "MANUAL/DONE": "Done by a person", "MANUAL/PENDING": "WAITING ON A PERSON",
    "MANUAL/FAILED": "Person attempted, failed", "PIPELINE/DONE": "Ran in the pipeline",
    "PIPELINE/PENDING": "PIPELINE NOT RUN", "PIPELINE/FAILED": "PIPELINE STEP FAILED",
    "SCRIPT/DONE": "Ran as a separate script", "SCRIPT/PENDING": "SEPARATE SCRIPT NOT RUN",
    "SCRIPT/FAILED": "SEPARATE SCRIPT FAILED", "NOT_IMPLEMENTED/N/A": "Not implemented",
}
ARTIFACTS = ("source", "binary", "export", "preprocessed", "report", "summary", "mapping", "final")


def artifact_facts(artifacts: DataFrame) -> DataFrame:
    """One row per model: when each kind of artifact was last written.

    artifacts (model, suffix, artifact, modified, bytes), e.g. from a file listing.
    """
    when = [
        F.max(F.when(F.col("artifact") == a, F.col("modified").cast("timestamp"))).alias(f"{a}_when")
        for a in ARTIFACTS
    ]
    facts = artifacts.groupBy("model", "suffix").agg(*when)
    hours = (F.unix_micros("source_when") - F.unix_micros("export_when")) / F.lit(3600000000.0)
    return facts.withColumn("stale_hours", F.round(hours, 2))


def audit_steps(facts: DataFrame, results: DataFrame, inventory: DataFrame) -> DataFrame:
    """The ordered steps of each model: who, whether, and what it means.

    results (model, status, critical, promote), inventory (model, comments,
    definitions, notes, t_definitions).
    """
    df = facts.join(results, "model", "left").join(inventory, "model", "left").fillna(
        0, subset=["comments", "definitions", "notes", "t_definitions"])

    def has(a):
        return F.col(f"{a}_when").isNotNull()

    physical = F.col("suffix") == ".pdm"
    compared = F.col("status").isNotNull()

    def outcome(*arms, default):
        out = None
        for cond, label in arms:
            out = F.when(cond, label) if out is None else out.when(cond, label)
        return F.lit(default) if out is None else out.otherwise(default)

    def text_step(count, arrived):
        return outcome((F.col(count) == 0, "N/A"), (has("preprocessed") & (F.col(arrived) > 0), "DONE"), default="PENDING")

    passed = (F.col("status") == "PASS") & (F.col("critical") == 0)
    steps = [
        ("Author source model", "Source", "MANUAL", F.lit("DONE"), None),
        ("Extract properties", "A", "NOT_IMPLEMENTED", F.lit("N/A"), None),
        ("Import into target tool", "B", "MANUAL", outcome((has("binary"), "DONE"), default="PENDING"), None),
        ("Export target XML", "B", "MANUAL", outcome((has("export"), "DONE"), default="PENDING"), None),
        ("Import gate", "B", "PIPELINE", outcome((has("export"), "DONE"), default="FAILED"), None),
        ("Comments to notes", "C", "PIPELINE", text_step("comments", "notes"), ~physical),
        ("Definitions to definitions", "C", "PIPELINE", text_step("definitions", "t_definitions"), ~physical),
        ("Inject properties", "C", "NOT_IMPLEMENTED", F.lit("N/A"), ~physical),
        ("Reconcile", "D", "PIPELINE",
         outcome((compared, "DONE"), (has("export"), "PENDING"), default="N/A"), None),
        ("Remediate", "C", "PIPELINE",
         outcome((has("preprocessed"), "DONE"), (F.coalesce("promote", F.lit(False)), "N/A"), (has("export"), "PENDING"), default="N/A"), physical),
        ("Reconcile again", "D", "PIPELINE",
         outcome((~has("preprocessed"), "N/A"), (compared, "DONE"), default="PENDING"), physical),
        ("Validation report", "Reporting", "PIPELINE", outcome((has("report"), "DONE"), default="PENDING"), None),
        ("Status summary", "Reporting", "PIPELINE", outcome((has("summary"), "DONE"), default="PENDING"), None),
        ("Field mapping report", "Reporting", "SCRIPT", outcome((has("mapping"), "DONE"), default="PENDING"), None),
        ("Audit", "Reporting", "SCRIPT", F.lit("DONE"), None),
        ("Promote", "Gate", "PIPELINE",
         outcome((has("final"), "DONE"), (F.coalesce(passed, F.lit(False)) & ~physical, "PENDING"), default="N/A"), None),
    ]
    structs = []
    for i, (step, phase, who, what, only) in enumerate(steps, start=1):
        s = F.struct(F.lit(i).alias("seq"), F.lit(step).alias("step"), F.lit(phase).alias("phase"),
                     F.lit(who).alias("provenance"), what.alias("outcome"))
        structs.append(s if only is None else F.when(only, s))
    rows = df.select("model", "suffix", F.explode(F.filter(F.array(*structs), lambda x: x.isNotNull())).alias("s")).select(
        "model", "suffix", "s.*")
    from ..functions.types import lookup

    label = F.concat_ws("/", "provenance", "outcome")
    return rows.withColumn("status_text", F.coalesce(lookup(STATUS_TEXT, label), F.lit("Not applicable")))


def audit_blockers(steps: DataFrame) -> DataFrame:
    return steps.where("outcome in ('PENDING', 'FAILED')")


def audit_counts(steps: DataFrame) -> DataFrame:
    return steps.groupBy("provenance", "outcome").agg(F.count("*").alias("steps"))
