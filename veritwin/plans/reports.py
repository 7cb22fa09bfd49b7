"""Tables behind the reports: fleet, worst pairs, categories, matrices, ranks, complexity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.matching import count_when
from ..operators.ordered import number_within
from .findings import severity_rank

ORDER = ["category", "object_name", "member", "message", "s_value", "t_value"]


def fleet_dashboard(results: DataFrame) -> DataFrame:
    """One row for the whole fleet."""
    status = F.col("status")
    return results.agg(
        F.count("*").alias("pairs"),
        *[count_when(status == s).alias(s.lower()) for s in ("PASS", "WARN", "FAIL", "ERROR")],
        F.round(F.avg(F.col("fidelity_score").cast("decimal(9,2)")), 4).cast("double").alias("average_score"),
        count_when(F.col("needs_review")).alias("needs_review"),
        count_when(F.col("promote")).alias("promoted"),
        count_when(~F.col("promote")).alias("held"),
        F.sum("critical").alias("critical"), F.sum("warning").alias("warning"), F.sum("info").alias("info"),
        F.sum("objects_s").alias("objects_compared"))


def worst_pairs(results: DataFrame, n: int) -> DataFrame:
    """Lowest score first, then most critical findings."""
    return results.orderBy(F.asc("fidelity_score"), F.desc("critical"), F.asc("pair_id")).limit(n)


def category_analysis(findings: DataFrame) -> DataFrame:
    severity = F.col("severity")
    return findings.groupBy("category").agg(
        *[count_when(severity == s).alias(s.lower()) for s in ("CRITICAL", "WARNING", "INFO", "VERIFIED")],
        F.count("*").alias("total"), F.countDistinct("pair_id").alias("pairs"))


def summary_with_totals(results: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Rows per pair and one TOTAL row with the average score."""
    rolled = results.rollup("pair_id").agg(
        F.grouping("pair_id").alias("_total"), *[F.sum(c).alias(c) for c in sums],
        F.round(F.avg(F.col("fidelity_score").cast("decimal(9,2)")), 2).cast("double").alias("fidelity_score"))
    return rolled.withColumn("pair_id", F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("pair_id"))).drop("_total")


def object_matrix(objects: DataFrame, children: DataFrame, findings: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per object: status, child counts, and its findings by severity.

    objects (key…, status, …), children (key…, status), findings (key…, severity).
    """
    key = list(key)
    status, severity = F.col("status"), F.col("severity")
    kids = children.groupBy(*key).agg(
        count_when(status != "EXTRA").alias("children_s"), count_when(status != "MISSING").alias("children_t"),
        count_when(status == "MATCHED").alias("children_matched"),
        count_when(status == "MISSING").alias("children_missing"),
        count_when(status == "EXTRA").alias("children_extra"))
    marks = findings.groupBy(*key).agg(
        *[count_when(severity == s).alias(s.lower()) for s in ("CRITICAL", "WARNING", "INFO")])
    joined = objects.join(kids, key, "left").join(marks, key, "left")
    numbers = [c for c in kids.columns + marks.columns if c not in key]
    return joined.fillna(0, subset=numbers)


def top_findings(findings: DataFrame, room: int) -> DataFrame:
    """All findings with their ``rank`` in the pair, worst first, and ``omitted`` for a sheet with ``room`` rows.

    Critical, warning and error rows are never omitted; context rows are once the room is used up. No
    row is dropped: a sheet writer filters, and the number left out is a count.
    """
    kept_always = F.col("severity").isin("CRITICAL", "WARNING", "ERROR")
    ranked = number_within(findings.withColumn("_severity", severity_rank()), ["pair_id"], ["_severity", *ORDER], "rank")
    return ranked.drop("_severity").withColumn("omitted", ~kept_always & (F.col("rank") > room))


def ranked_exceptions(rows: DataFrame, examples: int) -> DataFrame:
    """All rows with their ``rank`` in (severity, category), the size of that group, and whether they are an example."""
    group = ["severity", "category"]
    others = [c for c in rows.columns if c not in group]
    ranked = number_within(rows, group, others, "rank")
    sizes = rows.groupBy(*group).agg(F.count("*").alias("rows_in_category"))
    return ranked.join(sizes, group).withColumn("example", F.col("rank") <= examples)


# --- complexity -----------------------------------------------------------------------

# Band -> label, lowest and highest share of automation, effort factor.
BANDS = {
    "B1": ("Very Simple", 85, 95, 1.0),
    "B2": ("Simple", 70, 85, 1.5),
    "B3": ("Medium", 50, 70, 2.5),
    "B4": ("High / Very High", 20, 50, 4.0),
}

# Counts a model census must carry, one row per pair; missing ones are 0.
CENSUS = (
    "entities", "attributes", "relationships", "relationship_joins", "identifiers", "inheritances",
    "inheritance_links", "diagrams", "entities_with_comment", "attributes_with_comment",
    "entities_without_identifier", "attributes_untyped", "identifiers_primary", "shortcuts",
    "extension_definitions", "extension_containers", "extension_properties", "extension_values",
    "templates", "validation_rules", "exclusive_inheritances", "external_glossaries", "domains",
    "glossary_enforced", "has_physical_layer",
)


def complexity_signals(objects: DataFrame, pairs: Sequence[str] = ("pair_id",)) -> DataFrame:
    """Census of a model from its objects (pair_id, kind, flags as MAP<STRING,BOOLEAN>).

    Every kind is counted once, and every flag once per kind, in one aggregation.
    """
    kinds = {
        "entities": "ENTITY", "attributes": "ATTRIBUTE", "relationships": "RELATIONSHIP",
        "relationship_joins": "RELATIONSHIP_JOIN", "identifiers": "IDENTIFIER", "inheritances": "INHERITANCE",
        "inheritance_links": "INHERITANCE_LINK", "diagrams": "DIAGRAM", "shortcuts": "SHORTCUT",
        "extension_definitions": "EXTENSION", "extension_values": "EXTENSION_VALUE", "templates": "TEMPLATE",
        "validation_rules": "VALIDATION_RULE", "external_glossaries": "GLOSSARY", "domains": "DOMAIN",
    }
    flags = {
        "entities_with_comment": ("ENTITY", "comment"), "attributes_with_comment": ("ATTRIBUTE", "comment"),
        "entities_without_identifier": ("ENTITY", "no_identifier"), "attributes_untyped": ("ATTRIBUTE", "untyped"),
        "identifiers_primary": ("IDENTIFIER", "primary"), "exclusive_inheritances": ("INHERITANCE", "exclusive"),
        "glossary_enforced": ("MODEL", "glossary_enforced"), "has_physical_layer": ("MODEL", "physical"),
    }
    kind = F.col("kind")
    counts = [count_when(kind == k).alias(n) for n, k in kinds.items()]
    marked = [count_when((kind == k) & F.coalesce(F.try_element_at("flags", F.lit(f)), F.lit(False))).alias(n)
              for n, (k, f) in flags.items()]
    names = [
        F.countDistinct(F.when(kind == "EXTENSION_VALUE", F.col("path"))).alias("extension_properties"),
        F.countDistinct(F.when(kind == "EXTENSION_VALUE", F.substring_index("path", ".", 1))).alias("extension_containers"),
    ]
    return objects.groupBy(*pairs).agg(*counts, *marked, *names)


def complexity_band(census: DataFrame) -> DataFrame:
    """Each rule can force a band; the highest one counts, with the rules as evidence."""
    def positive(c):
        return F.col(c) > 0

    undefined = F.col("entities") - F.col("entities_with_comment")
    share = F.lit(100.0) * undefined / F.greatest(F.col("entities"), F.lit(1))
    rules = [
        ("B4", positive("extension_definitions"), "EXTENSIONS"),
        ("B4", positive("templates"), "TEMPLATES"),
        ("B4", positive("exclusive_inheritances"), "EXCLUSIVE_INHERITANCE"),
        ("B4", positive("validation_rules"), "VALIDATION_RULES"),
        ("B3", positive("glossary_enforced") & positive("external_glossaries"), "GLOSSARY"),
        ("B3", positive("inheritances"), "INHERITANCE"),
        ("B3", share > 10, "MISSING_DEFINITIONS"),
        ("B2", ~positive("has_physical_layer"), "NO_PHYSICAL_LAYER"),
    ]
    fired = F.filter(
        F.array(*[F.when(cond, F.concat(F.lit(f"{band}:"), F.lit(name))) for band, cond, name in rules]),
        lambda r: r.isNotNull())
    band = F.coalesce(F.left(F.array_max("evidence"), F.lit(2)), F.lit("B1"))
    out = census.withColumn("evidence", fired).withColumn("band", band)

    def of(i):
        expr = F.lit(None)
        for name, values in BANDS.items():
            expr = F.when(F.col("band") == name, F.lit(values[i])).otherwise(expr)
        return expr

    return out.withColumns({"band_label": of(0), "automation_low": of(1), "automation_high": of(2), "multiplier": of(3)})


def automation_coverage(census: DataFrame) -> DataFrame:
    """Facts delivered, reapplied, left to people, lost; and two percentages."""
    def total(*names) -> Column:
        out = F.lit(0)
        for n in names:
            out = out + F.col(n)
        return out

    delivered = total(
        "entities", "attributes", "relationships", "relationship_joins", "identifiers", "inheritances", "diagrams",
        "entities_with_comment", "attributes_with_comment")
    out = census.withColumns({
        "delivered": delivered, "reapplied": total("extension_values", "exclusive_inheritances"),
        "manual": F.col("templates") + F.when(F.col("entities_without_identifier") > 0, 1).otherwise(0),
        "lost": F.col("shortcuts")})
    out = out.withColumn("facts", total("delivered", "reapplied", "manual", "lost"))

    def percent(value):
        return F.when(F.col("facts") == 0, 0.0).otherwise(F.round(F.lit(100.0) * value / F.col("facts"), 1))

    return out.withColumns({
        "delivered_pct": percent(F.col("delivered")),
        "automated_pct": percent(F.col("delivered") + F.col("reapplied"))})


def non_equivalence_register(census: DataFrame) -> DataFrame:
    """What becomes of each construct of a model, with its volume."""
    def n(c):
        return F.col(c).cast("string")

    rows = [
        ("Objects", F.concat_ws(" / ", n("entities"), n("attributes"), n("relationships"), n("identifiers")), "DELIVERED", "IN_SCOPE"),
        ("Definitions", F.concat_ws(" / ", n("entities_with_comment"), n("attributes_with_comment")), "DELIVERED", "VERIFY"),
        ("Diagrams", n("diagrams"), "PARTIAL", "IN_SCOPE"),
        ("Extension properties", F.concat_ws(" / ", n("extension_properties"), n("extension_values")), "NOT_DELIVERED", "AUTOMATION"),
        ("Inheritance flags", n("exclusive_inheritances"), "DROPPED", "AUTOMATION"),
        ("Glossary bindings", n("shortcuts"), "NOT_DELIVERED", "NOT_RECOVERABLE"),
        ("Templates", n("templates"), "NOT_DELIVERED", "NOT_RECOVERABLE"),
        ("Version history", F.lit(""), "NOT_DELIVERED", "OUT_OF_SCOPE"),
        ("Primary identifiers", F.concat_ws(" / ", n("identifiers_primary"), n("identifiers"), n("entities_without_identifier")), "DELIVERED", "SOURCE_CONDITION"),
        ("Untyped attributes", n("attributes_untyped"), "DELIVERED", "SOURCE_CONDITION"),
    ]
    structs = [
        F.struct(F.lit(c).alias("construct"), v.alias("volume"), F.lit(b).alias("bridge"), F.lit(d).alias("disposition"))
        for c, v, b, d in rows
    ]
    domains = F.when(F.col("domains") == 0, F.struct(
        F.lit("Domains").alias("construct"), F.lit("0").alias("volume"), F.lit("NONE").alias("bridge"),
        F.lit("NOT_APPLICABLE").alias("disposition")))
    every = F.filter(F.array(*structs, domains), lambda r: r.isNotNull())
    return census.select("pair_id", F.explode(every).alias("r")).select("pair_id", "r.*")


def top_contributors(log: DataFrame, n: int, by: Sequence[str] = ("pair_id",), who: str = "who") -> DataFrame:
    """The ``n`` most frequent names per model as one text; ties by name."""
    by = list(by)
    counts = log.groupBy(*by, F.col(who).cast("string").alias("who")).agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("n"), F.asc("who")))
    best = counts.withColumn("_rank", rank).where(F.col("_rank") <= n)
    shown = F.struct("_rank", F.concat("who", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("t"))
    listed = F.transform(F.array_sort(F.collect_list(shown)), lambda x: x["t"])
    return best.groupBy(*by).agg(F.array_join(listed, ", ").alias("contributors"))


def timing_rollup(records: DataFrame) -> DataFrame:
    """Latest timing run: per scenario total, average, and the cost of one at a time.

    records (run, scenarios ARRAY<STRUCT<size, end_to_end_s, per_model_avg_s>>).
    """
    latest = records.groupBy().agg(F.max_by(F.struct("run", "scenarios"), "run").alias("r"))
    scenario = latest.select("r.run", F.posexplode("r.scenarios").alias("pos", "s"), F.element_at("r.scenarios", 1).alias("one"))
    alone = F.round(F.col("one.end_to_end_s") * F.col("s.size"), 1)
    return scenario.select(
        "run", "pos", F.col("s.size").alias("models"), F.col("s.end_to_end_s").alias("total_s"),
        F.col("s.per_model_avg_s").alias("per_model_s"), alone.alias("one_at_a_time_s"))


def timing_records(log: DataFrame) -> DataFrame:
    """Timing log rows (run, size, end_to_end_s) -> one nested record per run."""
    scenario = F.struct("size", "end_to_end_s", F.round(F.col("end_to_end_s") / F.col("size"), 3).alias("per_model_avg_s"))
    return log.groupBy("run").agg(F.array_sort(F.collect_list(scenario)).alias("scenarios"))
