"""From findings and counts to score, status, identities and gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Tier
from ..operators.matching import count_when

SEVERITIES = ("CRITICAL", "WARNING", "INFO")


def severity_counts(findings: DataFrame, by: Sequence[str] = ("pair_id",)) -> DataFrame:
    return findings.groupBy(*by).agg(
        *[count_when(F.col("severity") == s).alias(s.lower()) for s in SEVERITIES]
    )


def count_by_status(rows: DataFrame, kind: str, by: Sequence[str] = ("pair_id",)) -> DataFrame:
    """S, T, matched, missing, extra of one object kind from rows with a ``status``."""
    status = F.col("status")
    return rows.groupBy(*by).agg(
        count_when(status != "EXTRA").alias(f"{kind}_s"),
        count_when(status != "MISSING").alias(f"{kind}_t"),
        count_when(status == "MATCHED").alias(f"{kind}_matched"),
        count_when(status == "MISSING").alias(f"{kind}_missing"),
        count_when(status == "EXTRA").alias(f"{kind}_extra"),
    )


def join_counts(pairs: DataFrame, parts: Sequence[DataFrame], by: Sequence[str] = ("pair_id",)) -> DataFrame:
    """One row per pair with every count, 0 where a part has none."""
    out = pairs.select(*by).distinct()
    for part in parts:
        out = out.join(part, list(by), "left")
    counts = [c for c in out.columns if c not in by]
    return out.fillna(0, subset=counts)


def penalty(tier: Tier) -> Column:
    total = F.lit(0).cast("decimal(38,6)")
    for s in SEVERITIES:
        weight = F.lit(str(tier.weights[s])).cast("decimal(9,4)")
        total = total + F.col(s.lower()).cast("decimal(20,0)") * weight
    return total.cast("decimal(38,6)")


def fidelity_score(counters: DataFrame, tier: Tier, objects: Column, error: Column | None = None) -> DataFrame:
    """Raw and rounded score, review flag and status.

    ``objects`` counts the comparable S objects. The penalty is capped per
    object, so the score keeps its order; decimals make it exact.
    """
    failed = F.lit(False) if error is None else F.coalesce(error, F.lit(False))
    n = F.greatest(objects, F.lit(1)).cast("decimal(20,0)")
    ceiling = n * F.lit(str(tier.max_penalty_per_object)).cast("decimal(9,4)")
    capped = F.least(penalty(tier), ceiling.cast("decimal(38,6)"))
    raw = F.lit(100).cast("decimal(5,2)") - (
        F.lit(100).cast("decimal(5,2)") * capped.cast("decimal(24,6)") / n.cast("decimal(12,0)")
    )
    scored = counters.withColumn(
        "fidelity_score_raw", F.when(failed, F.lit(0)).otherwise(raw).cast("decimal(18,10)")
    )
    scored = scored.withColumn("fidelity_score", F.round("fidelity_score_raw", 2).cast("double"))
    return (
        scored.withColumn("fidelity_score_raw", F.col("fidelity_score_raw").cast("double"))
        .withColumn("needs_review", failed | (F.col("fidelity_score") < tier.review_threshold))
        .withColumn("status", pair_status(failed))
    )


def pair_status(error: Column) -> Column:
    return (
        F.when(error, "ERROR").when(F.col("critical") > 0, "FAIL").when(F.col("warning") > 0, "WARN")
        .otherwise("PASS")
    )


def count_identities(counters: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Adds ``broken``: the totals that are not the sum of their parts, or not known to be."""
    names = set(counters.columns)

    def part(name):
        return F.col(name) if name in names else F.lit(0)

    checks = []
    for kind in kinds:
        for side, other in (("s", "missing"), ("t", "extra")):
            parts = part(f"{kind}_matched") + part(f"{kind}_{other}") + part(f"{kind}_duplicate_{side}")
            checks.append(F.when(~F.coalesce(F.col(f"{kind}_{side}") == parts, F.lit(False)), F.lit(f"{kind}_{side}")))
    return counters.withColumn("broken", F.filter(F.array(*checks), lambda c: c.isNotNull()))


def gate(results: DataFrame, target: float = 100.0, strict: bool = True) -> DataFrame:
    """Adds ``blockers`` (why a pair must not be promoted) and ``promote``.

    ``strict`` also blocks on warnings, on the raw score and on broken counts;
    otherwise a pair passes with status PASS and no critical finding.
    """
    error = F.col("status") == "ERROR"

    def why(cond, label):
        return F.when(cond & ~error, label)

    reasons = [F.when(error, "ERROR"), why(F.col("critical") > 0, "CRITICAL_FINDINGS")]
    if strict:
        reasons.append(why(F.col("warning") > 0, "WARNINGS_UNSIGNED"))
        reasons.append(why(F.col("fidelity_score_raw") < target, "BELOW_TARGET"))
        if "broken" in results.columns:
            reasons.append(why(F.size("broken") > 0, "COUNTS_DO_NOT_ADD_UP"))
    else:
        reasons.append(why(F.col("status") != "PASS", "NOT_PASSED"))
    blockers = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    return results.withColumn("blockers", blockers).withColumn("promote", F.size("blockers") == 0)
