"""Findings: one row per difference, and the severity policy applied to them.

A comparison builds an array of optional findings per row and explodes it, so a
matched pair is read once however many checks look at it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SEVERITY_RANK, Tier
from ..functions.text import ABSENT, text
from ..functions.types import lookup

FIELDS = ["category", "severity", "object_type", "object_name", "member", "message", "s_value", "t_value"]

REMEDIES = {
    "ENTITY_MISSING": "Create the entity on the target side or record why it was dropped.",
    "ENTITY_EXTRA": "Add the entity to the source or remove it from the target.",
    "ATTRIBUTE_MISSING": "Add the attribute to the target entity.",
    "ATTRIBUTE_EXTRA": "Remove the attribute or add it to the source.",
    "PRIMARY_IDENTIFIER": "Align the members of the primary key.",
    "ALTERNATE_IDENTIFIER": "Align the alternate key.",
    "RELATIONSHIP_MISSING": "Recreate the relationship with the same ends and cardinality.",
    "RELATIONSHIP_EXTRA": "Add the relationship to the source or remove it.",
    "CARDINALITY": "Correct the cardinality of the target.",
    "OPTIONALITY": "Restore the participation rule.",
    "DEPENDENCY": "Switch between identifying and non-identifying.",
    "ROLE_NAME": "Restore the verb phrase.",
    "DATA_TYPE": "Assign the type the source states.",
    "DATA_TYPE_LENGTH": "Match the declared size.",
    "LENGTH_PRECISION": "Match the declared size.",
    "MANDATORY": "Match the mandatory flag.",
    "BUSINESS_NAME": "Align the business name.",
    "DEFINITION_LOSS": "Copy the definition to the target.",
    "DEFINITION": "Reconcile the wording.",
    "DOMAIN": "Attach the equivalent domain.",
    "FALLBACK_MATCH": "Confirm that the rename was intended.",
    "TABLE_MISSING": "Create the table in the target.",
    "COLUMN_MISSING": "Add the column to the target table.",
    "PRIMARY_KEY": "Restore the primary key columns.",
    "FOREIGN_KEY_MISSING": "Recreate the reference.",
    "INHERITANCE_MISSING": "Recreate the hierarchy.",
    "INHERITANCE_STRUCTURE": "Attach the missing subtypes.",
}


def check(
    when: Column, category: str | Column, message: str | Column, s_value: Column | str = ABSENT,
    t_value: Column | str = ABSENT, *, object_type: str, object_name: Column, member: Column | str = "",
    severity: str | None = None,
) -> Column:
    """One optional finding: a struct where ``when`` holds, else NULL."""

    def lit(v):
        return F.lit(v) if isinstance(v, str) else v

    return F.when(
        when,
        F.struct(
            lit(category).alias("category"),
            F.lit(severity).cast("string").alias("severity"),
            F.lit(object_type).alias("object_type"),
            text(object_name).alias("object_name"),
            text(lit(member)).alias("member"),
            lit(message).alias("message"),
            text(lit(s_value)).alias("s_value"),
            text(lit(t_value)).alias("t_value"),
        ),
    )


def emit(df: DataFrame, keep: Sequence[str], checks: Sequence[Column]) -> DataFrame:
    """Rows (keep…, finding fields) for every check that fired.

    The checks are exploded first and filtered after: a filter over the array
    would be a lambda, and lambdas leave generated code.
    """
    return df.select(*keep, F.explode(F.array(*checks)).alias("f")).where("f is not null").select(*keep, "f.*")


def or_none(value: Column, label: str = "(none)") -> Column:
    return F.when(text(value) == "", label).otherwise(text(value))


def severity_of(tier: Tier, category: Column, explicit: Column | None = None) -> Column:
    """Explicit severity, else override, else default; IGNORE always wins."""
    table = {**tier.severities, **tier.overrides}
    policy = F.coalesce(lookup(table, category), F.lit(tier.default_severity)) if table else F.lit(
        tier.default_severity
    )
    chosen = policy if explicit is None else F.coalesce(explicit, policy)
    return F.when(policy == "IGNORE", F.lit("IGNORE")).otherwise(chosen)


def apply_severity(findings: DataFrame, tier: Tier) -> DataFrame:
    """Resolve severities, drop what the policy ignores."""
    resolved = findings.withColumn("severity", severity_of(tier, F.col("category"), F.col("severity")))
    return resolved.where("severity <> 'IGNORE'")


def with_remedy(findings: DataFrame) -> DataFrame:
    """Add the recommended action; context rows need none."""
    action = F.coalesce(lookup(REMEDIES, F.col("category")), F.lit("Review the difference."))
    return findings.withColumn(
        "remediation", F.when(F.col("severity") == "VERIFIED", "No action required.").otherwise(action)
    )


def severity_rank(c: Column | str = "severity") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    rank = F.lit(3)
    for name, place in SEVERITY_RANK.items():
        rank = F.when(col == name, place).otherwise(rank)
    return rank
