"""Cardinality spellings, and the identity of a relationship without columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import compare_key, normalize_name, text, trim_ws
from .types import lookup

# Spelling -> canonical form.
SPELLINGS = {
    "0,1": "0,1", "1,1": "1,1", "0,n": "0,n", "1,n": "1,n",
    "0..1": "0,1", "1..1": "1,1", "0..n": "0,n", "1..n": "1,n",
    "0..*": "0,n", "1..*": "1,n", "*": "0,n",
    "zero, one or more": "0,n", "zero one or more": "0,n", "zeroonemore": "0,n",
    "zeroormore": "0,n", "zero or more": "0,n",
    "one or more": "1,n", "one or more (p)": "1,n", "oneormore": "1,n", "p": "1,n",
    "zero or one": "0,1", "zero or one (z)": "0,1", "zeroorone": "0,1", "z": "0,1",
    "one": "1,1", "exactly one": "1,1", "exactlyone": "1,1",
    "many": "0,n", "many to many": "0,n", "optional": "0,1", "mandatory": "1,1",
}

# Words that carry a bound.
MANY_WORDS = ("more", "many", "n", "m")
ZERO_WORDS = ("zero", "optional", "most")
BOUND_WORDS = MANY_WORDS + ZERO_WORDS + ("one", "exactly", "mandatory", "or", "least")

# Numeric codes of the target export.
CARDINALITY_CODES = {"-3": "0,n", "-2": "0,n", "-1": "0,1"}
RELATIONSHIP_TYPES = {"2": "IDENTIFYING", "7": "NON_IDENTIFYING", "4": "MANY_TO_MANY", "9": "SUBTYPE"}
# Whether nulls are allowed, as a relationship states it and as an attribute states it.
RELATIONSHIP_NULLS = {"101": "false", "100": "true"}
ATTRIBUTE_NULLS = {"1": "false", "0": "true"}
# Words for a mandatory attribute.
NOT_NULL_TOKENS = ("not null", "notnull", "nn", "mandatory", "required", "no nulls", "1", "true", "yes")
# Whether a physical column is NOT NULL.
PHYSICAL_NOT_NULL = {"1": "true", "0": "false", "2": "false"}

DESCRIPTIONS = {
    "0,1": "0,1 (optional, one)", "1,1": "1,1 (mandatory, one)",
    "0,n": "0,n (optional, many)", "1,n": "1,n (mandatory, many)",
}


def normalize_cardinality(raw: str | Column, mandatory: Column = None, many: Column = None) -> Column:
    """Any spelling -> 0,1 | 1,1 | 0,n | 1,n, else from the flags, else ''.

    The order of the steps is part of the meaning: known spellings, "exactly n",
    punctuation variants, English phrases, numeric pairs, flags.
    """
    token = F.lower(trim_ws(raw))
    exact = F.regexp_extract(token, r"^exactly\s*(\d+)$", 1)
    compact = F.regexp_replace(token, r"[\s()\[\]]", "")
    compact = F.regexp_replace(compact, r"(?<=[0-9A-Za-z*])-(?=[0-9A-Za-z*])", ",")
    compact = F.replace(compact, F.lit(".."), F.lit(","))

    words = F.regexp_extract_all(token, F.lit("([a-z]+)"), F.lit(1))

    def has(names):
        return F.arrays_overlap(words, F.array(*[F.lit(w) for w in names]))

    phrase = F.concat(
        F.when(has(ZERO_WORDS), "0").otherwise("1"),
        F.lit(","),
        F.when(has(MANY_WORDS) | F.contains(token, F.lit("*")), "n").otherwise("1"),
    )
    parts = F.split(compact, ",")
    pair = F.concat(
        F.when(F.get(parts, F.lit(0)).isin("1", "one"), "1").otherwise("0"),
        F.lit(","),
        F.when(F.get(parts, F.lit(1)).isin("n", "m", "*", "many", "more"), "n").otherwise("1"),
    )
    if mandatory is None and many is None:
        fallback = F.lit("")
    else:
        low = F.coalesce(mandatory, F.lit(False)) if mandatory is not None else F.lit(False)
        high = F.coalesce(many, F.lit(False)) if many is not None else F.lit(False)
        stated = F.lit(False)
        for flag in (mandatory, many):
            if flag is not None:
                stated = stated | flag.isNotNull()
        fallback = F.when(
            stated,
            F.concat(F.when(low, "1").otherwise("0"), F.lit(","), F.when(high, "n").otherwise("1")),
        ).otherwise("")
    return F.coalesce(
        lookup(SPELLINGS, token),
        F.when(exact != "", F.when(exact == "1", "1,1").otherwise("1,n")),
        lookup(SPELLINGS, compact),
        F.when(has(BOUND_WORDS), phrase),
        F.when((F.size(parts) == 2) & compact.rlike(r"[\d*]"), pair),
        fallback,
    )


def resolve_enum(c: str | Column, codes: dict[str, str]) -> Column:
    """struct(value, recognised): numeric code -> meaning, unknown codes kept as they are."""
    raw = trim_ws(c)
    found = lookup(codes, raw)
    return F.struct(
        F.coalesce(found, raw).alias("value"),
        (found.isNotNull() | (raw == "")).alias("recognised"),
    )


def children_per_parent(c: str | Column) -> Column:
    """The target's code for children per parent: a known code, a number of children, a spelling; blank is 0,n."""
    raw = trim_ws(c)
    number = F.when(raw.rlike("^[0-9]+$"), F.when(raw.rlike("^0*1?$"), "1,1").otherwise("1,n"))
    spelled = normalize_cardinality(raw, F.lit(False), F.lit(True))
    return F.coalesce(lookup(CARDINALITY_CODES, raw), number, F.nullif(spelled, F.lit("")), F.lit("0,n"))


def canonical_ends(rel: DataFrame, *ends: str) -> DataFrame:
    """Relationship rows with canonical cardinalities, folded once per row.

    All functions below read canonical values, so they stay small expressions.
    """
    for end in ends or ("end1", "end2"):
        rel = rel.withColumn(
            end, F.col(end).withField("cardinality", normalize_cardinality(F.col(f"{end}.cardinality"))))
    return rel


def is_mandatory(c: str | Column) -> Column:
    """Lower bound is 1; of a canonical cardinality."""
    return text(c).startswith("1")


def is_many(c: str | Column) -> Column:
    return text(c).endswith("n")


def describe_cardinality(c: str | Column) -> Column:
    return F.coalesce(lookup(DESCRIPTIONS, text(c)), F.lit("(not stated)"))


def degree(card1: str | Column, card2: str | Column) -> Column:
    one, two = is_many(card1), is_many(card2)
    return F.when(one & two, "M:N").when(one, "1:N").when(two, "N:1").otherwise("1:1")


def invert_degree(c: Column) -> Column:
    return F.when(c == "1:N", "N:1").when(c == "N:1", "1:N").otherwise(c)


# A relationship row has name, code, kind and end1/end2 structs
# (entity, role, cardinality, mandatory, dependent), cardinality canonical.


def _swapped(end1: Column, end2: Column) -> Column:
    return compare_key(end1["entity"]) > compare_key(end2["entity"])


def name_signature(name: Column, code: Column) -> Column:
    """Normalised code or name, without the /1, /2 suffix of a repeated name."""
    label = F.when(text(code) != "", text(code)).otherwise(text(name))
    return normalize_name(F.regexp_replace(trim_ws(label), r"/\d+$", ""))


def with_signatures(rel: DataFrame) -> DataFrame:
    """Adds name_key, name_ends_key, full_key, ends_key; each entity is normalised once."""
    one, two = F.col("end1"), F.col("end2")
    df = rel.withColumns({
        "_k1": normalize_name(one["entity"]), "_k2": normalize_name(two["entity"]), "_swap": _swapped(one, two),
        "name_key": name_signature(F.col("name"), F.col("code"))})

    def stated(e):
        return F.when(text(e["cardinality"]) == "", "?").otherwise(e["cardinality"])

    def joined(a, b):
        return F.when(F.col("_swap"), F.concat(b, F.lit("::"), a)).otherwise(F.concat(a, F.lit("::"), b))

    full = [F.concat(F.col(k), F.lit("["), stated(e), F.lit("]")) for k, e in (("_k1", one), ("_k2", two))]
    df = df.withColumns({"ends_key": joined(F.col("_k1"), F.col("_k2")), "full_key": joined(*full)})
    return df.withColumn("name_ends_key", F.concat("name_key", F.lit("##"), "ends_key")).drop("_k1", "_k2", "_swap")


def ends_aligned(s1: Column, s2: Column, t1: Column, t2: Column) -> Column:
    """True when both sides list their ends in the same order."""
    loop = (compare_key(s1["entity"]) == compare_key(s2["entity"])) | (
        compare_key(t1["entity"]) == compare_key(t2["entity"])
    )

    def mirrored(a1, a2, b1, b2):
        return (a1 != a2) & (a1 == b2) & (a2 == b1)

    sm1, sm2 = is_many(s1["cardinality"]), is_many(s2["cardinality"])
    tm1, tm2 = is_many(t1["cardinality"]), is_many(t2["cardinality"])
    sr1, sr2 = text(s1["role"]) != "", text(s2["role"]) != ""
    tr1, tr2 = text(t1["role"]) != "", text(t2["role"]) != ""
    by_shape = (
        F.when(mirrored(sm1, sm2, tm1, tm2), F.lit(False))
        .when((sm1 == tm1) & (sm2 == tm2) & (sm1 != sm2), F.lit(True))
        .otherwise(~mirrored(sr1, sr2, tr1, tr2))
    )
    return F.when(loop, by_shape).otherwise(_swapped(s1, s2) == _swapped(t1, t2))


def describe_relationship(end1: Column, end2: Column) -> Column:
    def card(e):
        c = text(e["cardinality"])
        return F.when(c == "", "?").otherwise(c)

    def role(e):
        return F.when(text(e["role"]) == "", "relates to").otherwise(e["role"])

    return F.concat(
        end1["entity"], F.lit(" ("), card(end1), F.lit(") "), role(end1), F.lit(" → ("),
        card(end2), F.lit(") "), role(end2), F.lit(" "), end2["entity"], F.lit(" ["),
        degree(end1["cardinality"], end2["cardinality"]), F.lit("]"),
    )


def relationship_label(name: Column, code: Column, end1: Column, end2: Column) -> Column:
    pair = F.concat(end1["entity"], F.lit(" ↔ "), end2["entity"])
    given = F.when(text(name) != "", text(name)).otherwise(text(code))
    return F.when(given == "", pair).otherwise(F.concat(given, F.lit(" ("), pair, F.lit(")")))
