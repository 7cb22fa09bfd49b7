"""Pairing the objects of two snapshots. Every operator is scoped: rows only
meet inside the same scope columns (the pair, and the parent object)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import compare_key, normalize_name, text, trim_ws
from ..session import cut, stored
from .ordered import fill_forward, keep_one, number_within

Key = tuple[str, Column, Column]


@dataclass(frozen=True)
class Match:
    """pairs(scope…, s_id, t_id, basis), s_only(scope…, s_id), t_only(scope…, t_id)."""

    pairs: DataFrame
    s_only: DataFrame
    t_only: DataFrame


def count_when(cond: Column) -> Column:
    return F.count(F.when(cond, True))


def _both_ways(mates: DataFrame, scope: list[str]) -> DataFrame:
    """(_s, _t) pairs as one row per side: (scope…, _side, _id, _mate)."""
    return mates.select(
        *scope,
        F.inline(
            F.array(
                F.struct(F.lit("S").alias("_side"), F.col("_s").alias("_id"), F.col("_t").alias("_mate")),
                F.struct(F.lit("T").alias("_side"), F.col("_t").alias("_id"), F.col("_s").alias("_mate")),
            )
        ),
    )


def match_ladder(
    s: DataFrame, t: DataFrame, scope: Sequence[str], keys: Sequence[Key], s_id: str = "id", t_id: str = "id"
) -> Match:
    """Match with an ordered list of keys, each weaker than the one before.

    A pass pairs rows that are still unmatched and whose key is unique on both
    sides of the scope; an ambiguous or blank key waits for a later pass. The
    ids must be unique inside their scope, scope columns must not be NULL.

    One pass is one aggregation of narrow rows by (scope, key). It combines
    map-side, so a key shared by a third of all rows shrinks to a few rows
    before the shuffle, and it can never match anyway. Each pass is written to
    the shared folder: later passes and all consumers read it from there. The
    first pass computes its key only; the other keys are computed for the rows
    that it leaves open.
    """
    scope = list(scope)
    names = [f"_k{i}" for i in range(len(keys))]
    from_s = F.col("_side") == "S"
    open_row = F.col("_mate").isNull()

    def unique(rows, name):
        return (
            rows.where(F.col(name) != "")
            .groupBy(*scope, name)
            .agg(
                count_when(from_s).alias("_ns"),
                count_when(~from_s).alias("_nt"),
                F.min(F.when(from_s, F.col("_id"))).alias("_s"),
                F.min(F.when(~from_s, F.col("_id"))).alias("_t"),
            )
            .where("_ns = 1 and _nt = 1")
        )

    def alone(df, id_col, which, out):
        rows = df.select(*scope, F.col(id_col).alias(out), keys[0][which].alias(names[0])).where(F.col(names[0]) != "")
        return rows.groupBy(*scope, names[0]).agg(F.count("*").alias("_n"), F.min(out).alias(out)).where("_n = 1").drop("_n")

    def first(df, side, id_col, which, own, other):
        mates = once.select(*scope, F.col(own).alias("_id"), F.col(other).alias("_mate"))
        later = [F.when(open_row, k[which]).alias(n) for k, n in zip(keys[1:], names[1:])]
        return df.withColumn("_id", F.col(id_col)).join(mates, [*scope, "_id"], "left").select(
            *scope, F.lit(side).alias("_side"), "_id", "_mate", *later)

    # Each side is counted on its own. Where both come from joins on the scope, Spark may take their union for one that is
    # partitioned by it and group without a shuffle, also after a join has become a broadcast one; matches are lost then.
    once = alone(s, s_id, 1, "_s").join(alone(t, t_id, 2, "_t"), [*scope, names[0]])
    found: list[DataFrame] = []
    for name, (basis, _, _) in zip(names, keys):
        if not found:
            state = stored(first(s, "S", s_id, 1, "_s", "_t").unionByName(first(t, "T", t_id, 2, "_t", "_s")), "pass")
        else:
            # Only what later passes read is written: no used key, and no keys of matched rows.
            later = [F.when(open_row, F.col(n)).alias(n) for n in names[names.index(name) + 1:]]
            state = stored(
                rows.join(_both_ways(unique(rows, name), scope), [*scope, "_side", "_id"], "left").select(
                    *scope, "_side", "_id", "_mate", *later), "pass")
        found.append(
            state.where(F.col("_mate").isNotNull() & from_s).select(
                *scope, F.col("_id").alias("s_id"), F.col("_mate").alias("t_id"), F.lit(basis).alias("basis")
            )
        )
        rows = state.where(F.col("_mate").isNull()).drop("_mate")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return Match(
        pairs,
        rows.where(from_s).select(*scope, F.col("_id").alias("s_id")),
        rows.where(~from_s).select(*scope, F.col("_id").alias("t_id")),
    )


def name_code_keys(mode: str = "auto", plurals: bool = True, case_insensitive: bool = True) -> list[Key]:
    """Ladder over ``name`` and ``code``: code, name, normalized or auto."""

    def both(basis, expr):
        return (basis, expr, expr)

    code = both("code", compare_key("code", case_insensitive))
    name = both("name", compare_key("name", case_insensitive))
    norm_name = both("normalized name", normalize_name("name", plurals))
    norm_code = both("normalized code", normalize_name("code", plurals))
    either = F.when(text("code") != "", text("code")).otherwise(text("name"))
    cross = both("name↔code", normalize_name(either, plurals))
    ladders = {"code": [code], "name": [name], "normalized": [norm_name, norm_code]}
    return ladders.get(mode, [code, name, norm_name, norm_code, cross])


def relationship_keys() -> list[Key]:
    """Name, name with endpoints, endpoints with cardinality, endpoints.

    Both sides carry the columns of ``cardinality.with_signatures``.
    """
    columns = [
        ("name", "name_key"), ("name+endpoints", "name_ends_key"), ("endpoints+cardinality", "full_key"), ("endpoints", "ends_key"),
    ]
    return [(basis, F.col(c), F.col(c)) for basis, c in columns]


def _name_or_code() -> Column:
    return normalize_name(F.when(text("name") != "", text("name")).otherwise(text("code")))


def hierarchy_keys() -> list[Key]:
    parent, name = normalize_name("parent"), _name_or_code()
    return [("supertype", parent, parent), ("name", name, name)]


def domain_keys() -> list[Key]:
    code, name, norm = compare_key("code"), compare_key("name"), _name_or_code()
    return [("code", code, code), ("name", name, name), ("normalized name", norm, norm)]


def rule_keys() -> list[Key]:
    name, norm = compare_key("name"), _name_or_code()
    return [("name", name, name), ("normalized name", norm, norm)]


def attach(match: Match, s: DataFrame, t: DataFrame, scope: Sequence[str], s_id="id", t_id="id") -> DataFrame:
    """Matched pairs with all S columns as ``s_*`` and all T columns as ``t_*``."""
    scope = list(scope)

    def prefixed(df, id_col, side):
        cols = [F.col(c).alias(f"{side}_{c}") for c in df.columns if c not in scope and c != id_col]
        return df.select(*scope, F.col(id_col).alias(f"{side}_id"), *cols)

    return match.pairs.join(prefixed(s, s_id, "s"), [*scope, "s_id"]).join(
        prefixed(t, t_id, "t"), [*scope, "t_id"]
    )


def rewrite_column(df: DataFrame, scope: Sequence[str], ref: Column, alias: DataFrame, out: str) -> DataFrame:
    """Replace a referenced code by the matched T code; unknown codes stay.

    ``alias`` is (scope…, alias_key, t_code) with one row per normalised S code.
    """
    scope = list(scope)
    keyed = df.withColumn("alias_key", normalize_name(ref))
    joined = keyed.join(alias.select(*scope, "alias_key", "t_code"), [*scope, "alias_key"], "left")
    return joined.withColumn(out, F.coalesce("t_code", ref)).drop("alias_key", "t_code")


def rewrite_endpoints(rel: DataFrame, scope: Sequence[str], alias: DataFrame) -> DataFrame:
    """Both ends of S relationships in T codes, so a renamed entity does not cascade."""
    for end in ("end1", "end2"):
        rel = rewrite_column(rel, scope, F.col(f"{end}.entity"), alias, "_to")
        rel = rel.withColumn(end, F.col(end).withField("entity", F.col("_to"))).drop("_to")
    return rel


def alias_of(pairs: DataFrame, scope: Sequence[str]) -> DataFrame:
    """(scope…, alias_key, t_code) from matched entities with s_code/s_name/t_code/t_name."""

    def label(side):
        return F.when(text(f"{side}_code") != "", text(f"{side}_code")).otherwise(text(f"{side}_name"))

    rows = pairs.select(
        *scope, normalize_name(label("s")).alias("alias_key"), label("t").alias("t_code"), "s_id"
    ).where("alias_key <> ''")
    # Two entities may normalise to one key; the later one wins.
    return keep_one(rows, [*scope, "alias_key"], [F.desc("s_id")]).drop("s_id")


def reconcile_keyed(s: DataFrame, t: DataFrame, key: Sequence[str]) -> DataFrame:
    """Full outer join on a key that is unique on each side; status MATCHED, MISSING, EXTRA."""
    key = list(key)

    def side(df, p):
        cols = [F.col(c).alias(f"{p}_{c}") for c in df.columns if c not in key]
        return df.select(*key, *cols, F.lit(True).alias(f"_{p}"))

    status = (
        F.when(F.col("_s").isNull(), "EXTRA").when(F.col("_t").isNull(), "MISSING").otherwise("MATCHED")
    )
    return side(s, "s").join(side(t, "t"), key, "full").withColumn("status", status).drop("_s", "_t")


def match_multiset(
    s: DataFrame, t: DataFrame, signature: Sequence[str], s_order: Sequence[str], t_order: Sequence[str],
    written: bool = False,
) -> DataFrame:
    """Pair equal signatures one for one: the k-th S row with the k-th T row.

    ``written``: both sides are tables already, as ``stored`` returns them.
    """
    sig = list(signature)
    left = number_within(s, sig, list(s_order), "occurrence", written)
    right = number_within(t, sig, list(t_order), "occurrence", written)
    return reconcile_keyed(left, right, [*sig, "occurrence"])


def multiset_counts(s: DataFrame, t: DataFrame, signature: Sequence[str]) -> DataFrame:
    """Per signature: rows on each side, matched, missing, extra. No row is numbered."""
    sig = list(signature)
    both = s.select(*sig, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        t.select(*sig, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    counts = both.groupBy(*sig).agg(F.sum("_s").alias("n_s"), F.sum("_t").alias("n_t"))
    matched = F.least("n_s", "n_t")
    return counts.withColumns(
        {"matched": matched, "missing": F.col("n_s") - matched, "extra": F.col("n_t") - matched}
    )


def _unique_view(t: DataFrame, scope: list[str], key: Column, name: str) -> DataFrame:
    """(scope…, key, t_id) for the keys that one T row carries alone."""
    keyed = t.select(*scope, key.alias(name), "t_id").where(F.col(name).isNotNull())
    return (
        keyed.groupBy(*scope, name)
        .agg(F.count("*").alias("_n"), F.min("t_id").alias("t_id"))
        .where("_n = 1")
        .drop("_n")
    )


def match_tiered(s: DataFrame, t: DataFrame, scope: Sequence[str], exclusive: bool = True) -> DataFrame:
    """Each S row gets its strongest candidate: name and code, code, name.

    A tier counts only when its key is unique on the whole T side. With
    ``exclusive`` a T row claimed by an earlier S row (by ``ord``) leaves the
    later one unmatched; without it (notes, driven from the other side) several
    rows may share a partner. Columns: id, name, code, ord on both sides.
    """
    scope = list(scope)
    right = t.select(*scope, F.col("id").alias("t_id"), text("name").alias("name"), text("code").alias("code"))
    folded = F.lower(trim_ws("name"))
    exact = (
        right.groupBy(*scope, "name", "code").agg(F.max("t_id").alias("t1"))
    )
    by_code = _unique_view(right, scope, F.col("code"), "code").withColumnRenamed("t_id", "t2")
    by_name = _unique_view(right, scope, folded, "_name").withColumnRenamed("t_id", "t3")
    left = s.select(
        *scope, F.col("id").alias("s_id"), "ord", text("name").alias("name"), text("code").alias("code"),
        folded.alias("_name"),
    )
    joined = (
        left.join(exact, [*scope, "name", "code"], "left")
        .join(by_code, [*scope, "code"], "left")
        .join(by_name, [*scope, "_name"], "left")
    )
    tier = F.when(F.col("t1").isNotNull(), 1).when(F.col("t2").isNotNull(), 2).when(F.col("t3").isNotNull(), 3)
    hits = joined.select(*scope, "s_id", "ord", tier.alias("tier"), F.coalesce("t1", "t2", "t3").alias("t_id"))
    if not exclusive:
        return hits.drop("ord")
    claims = (
        hits.where("t_id is not null")
        .groupBy(*scope, "t_id")
        .agg(F.min_by("s_id", F.struct("ord", "s_id")).alias("_winner"))
    )
    held = hits.join(claims, [*scope, "t_id"], "left")
    kept = F.col("_winner") == F.col("s_id")
    return held.select(
        *scope, "s_id", F.when(kept, F.col("tier")).alias("tier"), F.when(kept, F.col("t_id")).alias("t_id")
    )


def match_edges_tiered(s: DataFrame, t: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Relationships by (ends, name), then the only one left with the same ends.

    Tier 1 runs to its end before tier 2 starts, so the result does not depend
    on the order of the rows. Columns: id, ends, name.
    """
    scope = list(scope)
    name = F.lower(trim_ws("name"))

    def side(df):
        return df.select(*scope, "id", "ends", name.alias("_name"))

    left, right = side(s), side(t)
    by_name = (
        right.groupBy(*scope, "ends", "_name")
        .agg(F.count("*").alias("_n"), F.min("id").alias("t_id"))
        .where("_n = 1")
        .drop("_n")
    )
    # Several S rows may ask for one T row; the first one holds it.
    first = (
        left.join(by_name, [*scope, "ends", "_name"])
        .groupBy(*scope, "t_id")
        .agg(F.min("id").alias("s_id"), F.min("ends").alias("ends"))
    )
    tier1 = cut(first.select(*scope, "s_id", "t_id", F.lit(1).alias("tier")))
    left2 = left.withColumnRenamed("id", "s_id").join(tier1, [*scope, "s_id"], "left_anti")
    right2 = right.withColumnRenamed("id", "t_id").join(tier1, [*scope, "t_id"], "left_anti")
    alone = (
        right2.groupBy(*scope, "ends")
        .agg(F.count("*").alias("_n"), F.min("t_id").alias("t_id"))
        .where("_n = 1")
        .drop("_n")
    )
    tier2 = (
        left2.join(alone, [*scope, "ends"])
        .groupBy(*scope, "t_id")
        .agg(F.min("s_id").alias("s_id"))
        .select(*scope, "s_id", "t_id", F.lit(2).alias("tier"))
    )
    return tier1.unionByName(tier2)


def claim_first(s: DataFrame, t: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Documentation pairing: same normalised name, else same normalised code.

    Inside one bucket the k-th S row takes the k-th T row, in ``ord``. Rounds, in
    order: S name to T name, S name to T code, S code to T name, S code to T
    code; a row leaves as soon as it is paired. Equal to a one-by-one claim
    whenever the rows of a bucket are claimed in the same round.
    """
    scope = list(scope)
    from_s = F.col("_side") == "S"

    def side(df, label):
        return df.select(
            *scope, F.lit(label).alias("_side"), F.col("id").alias("_id"), "ord",
            normalize_name("name").alias("_name"), normalize_name("code").alias("_code"))

    rows = side(s, "S").unionByName(side(t, "T"))
    found = None
    for s_key, t_key in (("_name", "_name"), ("_name", "_code"), ("_code", "_name"), ("_code", "_code")):
        key = F.when(from_s, F.col(s_key)).otherwise(F.col(t_key))
        asked = rows.select(*scope, "_side", "_id", "ord", key.alias("_key")).where("_key <> ''")
        numbered = number_within(asked, [*scope, "_key", "_side"], ["ord", "_id"], "rn")
        mates = numbered.groupBy(*scope, "_key", "rn").agg(
            F.min(F.when(from_s, F.col("_id"))).alias("_s"), F.min(F.when(~from_s, F.col("_id"))).alias("_t")
        ).where("_s is not null and _t is not null")
        state = cut(rows.join(_both_ways(mates, scope), [*scope, "_side", "_id"], "left"))
        step = state.where(F.col("_mate").isNotNull() & from_s).select(
            *scope, F.col("_id").alias("s_id"), F.col("_mate").alias("t_id"))
        found = step if found is None else found.unionByName(step)
        rows = state.where(F.col("_mate").isNull()).drop("_mate")
    return found


def member_diff(s_members: Column, t_members: Column) -> Column:
    """struct(lost, added, relation) of two ordered member arrays, names normalised."""
    a = F.transform(s_members, lambda m: normalize_name(m))
    b = F.transform(t_members, lambda m: normalize_name(m))
    lost, added = F.array_sort(F.array_except(a, b)), F.array_sort(F.array_except(b, a))
    relation = (
        F.when((F.size(lost) > 0) | (F.size(added) > 0), "COMPOSITION").when(a != b, "ORDER").otherwise("EQUAL")
    )
    return F.struct(lost.alias("lost"), added.alias("added"), relation.alias("relation"))


def match_by_signature(
    s: DataFrame, t: DataFrame, scope: Sequence[str], signature: str = "signature", order: str = "ord"
) -> DataFrame:
    """One row per signature: the last holder on each side, and how many share it."""
    key = [*scope, signature]

    def side(df):
        others = [c for c in df.columns if c not in key]
        return df.groupBy(*key).agg(
            *[F.max_by(F.col(c), F.col(order)).alias(c) for c in others if c != order],
            F.count("*").alias("holders"),
        )

    return reconcile_keyed(side(s), side(t), key)


def pair_changed_edges(
    missing: DataFrame, extra: DataFrame, scope: Sequence[str]
) -> DataFrame:
    """Edges left over by signature: same (parent, child) pairs up as JOIN_CHANGED."""
    key = [*scope, "parent", "child"]
    both = match_multiset(missing, extra, key, ["ord"], ["ord"])
    return both.withColumn(
        "status", F.when(F.col("status") == "MATCHED", "JOIN_CHANGED").otherwise(F.col("status"))
    )


def orphans(objects: DataFrame, endpoints: DataFrame, key: Sequence[str]) -> DataFrame:
    """Objects that no edge touches."""
    return objects.join(endpoints, list(key), "left_anti")


def occurrence_join(
    manifest: DataFrame, outcomes: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Left join on key plus occurrence, so that repeated keys stay apart.

    ``outcomes`` carries its own 0-based ``occurrence``.
    """
    numbered = number_within(manifest, list(key), list(order), "_n")
    counted = numbered.withColumn("occurrence", F.col("_n") - F.lit(1)).drop("_n")
    return counted.join(outcomes, [*key, "occurrence"], "left")


def asof_owner(
    values: DataFrame, anchors: DataFrame, scope: Sequence[str], offset: str, owner: str
) -> DataFrame:
    """Each value with the owner of the closest anchor at or before its offset.

    Anchors sort before values at an equal offset; ``id`` breaks further ties.
    """
    scope = list(scope)
    both = anchors.select(
        *scope, offset, "id", F.lit(0).alias("_kind"), F.col(owner).alias("_owner")
    ).unionByName(
        values.select(*scope, offset, "id", F.lit(1).alias("_kind"), F.lit(None).cast(
            anchors.schema[owner].dataType).alias("_owner"))
    )
    filled = fill_forward(both, scope, [offset, "_kind", "id"], "_owner", owner)
    return filled.where("_kind = 1").select(*scope, "id", offset, owner)


def explain_extra_by_prefix(extra: DataFrame, partners: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Why a T-only attribute exists: a partner entity's name begins its own.

    ``extra`` (scope…, owner, id, name, code), ``partners`` (scope…, owner,
    partner). The prefix test is an equi-join: prefixes of the attribute's code and
    name, of the lengths that the owner's tokens have, meet these tokens, which are unique per
    (scope, owner, token, tier). Only true hits come out of the join.
    """
    scope = list(scope)

    def flat(c):
        return F.upper(F.btrim(F.regexp_replace(text(c), r"\s+", " ")))

    def token(c):
        return F.replace(flat(c), F.lit(" "), F.lit("_"))

    tokens = partners.select(*scope, "owner", "partner", token("partner").alias("_token")).where("_token <> ''")
    stem = F.substring_index("_token", "_", 1)
    probes = (
        tokens.select(
            *scope, "owner", "partner", F.length("partner").alias("_len"),
            F.inline(
                F.array(
                    F.struct(F.lit(1).alias("tier"), F.col("_token").alias("probe")),
                    F.struct(F.lit(2).alias("tier"), F.when(F.length(stem) >= 4, stem).alias("probe")),
                )
            ),
        )
        .where("probe is not null")
        .groupBy(*scope, "owner", "probe", "tier")
        .agg(F.min(F.struct((-F.col("_len")).alias("neg"), "partner")).alias("_named"))
    )

    # Only prefixes as long as some token of the owner can hit: one probe per such length and text.
    lengths = probes.select(*scope, "owner", F.length("probe").alias("_n")).distinct()
    shown = extra.select(*scope, "owner", "id", flat("code").alias("_code"), token("name").alias("_name"))
    asked = shown.join(lengths, [*scope, "owner"]).select(
        *scope, "owner", "id", "_n", F.explode(F.array_distinct(F.array(F.left("_code", "_n"), F.left("_name", "_n")))).alias("probe"),
    ).where(F.length("probe") == F.col("_n")).drop("_n")
    best = (
        asked.join(probes, [*scope, "owner", "probe"])
        .groupBy(*scope, "owner", "id")
        .agg(F.min(F.struct("tier", "_named.neg", "_named.partner")).alias("_best"))
    )
    named = extra.select(*scope, "owner", "id").join(best, [*scope, "owner", "id"], "left")
    reason = (
        F.when(F.col("_best.tier") == 1, "FK_PROPAGATED")
        .when(F.col("_best.tier") == 2, "POSSIBLY_FK")
        .otherwise("UNEXPLAINED")
    )
    return named.select(*scope, "owner", "id", reason.alias("reason"), F.col("_best.partner").alias("partner"))


def unpivot(df: DataFrame, id_cols: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(id…, property, value) with every value as text; NULL values are absent properties."""
    cast = df.select(*id_cols, *[F.col(c).cast("string").alias(c) for c in columns])
    return cast.unpivot(list(id_cols), list(columns), "property", "value").where("value is not null")


def property_diff(before: DataFrame, after: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Per property: added, removed, changed cells between two unpivoted snapshots.

    Only objects of both snapshots are compared cell by cell.
    """
    ids = list(id_cols)
    both = before.select(*ids).distinct().join(after.select(*ids).distinct(), ids)
    a = before.join(both, ids, "left_semi").withColumnRenamed("value", "before")
    b = after.join(both, ids, "left_semi").withColumnRenamed("value", "after")
    cells = a.join(b, [*ids, "property"], "full")
    x, y = F.col("before"), F.col("after")
    return cells.groupBy("property").agg(
        count_when(x.isNull()).alias("added"),
        count_when(y.isNull()).alias("removed"),
        count_when(x.isNotNull() & y.isNotNull() & (x != y)).alias("changed"),
        count_when(x == y).alias("unchanged"),
    )


def edit_gate(diff: DataFrame, allowed: Sequence[str], protected: Sequence[str]) -> DataFrame:
    """Verdict per property of an edit that may only touch ``allowed``."""
    touched = F.col("added") + F.col("removed") + F.col("changed") > 0
    verdict = (
        F.when(~touched, "UNCHANGED")
        .when(F.col("property").isin(*protected), "PROTECTED_CHANGED")
        .when((F.col("removed") > 0) | ~F.col("property").isin(*allowed), "NOT_ALLOWED")
        .otherwise("ALLOWED")
    )
    return diff.withColumn("verdict", verdict)


def owner_exists(cells: DataFrame, owners: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Property rows with a flag: does the owner object exist on the T side?"""
    key = F.lower(trim_ws("owner"))
    known = owners.select(*scope, key.alias("_owner")).distinct().withColumn("_known", F.lit(True))
    return (
        cells.withColumn("_owner", key)
        .join(known, [*scope, "_owner"], "left")
        .withColumn("owner_exists", F.coalesce("_known", F.lit(False)))
        .drop("_owner", "_known")
    )




