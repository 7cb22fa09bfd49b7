"""Registry of queries, and helpers that write the SQL twins.

``T.sql`` runs one text on Spark whose ``{table}`` marks are DataFrames; the same
text with the bare table names runs on the SQL side. Derived pairs are written
once this way, in the part of SQL both engines share.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MARK = re.compile(r"\{(\w+)\}")


def plain(text: str) -> str:
    """The SQL side of a shared text."""
    return _MARK.sub(r"\1", text)


class Tables:
    """The driver tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        names = set(_MARK.findall(text))
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


def query(name: str, sql: str | None = None):
    """Register a function of Tables as a query, with its SQL twin if there is one."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- SQL spellings of the expressions -------------------------------------------------

BLANK = "E' \\t\\n\\r'"


def txt(x: str) -> str:
    return f"coalesce({x}, '')"


def trim(x: str) -> str:
    return f"trim({txt(x)}, {BLANK})"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({txt(x)}, '\\s+', ' ', 'g'))"


def key(x: str) -> str:
    return f"upper({trim(x)})"


def norm(x: str) -> str:
    t = f"upper(regexp_replace({txt(x)}, '[^0-9a-zA-Z]+', '', 'g'))"
    return (
        f"(CASE WHEN length({t}) <= 3 THEN {t} WHEN {t} LIKE '%IES' THEN left({t}, length({t}) - 3) || 'Y' "
        f"WHEN {t} LIKE '%SES' OR {t} LIKE '%XES' OR {t} LIKE '%ZES' THEN left({t}, length({t}) - 2) "
        f"WHEN {t} LIKE '%S' AND {t} NOT LIKE '%SS' THEN left({t}, length({t}) - 1) ELSE {t} END)"
    )


def truncated(x: str, n: int = 120) -> str:
    s = squeeze(x)
    return f"(CASE WHEN length({s}) <= {n} THEN {s} ELSE left({s}, {n - 1}) || '…' END)"


def case_map(x: str, table: dict[str, str], default: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"(CASE {x} {arms} ELSE {default} END)"


def ladder(s_sql: str, t_sql: str, scope: list[str], keys: list[tuple[str, str, str]]) -> str:
    """CTEs lp (all pairs), ls (S rest), lt (T rest) of a match ladder; ids are unique."""
    sc = ", ".join(scope)
    parts = [
        f"s0 AS (SELECT *, {', '.join(f'{k[1]} AS k{i}' for i, k in enumerate(keys))} FROM ({s_sql}) x)",
        f"t0 AS (SELECT *, {', '.join(f'{k[2]} AS k{i}' for i, k in enumerate(keys))} FROM ({t_sql}) x)",
    ]
    for i, (basis, _, _) in enumerate(keys):
        uniq = "SELECT {sc}, k{i}, min(id) AS id FROM {side}{i} WHERE k{i} <> '' GROUP BY {sc}, k{i} HAVING count(*) = 1"
        a, b = uniq.format(sc=sc, i=i, side="s"), uniq.format(sc=sc, i=i, side="t")
        on = " AND ".join(f"a.{c} = b.{c}" for c in [*scope, f"k{i}"])
        parts.append(
            f"p{i} AS (SELECT {', '.join('a.' + c for c in scope)}, a.id AS s_id, b.id AS t_id, "
            f"'{basis}' AS basis FROM ({a}) a JOIN ({b}) b ON {on})"
        )
        parts.append(f"s{i + 1} AS (SELECT * FROM s{i} WHERE id NOT IN (SELECT s_id FROM p{i}))")
        parts.append(f"t{i + 1} AS (SELECT * FROM t{i} WHERE id NOT IN (SELECT t_id FROM p{i}))")
    n = len(keys)
    parts.append("lp AS (" + " UNION ALL ".join(f"SELECT * FROM p{i}" for i in range(n)) + ")")
    parts.append(f"ls AS (SELECT * FROM s{n})")
    parts.append(f"lt AS (SELECT * FROM t{n})")
    return ",\n".join(parts)


def named_keys(mode: str = "auto") -> list[tuple[str, str, str]]:
    def both(basis, e):
        return (basis, e, e)

    code, name = both("code", key("code")), both("name", key("name"))
    nname, ncode = both("normalized name", norm("name")), both("normalized code", norm("code"))
    cross = both("name↔code", norm("CASE WHEN coalesce(code, '') <> '' THEN code ELSE name END"))
    return {
        "code": [code], "name": [name], "normalized": [nname, ncode],
    }.get(mode, [code, name, nname, ncode, cross])


# --- SQL spellings of type expressions ------------------------------------------------

from veritwin.functions import types as _ty  # noqa: E402


def q(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def t_bracket(raw: str) -> str:
    """Name, opening bracket, anything, and the only closing bracket at the end."""
    return f"({raw} LIKE '_%(%)' AND strpos({raw}, ')') = length({raw}) AND regexp_full_match(split_part({raw}, '(', 1), '[A-Za-z0-9_ ]*[A-Za-z0-9_] *'))"


def t_glued(raw: str) -> str:
    """A name without digits, then one number or two with a comma."""
    return f"regexp_full_match({raw}, '[A-Za-z_ ]*[A-Za-z_] *[0-9]+( *, *[0-9]+)?')"


def t_stem(raw: str) -> str:
    return f"rtrim({raw}, '0123456789, ')"


def t_base(x: str) -> str:
    raw = trim(x)
    return (
        f"(CASE WHEN {t_bracket(raw)} THEN lower(trim(split_part({raw}, '(', 1))) WHEN {t_glued(raw)} THEN lower(trim({t_stem(raw)})) "
        f"ELSE lower({raw}) END)")


def t_dim(x: str, i: int) -> str:
    raw = trim(x)
    dims = (
        f"(CASE WHEN {t_bracket(raw)} THEN substr({raw}, strpos({raw}, '(') + 1, length({raw}) - strpos({raw}, '(') - 1) "
        f"WHEN {t_glued(raw)} THEN substr({raw}, length({t_stem(raw)}) + 1) ELSE '' END)")
    parts = f"list_filter(list_transform(string_split({dims}, ','), lambda d: trim(d)), lambda d: d <> '')"
    return f"coalesce({parts}[{i}], '')"


def t_canon_of_base(b: str) -> str:
    known = case_map(b, _ty.CANONICAL)
    return f"(CASE WHEN {b} IN ({q(_ty.NO_TYPE)}) THEN '' ELSE coalesce({known}, replace(upper({b}), ' ', '_')) END)"


def t_family_of_canon(c: str) -> str:
    return f"(CASE WHEN {c} = '' THEN '' ELSE coalesce({case_map(c, _ty.FAMILY)}, 'OTHER') END)"


def typed(source: str, *cols: str) -> str:
    """Subquery with <col>_base, _len, _prec, _canon, _family, _mkey for each column."""
    first = ", ".join(f"{t_base(c)} AS {c}_base, {t_dim(c, 1)} AS {c}_len, {t_dim(c, 2)} AS {c}_prec" for c in cols)
    second = ", ".join(
        f"{t_canon_of_base(c + '_base')} AS {c}_canon, {case_map(c + '_base', _ty.MATRIX_KEY)} AS {c}_mkey" for c in cols)
    third = ", ".join(f"{t_family_of_canon(c + '_canon')} AS {c}_family" for c in cols)
    return (
        f"(SELECT *, {third} FROM (SELECT *, {second} FROM (SELECT *, {first} FROM ({source}) z0) z1) z2)")


def t_match(s: str, t: str, mode: str = "family", matrix: bool = True) -> str:
    """Over a ``typed`` subquery."""
    accepted = q(f"{k}>{v}" for k, vs in _ty.APPROVED.items() for v in vs)
    by = {
        "exact": f"lower({trim(s)}) = lower({trim(t)})",
        "canonical": f"{s}_canon = {t}_canon",
        "family": f"{s}_family = {t}_family",
    }[mode]
    arm = (
        f"WHEN {s}_mkey IN ({q(_ty.APPROVED)}) THEN concat({s}_mkey, '>', coalesce({t}_mkey, '')) IN ({accepted}) "
        if matrix else "")
    none = q(_ty.NO_TYPE)
    return (
        f"(CASE WHEN lower({trim(s)}) IN ({none}) OR lower({trim(t)}) IN ({none}) THEN TRUE {arm}ELSE {by} END)")


def t_dims_match(s: str, t: str) -> str:
    return (
        f"(NOT (({s}_len <> '' AND {t}_len <> '' AND {s}_len <> {t}_len) OR "
        f"({s}_prec <> '' AND {t}_prec <> '' AND {s}_prec <> {t}_prec)))")


def t_describe(c: str) -> str:
    dims = (
        f"CASE WHEN {c}_len <> '' AND {c}_prec <> '' THEN concat('(', {c}_len, ',', {c}_prec, ')') "
        f"WHEN {c}_len <> '' THEN concat('(', {c}_len, ')') ELSE '' END")
    shown = f"concat({c}_canon, {dims}, ' / ', {c}_family)"
    return (
        f"(CASE WHEN {txt(c)} = '' THEN '(none)' WHEN {trim(c)} <> '' AND {c}_base <> '' AND {c}_canon <> upper({c}_base) "
        f"THEN concat({trim(c)}, ' → ', {shown}) ELSE {shown} END)")


def t_physical(x: str) -> str:
    raw = trim(x)
    sized = f"({t_bracket(raw)} AND regexp_matches({raw}, '^[A-Za-z]'))"
    base = f"(CASE WHEN {sized} THEN lower(trim(split_part({raw}, '(', 1))) ELSE lower({raw}) END)"
    dims = f"(CASE WHEN {sized} THEN trim(substr({raw}, strpos({raw}, '(') + 1, length({raw}) - strpos({raw}, '(') - 1)) ELSE '' END)"
    canon = f"coalesce({case_map(base, _ty.PHYSICAL)}, upper({base}))"
    return (
        f"(CASE WHEN {txt(x)} = '' THEN '' WHEN {dims} <> '' THEN concat({canon}, '(', {dims}, ')') ELSE {canon} END)")


def t_physical_base(n: str) -> str:
    """From a normalised physical type."""
    return f"(CASE WHEN regexp_matches({n}, '\\(.*\\)$') THEN trim(split_part({n}, '(', 1)) ELSE {n} END)"


def similarity(a: str, b: str) -> str:
    """Over two normalised text columns; texts are ASCII."""
    return (
        f"(CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE "
        f"ELSE 1.0::DOUBLE - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b}))::DOUBLE END)")
