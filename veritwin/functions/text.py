"""Name and text expressions. All are plain Columns, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank around a value.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
BLANK_RUN = "[" + BLANKS + "]+"

# Fixed value: characters that may not occur in a parsed document.
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"

ELLIPSIS = "…"
ABSENT = "—"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: str | Column) -> Column:
    """NULL read as the empty string."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def trim_ws(c: str | Column) -> Column:
    """Strip blanks of every kind on both sides (Spark's trim strips spaces only)."""
    return F.btrim(text(c), F.lit(BLANKS))


def is_blank(c: str | Column) -> Column:
    return trim_ws(c) == ""


def first_nonblank(*cols: str | Column) -> Column:
    """First of several places that holds a non-blank value, trimmed; else NULL."""
    return F.coalesce(*[F.nullif(trim_ws(c), F.lit("")) for c in cols])


def compare_key(c: str | Column, case_insensitive: bool = True) -> Column:
    key = trim_ws(c)
    return F.upper(key) if case_insensitive else key


def normalize_name(c: str | Column, plurals: bool = True) -> Column:
    """Comparison token: letters and digits only, upper case, singular."""
    # One named class: the regex engine tests a union of three ranges ten times slower.
    token = F.upper(F.regexp_replace(text(c), r"\P{Alnum}+", ""))
    if not plurals:
        return token
    # Only tokens longer than three characters; at most one of the rules applies.
    token = F.regexp_replace(token, "^(.+)IES$", "$1Y")
    return F.regexp_replace(token, "^(.+[SXZ])ES$|^(.{2,}[^S])S$", "$1$2")


def names_equivalent(a: str | Column, b: str | Column, plurals: bool = True) -> Column:
    return normalize_name(a, plurals) == normalize_name(b, plurals)


def squeeze(c: str | Column) -> Column:
    """Collapse every run of blanks to one space and trim."""
    return F.btrim(F.regexp_replace(text(c), BLANK_RUN, " "), F.lit(" "))


def normalize_definition(c: str | Column, mode: str = "lower") -> Column:
    """``lower`` ignores case, ``exact`` keeps it (field mapping)."""
    flat = squeeze(c)
    return flat if mode == "exact" else F.lower(flat)


def truncate(c: str | Column, limit: int = 120) -> Column:
    """One line, at most ``limit`` characters; for report cells only."""
    flat = squeeze(c)
    return F.when(F.length(flat) <= limit, flat).otherwise(
        F.concat(F.left(flat, F.lit(limit - 1)), F.lit(ELLIPSIS))
    )


def strip_control_chars(c: str | Column) -> Column:
    return F.regexp_replace(col(c), CONTROL_CHARS, "")


def any_pattern(patterns: Sequence[str], *cols: str | Column) -> Column:
    """True when any column matches any pattern, whatever the case."""
    if not patterns:
        return F.lit(False)
    rx = "(?i)" + "|".join(f"(?:{p})" for p in patterns)
    hit = F.lit(False)
    for c in cols:
        hit = hit | text(c).rlike(rx)
    return hit


def object_label(name: str | Column, code: str | Column) -> Column:
    """Display label: the code, or ``name (code)`` when the two differ."""
    n, c = text(name), text(code)
    return (
        F.when((n == "") | (c == ""), F.concat(c, n))
        .when(normalize_name(n) == normalize_name(c), c)
        .when(_ends_in_brackets(F.upper(n), F.upper(c)), c)
        .otherwise(F.concat(n, F.lit(" ("), c, F.lit(")")))
    )


def _ends_in_brackets(n: Column, c: Column) -> Column:
    """``n`` ends in ``( c )``, blanks around it allowed."""
    whole = F.rtrim(n)
    inner = F.rtrim(F.left(whole, F.length(whole) - 1))
    before = F.rtrim(F.left(inner, F.length(inner) - F.length(c)))
    return whole.endswith(")") & F.endswith(inner, c) & before.endswith("(")


def documented_members(c: str | Column) -> Column:
    """Single bare tokens that a comment lists, one per line or separated."""
    parts = F.transform(F.split(text(c), r"[\n,;+/]+"), lambda x: F.btrim(x, F.lit(BLANKS)))
    return F.filter(parts, lambda x: x.rlike(r"^[A-Za-z0-9_\-]+$"))


def index_signature(is_unique: Column, members: Column) -> Column:
    cols = F.array_sort(F.transform(members, lambda m: compare_key(m)))
    return F.concat(F.when(is_unique, "U").otherwise("I"), F.lit(":"), F.concat_ws(",", cols))


def fk_signature(parent: Column, child: Column, joins: Column) -> Column:
    """``PARENT>CHILD:`` and the sorted join columns; joins is array<struct<parent_col,child_col>>."""
    pairs = F.array_sort(
        F.transform(
            joins,
            lambda j: F.concat(compare_key(j["parent_col"]), F.lit("="), compare_key(j["child_col"])),
        )
    )
    return F.concat(
        compare_key(parent), F.lit(">"), compare_key(child), F.lit(":"), F.concat_ws(",", pairs)
    )


def udp_name(path: str | Column) -> Column:
    """Property name from a dotted path: last segment, safe characters only."""
    return F.regexp_replace(F.element_at(F.split(text(path), r"\."), -1), "[^A-Za-z0-9_]", "_")


def udp_full_name(path: str | Column) -> Column:
    return F.regexp_replace(text(path), "[^A-Za-z0-9_]", "_")
