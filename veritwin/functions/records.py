"""Packed text records: notes, option blobs, extended-attribute lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .text import BLANKS, text, trim_ws

# Layout of a packed note record.
FIELD_SEPARATOR = "\\#x1F"
FIELD_COUNT = 12
NUMBER_FIELD, CREATED_FIELD, CREATOR_FIELD = 0, 1, 2
MODIFIED_FIELD, MODIFIER_FIELD, TEXT_FIELD, FLAG_FIELD, GUID_FIELD = 3, 4, 6, 7, 8
ESCAPE = "\\#x"

# Fixed value: one property marker inside an extended-attribute line.
MARKER = r"\{[0-9A-Fa-f\-]+\},([^,]+),\d+="


def escape_controls(c: str | Column) -> Column:
    """Control characters as ``\\#xNN``; line ends become one ``\\#x0A``."""
    out = F.replace(text(c), F.lit(ESCAPE), F.lit(ESCAPE + "5C#x"))
    out = F.replace(F.replace(out, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    for code in [10, 9, *range(0, 9), *range(11, 32), 127]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"{ESCAPE}{code:02X}"))
    return out


def unescape_controls(c: str | Column) -> Column:
    """Undo :func:`escape_controls`; an escape without two hex digits stays as it is."""
    pieces = F.split(text(c), r"\\#x")
    tail = F.transform(
        F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.when(
            p.rlike("^[0-9A-Fa-f]{2}"),
            F.concat(F.char(F.conv(F.left(p, F.lit(2)), 16, 10).cast("bigint")), F.substr(p, F.lit(3))),
        ).otherwise(F.concat(F.lit(ESCAPE), p)),
    )
    return F.concat(F.element_at(pieces, 1), F.concat_ws("", tail))


def encode_packed_record(
    text_col: str | Column, number: Column, author: Column, stamp: Column, guid: Column, flag: Column
) -> Column:
    """One 12-field record; the text travels escaped in its own field."""
    fields: list[Column] = [F.lit("")] * FIELD_COUNT
    fields[NUMBER_FIELD] = number.cast("string")
    fields[CREATED_FIELD] = fields[MODIFIED_FIELD] = stamp
    fields[CREATOR_FIELD] = fields[MODIFIER_FIELD] = author
    fields[TEXT_FIELD] = escape_controls(text_col)
    fields[FLAG_FIELD] = flag
    fields[GUID_FIELD] = guid
    return F.concat_ws(FIELD_SEPARATOR, *[F.coalesce(f, F.lit("")) for f in fields])


def decode_packed_record(c: str | Column) -> Column:
    """The text field of a packed record, '' when the record is too short."""
    fields = F.split(text(c), r"\\#x1F")
    return unescape_controls(F.coalesce(F.get(fields, F.lit(TEXT_FIELD)), F.lit("")))


def join_notes(records: Column) -> Column:
    """Array of packed records -> one text: blank notes dropped, the rest on lines."""
    notes = F.transform(records, lambda r: trim_ws(decode_packed_record(r)))
    return F.concat_ws("\n", F.filter(notes, lambda n: n != ""))


def parse_options_blob(c: str | Column) -> Column:
    """``key=value`` lines -> map; section lines skipped, the last value of a key wins."""
    lines = F.filter(
        F.split(text(c), r"\r?\n"),
        lambda line: F.contains(line, F.lit("=")) & ~F.ltrim(line).startswith("["),
    )
    entries = F.transform(
        lines,
        lambda line, i: F.struct(
            trim_ws(F.substring_index(line, "=", 1)).alias("key"), i.alias("nth"),
            trim_ws(F.substr(line, F.instr(line, "=") + F.lit(1))).alias("value"),
        ),
    )
    # Sorted by key and place, the last of a key is the one before another key; the outer transform sorts once.
    last = F.transform(
        F.array(F.array_sort(entries)),
        lambda s: F.filter(s, lambda e, i: F.coalesce(F.get(s, i + 1)["key"] != e["key"], F.lit(True))),
    )[0]
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))


def explode_kv_text(df: DataFrame, id_cols: list[str], text_col: str) -> DataFrame:
    """Extended-attribute text -> one row per line with a property.

    A line with two markers names its container; a line with one marker belongs
    to the container of the closest line before it. ``id_cols`` must identify a
    row, so that a window never holds more than the lines of one text.
    """
    lines = df.select(*id_cols, F.posexplode(F.split(text(text_col), r"\r?\n")).alias("pos", "line"))
    markers = F.regexp_extract_all("line", F.lit(MARKER), F.lit(1))
    found = lines.withColumn("markers", markers).where(F.size("markers") > 0)
    named = found.select(
        *id_cols,
        "pos",
        F.element_at("markers", -1).alias("property"),
        F.when(F.size("markers") > 1, F.try_element_at("markers", F.lit(-2))).alias("own"),
        F.regexp_extract("line", f"^.*{MARKER}(.*)$", 2).alias("value"),
    )
    before = W.partitionBy(*id_cols).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    return named.select(
        *id_cols,
        "pos",
        F.concat_ws(".", F.last("own", ignorenulls=True).over(before), F.col("property")).alias("path"),
        "value",
    )


def carry_forward(df: DataFrame, id_cols: list[str], text_col: str, starts: str) -> DataFrame:
    """Lines of a text, each with the last line so far that matches ``starts``."""
    lines = df.select(*id_cols, F.posexplode(F.split(text(text_col), "\n")).alias("pos", "line"))
    before = W.partitionBy(*id_cols).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    head = F.when(F.col("line").rlike(starts), F.col("line"))
    return lines.withColumn("carried", F.last(head, ignorenulls=True).over(before))


__all__ = [
    "BLANKS", "carry_forward", "decode_packed_record", "encode_packed_record", "escape_controls",
    "explode_kv_text", "join_notes", "parse_options_blob", "unescape_controls",
]
