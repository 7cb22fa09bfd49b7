"""Fill-in-middle: texts cut at line borders and put together in another order, as a pipeline of Arrow kernels.

A batch of texts is split into lists of lines and flattened; each line keeps the index of its text, and from that its
ordinal. The ordinal against the two cuts of its text gives its role; the lines of one role are filtered out, become
lists by text again and are joined. No text is a Python object on the way.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import ROWS_AT_ONCE

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of the texts that are transformed, and percent of these that have the suffix first.
RATE, SUFFIX_FIRST = 100, 50
SEED = 7


def draws(doc_id: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of each document: the first groups of a hash of seed and id."""
    line = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    hashed = F.sha2(line.cast("binary"), 256)
    return [F.conv(F.substring(hashed, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def modulo(a: pa.Array, b: pa.Array | int) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def joined(*parts: pa.Array | str) -> pa.Array:
    return pc.binary_join_element_wise(*[pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in parts], pa.scalar("", pa.large_string()))


def offsets(sizes: pa.Array) -> pa.Array:
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(sizes)])


def lines(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Of texts without nulls: lines with their ends, index of the text of each, its ordinal there, lines per text."""
    parts = pc.split_pattern(texts, "\n")
    parent, flat = pc.list_parent_indices(parts).cast(pa.int64()), pc.list_flatten(parts)
    sizes = pc.list_value_length(parts).cast(pa.int64())
    starts = offsets(sizes).slice(0, len(sizes))
    ordinal = pc.subtract(pa.array(range(len(flat)), pa.int64()), pc.take(starts, parent))
    last = pc.equal(ordinal, pc.subtract(pc.take(sizes, parent), 1))
    # Behind the last line break there is a line only if it has characters.
    empty = pc.and_(last, pc.equal(pc.binary_length(flat), 0))
    ends = pc.if_else(last, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    line, keep = joined(flat, ends), pc.invert(empty)
    return line.filter(keep), parent.filter(keep), ordinal.filter(keep), pc.subtract(sizes, pc.filter(empty, last).cast(pa.int64()))


def cut(texts: pa.Array, a: pa.Array, b: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """Lines per text, and its prefix, middle and suffix between two of n + 1 places chosen by ``a`` and ``b``."""
    line, parent, ordinal, n = lines(texts)
    places = pc.add(n, 1)
    one, two = modulo(a, places), modulo(b, places)
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    before, until = pc.less(ordinal, pc.take(low, parent)), pc.less(ordinal, pc.take(high, parent))
    roles = ((before, low), (pc.and_not(until, before), pc.subtract(high, low)), (pc.invert(until), pc.subtract(n, high)))
    out = []
    for mask, sizes in roles:
        lists = pa.LargeListArray.from_arrays(offsets(sizes), line.filter(mask))
        out.append(pc.binary_join(lists, pa.scalar("", pa.large_string())))
    return n, out


def has(texts: pa.Array, marks: tuple[str, ...]) -> pa.Array:
    found = [pc.match_substring(texts, m) for m in marks]
    return pc.or_(found[0], pc.or_(found[1], found[2]))


def transform_batch(texts: pa.Array, h: list[pa.Array], rate: int, suffix_first: int) -> list[pa.Array]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n, (prefix, middle, suffix) = cut(texts, h[0], h[1])
    plain = pc.or_(
        pc.or_(pc.equal(pc.binary_length(texts), 0), has(texts, (PREFIX, SUFFIX, MIDDLE))),
        pc.greater_equal(modulo(h[2], 100), rate))
    spm = pc.less(modulo(h[3], 100), suffix_first)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    marked = pc.if_else(spm, joined(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle), joined(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    none = pa.scalar(None, pa.int64())
    sizes = [pc.if_else(plain, none, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    return [n, form, *sizes, pc.if_else(plain, texts, marked)]


def restore_batch(outputs: pa.Array, form: pa.Array) -> pa.Array:
    """The texts behind outputs: marks are unique in an output, as no text with a mark of its own is transformed."""
    outputs = outputs.cast(pa.large_string())

    def halves(x: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
        # A row of another form may lack the mark; it gets one behind its end and is not looked at.
        parts = pc.split_pattern(joined(x, pc.if_else(pc.match_substring(x, mark), "", mark).cast(pa.large_string())), mark, max_splits=1)
        return pc.list_element(parts, 0), pc.list_element(parts, 1)

    body, middle = halves(outputs, MIDDLE)
    one, two = halves(pc.utf8_slice_codeunits(body, len(PREFIX)), SUFFIX)
    back, front = halves(pc.utf8_slice_codeunits(body, len(SUFFIX)), PREFIX)
    whole = pc.if_else(pc.equal(form, "spm"), joined(front, middle, back), joined(one, middle, two))
    return pc.if_else(pc.equal(form, "plain"), outputs, whole)


def _batches(batches):
    for b in batches:
        for k in range(0, b.num_rows, ROWS_AT_ONCE):
            yield b.slice(k, ROWS_AT_ONCE)


def transform(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (lines), form, prefix_chars, middle_chars, output.

    Null texts are empty. An empty text, one that holds a mark, and one outside ``rate`` stay as they are (form plain, sizes
    null). Cuts depend on seed and id only, so rows that share an id and text have equal outputs; a null id counts as
    an empty text. An empty table gives an empty result; other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"

    def run(batches):
        for b in _batches(batches):
            n, form, prefix, middle, output = transform_batch(b.column("text"), [b.column(f"h{k}") for k in (1, 2, 3, 4)], rate, suffix_first)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), n, form, prefix, middle, output.cast(pa.string())], names=names)

    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    chosen = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), *draws(doc_id, seed))
    return chosen.mapInArrow(run, schema)


def restore(transformed: DataFrame) -> DataFrame:
    """The columns of ``transformed`` and ``restored``, the text behind output and form."""
    names = [*transformed.columns, "restored"]

    def run(batches):
        for b in _batches(batches):
            back = restore_batch(b.column("output"), b.column("form"))
            yield pa.RecordBatch.from_arrays([*b.columns, back.cast(pa.string())], names=names)

    return transformed.mapInArrow(run, StructType([*transformed.schema.fields, StructField("restored", StringType())]))
