"""What the operators share: word splitting, scans of whole texts, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import stored

#: Words of 0-9, a-z and everything beyond ASCII, after A-Z were lower-cased: a table over UTF-8 bytes.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Words between spaces and \x09-\x0D, after A-Z were lower-cased; bytes.split() cuts at exactly these.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Rows whose texts are Python objects at a time.
ROWS_AT_ONCE = 2000


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; a null text is empty."""
    return b"" if text is None else text.encode("utf-8")


def scan(df: DataFrame, columns: dict[str, Column | str], fn: Callable, schema: str) -> DataFrame:
    """The chosen columns of all rows through ``fn``, one Arrow batch after another.

    Only ``columns`` reach Python, under the names given here, so other columns of ``df`` are never
    read and can't clash. ``fn`` gets an iterator of lists of columns (Python lists) and yields lists
    of columns in the order of ``schema``. Spark bounds a batch by rows and bytes; ``fn`` gets at most
    ``ROWS_AT_ONCE`` rows of it, which bounds the Python objects that live at a time.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    chosen = df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(n) for n, c in columns.items()])

    def run(batches):
        parts = (b.slice(k, ROWS_AT_ONCE) for b in batches for k in range(0, b.num_rows, ROWS_AT_ONCE))
        for out in fn([c.to_pylist() for c in b.columns] for b in parts):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, arrow)], schema=arrow)

    return chosen.mapInArrow(run, schema)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the folder of spark.checkpoint.dir and go on from there."""
    return stored(df, name)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of an id's text, modulo; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def span_list(spans: str) -> Column:
    """kind:start:end of an ordered array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
