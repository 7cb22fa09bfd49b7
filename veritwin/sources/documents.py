"""Documents to elements: every file is read once, all kinds of objects come out of that pass.

A document is read in pieces, by as many tasks as Spark cuts the file into, and its pieces meet in order in one task. It
is parsed there once; what leaves the task are the fragments of the wanted elements, which Spark's own ``from_xml`` turns
into columns later. The fragments are written to the shared folder, sorted by kind inside each file, so that reading one
kind skips the row groups of the others. No task holds a document.
"""

from __future__ import annotations

import codecs
import re
import sys
import tempfile
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain, groupby
from operator import or_
from xml.parsers import expat
from xml.sax.saxutils import quoteattr

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

# The functions travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes given to the parser at a time; finished elements leave the task after each.
STEP = 1 << 20
#: Row groups of the copy; small ones, so that one seldom holds two kinds.
ROW_GROUP = 8 << 20

#: What files are cut at; every element ends with it.
CUT = ">"
#: Ends of the names of files that Spark's text source would unpack.
PACKED = (".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst", ".zstd")
PIECES = "file long, start long, n long, path string, size long, content binary"
ELEMENTS = "source_file string, kind string, ord long, scope long, fragment string"
_DECLARED = re.compile(rb"""^\s*<\?xml[^>]*encoding\s*=\s*["']([A-Za-z0-9._-]+)["']""")
_TAG = re.compile(rb"""<[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>""")
_CONTROL = bytes(c for c in range(32) if c not in b"\t\n\r")


def _steps(content) -> Iterator[bytes]:
    """The bytes of a buffer, or of an iterator of buffers, by steps."""
    for some in content if isinstance(content, Iterator) else (content,):
        view = memoryview(some)
        for at in range(0, len(view), STEP):
            yield bytes(view[at : at + STEP])


def _decoded(steps: Iterator[bytes], name: str, head: bytes) -> Iterator[str]:
    """The text by steps; an error where the bytes are not of that encoding, or it is none of texts."""
    if codecs.lookup(name).name in ("utf-16", "utf-32") and head[:2] not in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE):
        name += "-le" if sys.byteorder == "little" else "-be"  # what decoding the whole at once assumes
    decoder = codecs.getincrementaldecoder(name)()
    for part, last in chain(((x, False) for x in steps), [(b"", True)]):
        some = decoder.decode(part, last)
        if not isinstance(some, str):
            raise LookupError(name)
        yield some


def _again(content, steps: Iterator[bytes]) -> Callable[[], Iterator[bytes]]:
    """What gives the steps as often as it is called; those of an iterator are kept in a file of the task meanwhile."""
    if not isinstance(content, Iterator):
        return lambda: _steps(content)
    kept = tempfile.TemporaryFile()
    for some in steps:
        kept.write(some)

    def read():
        kept.seek(0)
        return iter(lambda: kept.read(STEP), b"")

    return read


def as_utf8(content) -> tuple[Iterator[bytes], str | None]:
    """The document by steps in UTF-8 without control characters, and the encoding the parser must assume.

    ``content`` is any buffer, or an iterator of buffers; no second copy of it is made in memory. What cannot be decoded is
    returned as it is: the parser then says what is wrong with it.
    """
    steps, first, head = _steps(content), [], b""
    while len(head) < 400 and (some := next(steps, None)) is not None:
        first.append(some)
        head += some[: 400 - len(head)]
    steps = chain(first, steps)
    declared = _DECLARED.match(head)
    name = "utf-16" if head[:2] in (b"\xff\xfe", b"\xfe\xff") else declared.group(1).decode().lower() if declared else "utf-8"
    if name in ("utf-8", "us-ascii"):
        return (some.translate(None, _CONTROL) for some in steps), "utf-8"
    again = _again(content, steps)
    try:
        for _ in _decoded(again(), name, head):
            pass
    except (LookupError, ValueError, TypeError):
        return again(), None
    return (some.encode().translate(None, _CONTROL) for some in _decoded(again(), name, head)), "utf-8"


class Fragments:
    """The wanted elements of one document, in one pass.

    ``kinds``: tag -> (kind, attribute that a definition carries). An element with that attribute defines an object; one
    without it, or with ``Ref``, only points at it. Where the attribute is "", all elements are taken. ``scopes``: kinds that hold others and may be nested; every element names the innermost one
    around it by its number. Their value lists the children that are kept of them, or is None where all are. Kinds in
    ``once`` are taken from the first definition of an id. Bytes before the first element that is still open are let go,
    so the memory needed is that of the largest wanted element.
    """

    def __init__(self, content, kinds: dict, scopes: dict, once=()):
        self.steps, self.encoding = as_utf8(content)
        self.content, self.base = bytearray(), 0  # the bytes that may still be cut from, and the number of the first
        self.kinds, self.scopes, self.once = kinds, scopes, set(once)
        self.parser = expat.ParserCreate(self.encoding)
        self.parser.StartElementHandler, self.parser.EndElementHandler = self.start, self.end
        self.parser.EntityDeclHandler = self.refuse
        self.depth = self.number = 0
        self.open: list[tuple] = []  # depth, kind, tag, attributes, first byte, number, scope
        self.around: list[tuple] = []  # depth, number, names of children to keep, children kept of the scopes that are open
        self.heads: list[int] = []  # first bytes of the kept children that are open
        self.seen: set = set()
        self.done: list[tuple] = []

    def refuse(self, name, *_) -> None:
        raise ValueError(f"the document declares an entity: {name}")

    def start(self, tag: str, attributes: dict) -> None:
        self.depth += 1
        at = self.parser.CurrentByteIndex
        if self.around and self.depth == self.around[-1][0] + 1 and tag in self.around[-1][2]:
            self.heads.append(at)
        wanted = self.kinds.get(tag)
        if wanted is None or (wanted[1] and ("Ref" in attributes or wanted[1] not in attributes)):
            return
        kind, key = wanted
        if kind in self.once:
            known = (kind, attributes[key])
            if known in self.seen:
                return
            self.seen.add(known)
        self.number += 1
        self.open.append((self.depth, kind, tag, attributes, at, self.number, self.around[-1][1] if self.around else None))
        if kind in self.scopes:
            self.around.append((self.depth, self.number, self.scopes[kind] or (), []))

    def whole(self, first: int, last: int) -> bytes:
        """The element that starts at ``first``; ``last`` is where its end tag starts, if it has one."""
        first, last = first - self.base, last - self.base
        stop = _TAG.match(self.content, first).end()
        if self.content[stop - 2 : stop] != b"/>":
            stop = self.content.index(b">", last) + 1
        return bytes(self.content[first:stop])

    def release(self) -> None:
        """Let go of what no open element starts in; the parser may still be inside the element it saw last."""
        at = self.parser.CurrentByteIndex
        cut = [first for _, kind, _, _, first, *_ in self.open if self.scopes.get(kind) is None][:1]
        least = min([max(at, self.base), *cut, *self.heads[:1]])
        del self.content[: least - self.base]
        self.base = least

    def end(self, tag: str) -> None:
        at = self.parser.CurrentByteIndex
        if self.around and self.depth == self.around[-1][0] + 1 and tag in self.around[-1][2]:
            self.around[-1][3].append(self.whole(self.heads.pop(), at))
        if self.open and self.open[-1][0] == self.depth:
            _, kind, tag, attributes, first, number, scope = self.open.pop()
            kept = self.around.pop()[3] if kind in self.scopes else []
            if self.scopes.get(kind) is not None:
                stated = "".join(f" {k}={quoteattr(v)}" for k, v in attributes.items())
                fragment = f"<{tag}{stated}>".encode() + b"".join(kept) + f"</{tag}>".encode()
            else:
                fragment = self.whole(first, at)
            self.done.append((kind, number, scope, fragment.decode()))
        self.depth -= 1

    def rows(self) -> Iterator[list[tuple]]:
        """Finished elements by steps; the last row is the document itself with its fault, or None."""
        fault = None
        try:
            for some in self.steps:
                self.content += some
                self.parser.Parse(some, False)
                self.release()
                if self.done:
                    yield self.done
                    self.done = []
            self.parser.Parse(b"", True)
        except (expat.ExpatError, ValueError, LookupError) as error:
            fault = str(error)
        yield [*self.done, ("document", 0, None, fault)]


def _pieces(batches) -> Iterator[pa.RecordBatch]:
    """Rows of ``PIECES`` from what lies between the cuts of files: for each part of a file its bytes, and how many they are.

    The cut after the last piece of a file is added as well, whether it stands there or not.
    """
    names = [f.split()[0] for f in PIECES.split(", ")]
    types = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.binary()]
    cut = CUT.encode()

    def row(at, start, n, size, content):
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((at[0], start, n, None, size, content), types)], names=names)

    at, n, size = None, 0, 0
    for b in batches:
        columns = [b.column(c).to_numpy() for c in range(2)]
        changed = sum(c[1:] != c[:-1] for c in columns) if b.num_rows else ()
        cuts = [0, *(k + 1 for k, x in enumerate(changed) if x), b.num_rows] if b.num_rows else [0]
        for first, end in zip(cuts[:-1], cuts[1:]):
            now = tuple(int(c[first]) for c in columns)
            if now != at:
                if at is not None:
                    yield row(at, -1, at[1] + 1, size, None)
                at, n, size = now, 0, 0
            content = cut.join([*b.column(2).slice(first, end - first).to_pylist(), b""])
            yield row(at, at[1], n, None, content)
            n, size = n + 1, size + len(content)
    if at is not None:
        yield row(at, -1, at[1] + 1, size, None)


def _documents(batches) -> Iterator[tuple[str, Iterator[bytes]]]:
    """Path and bytes of each file, from rows of ``PIECES`` in order.

    Of the rows that start at -1 the first has the path and the size of the file, the others the sizes of its parts as read.
    """
    rows = (r for b in batches for r in zip(*(b.column(c) for c in range(b.num_columns))))

    def bytes_of(pieces):
        path, total = (x.as_py() for x in next(pieces)[3:5])
        yield path
        first, size = None, 0
        for first in pieces:
            if first[1].as_py() >= 0:
                break
            size += first[4].as_py()
            first = None
        # The reader drops a byte order mark of three bytes; the cut that was added last may not be there.
        over = total - size
        if over >= 2:
            yield b"\xef\xbb\xbf"
        left = size - (over in (-1, 2))
        for r in chain([first] if first else [], pieces):
            view = memoryview(r[5].as_buffer())[:left]
            left -= len(view)
            yield view

    for _, pieces in groupby(rows, key=lambda r: r[0].as_py()):
        content = bytes_of(pieces)
        yield next(content), content


def _read(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows of ``PIECES`` of all files; a file that the text source would unpack is one piece, as it is."""
    names = [c.split()[0] for c in PIECES.split(", ")]
    file = F.xxhash64("_metadata.file_path")
    listed = spark.read.format("binaryFile").load(paths)
    packed = reduce(or_, [F.col("_metadata.file_name").endswith(end) for end in PACKED])

    def rows(df, start, n, path=None, size=None, content=None):
        given = [file, F.lit(start), F.lit(n), *[F.lit(None) if c is None else F.col(c) for c in (path, size, content)]]
        return df.select(*[c.cast(f.split()[1]).alias(name) for c, name, f in zip(given, names, PIECES.split(", "))])

    text = spark.read.option("lineSep", CUT).text(paths).where(~packed).select(
        file.alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    whole = listed.where(packed)
    return rows(listed, -1, 0, "path", "length").union(rows(whole, -1, 1, size="length")).union(rows(whole, 0, 0, content="content")).union(
        text.mapInArrow(_pieces, PIECES))


def elements(spark: SparkSession, paths: str | list[str], kinds: dict, scopes: dict, once=()) -> DataFrame:
    """source_file, kind, ord, scope, fragment of all wanted elements of all documents: one scan, written once.

    ``ord`` is the element's number in its document, ``scope`` the number of the innermost scope around it. A row of kind
    ``document`` per file has the reason why it is not well-formed, or NULL. Of a broken file, the elements before the
    fault are there. The rows lie in the shared folder.
    """

    def scan(batches):
        names = [f.split()[0] for f in ELEMENTS.split(", ")]
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for path, content in _documents(batches):
            for some in Fragments(content, kinds, scopes, once).rows():
                columns = [[path] * len(some), *zip(*some)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    pieces = _read(spark, paths).repartition("file").sortWithinPartitions("file", "start", "n")
    rows = pieces.mapInArrow(scan, ELEMENTS).sortWithinPartitions("kind", "source_file", "ord")
    return stored(rows, "elements", **{"parquet.block.size": str(ROW_GROUP)})


def document_status(found: DataFrame, pair_id: Column) -> DataFrame:
    """pair_id, source_file, parse_error (NULL for a good document): one row per file of :func:`elements`."""
    return found.where("kind = 'document'").select(pair_id.alias("pair_id"), "source_file", F.col("fragment").alias("parse_error"))
