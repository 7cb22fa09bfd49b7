"""Token ids of documents in ORC files.

Rows are dealt into ranges of ascending document ids, one file each. A file's integers are run-length encoded; its
stripes have row indexes and Bloom filters on the document id. So a large file is read by several tasks, stripe by
stripe, and a lookup of documents skips files, stripes and groups of rows by their metadata. A long document goes on in
further rows, because the writer holds a thousand rows at a time.

A task encodes a text word by word where the encoding can't reach over the border: before a single blank between two
characters that are no white space. Each distinct word goes to the tokenizers library once per worker and while the memory of
words lasts; the ids are those of the whole text.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .tokens import vocabulary_path

#: The id behind each document.
END = 0
STRIPE_BYTES, ROWS_PER_INDEX, FALSE_POSITIVES = 16 << 20, 1000, 0.01
#: Ids of a row at most; rows between two looks of the writer at its memory.
ROW_IDS, ROWS_PER_LOOK = 1 << 14, 100
#: Characters of texts that are Python objects at a time; bytes that the memory of words may hold; words of a call.
CHARS_AT_ONCE, HELD_BYTES, WORDS_AT_ONCE = 1 << 23, 48 << 20, 4000

BORDER = re.compile(r"(?<=\S)(?= \S)")
#: What ``\s`` is in Python; texts with two of them in a row or one at the end.
SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ODD = rf"{SPACE}(?:{SPACE}|\z)"


class Encoder:
    """Texts to ids, with a memory of words.

    Words that follow a blank are columns: each distinct one of some texts is looked up once, whatever their number.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        sizes = {i: len(t) for t, i in self.model.get_vocab(with_added_tokens=True).items()}
        self.bytes_of = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)])  # a byte is one character of a token
        self.forget()

    def forget(self) -> None:
        self.inner = pa.array([], pa.string())  # words that a blank leads in, without it
        self.inner_at = np.empty(0, np.int64)  # and their numbers
        self.again = np.empty(0, bool)  # whether they came again
        self.outer: dict[str, int] = {}  # other pieces of texts
        self.flat, self.starts, self.held = [], [], 0
        self.ids, self.at, self.size = np.empty(0, np.int32), np.zeros(1, np.int64), 0

    def trim(self) -> None:
        """Forgets words that have not come again, or all if the others are many."""
        kept = np.flatnonzero(self.again)
        words, at = self.inner.take(pa.array(kept)), self.inner_at[kept]
        ids, begin, sizes = self.ids, self.at[at], self.at[at + 1] - self.at[at]
        self.forget()
        if 2 * (held := words.nbytes + 40 * len(words)) > HELD_BYTES:
            return
        self.inner, self.inner_at, self.again = words, np.arange(len(words)), np.zeros(len(words), bool)
        self.ids = ids[np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        self.at, self.size, self.held = np.concatenate([[0], np.cumsum(sizes)]), len(words), held

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, pa.ListArray]:
        """What stands before the first border, and what follows each one, without the blank; texts in another order, which
        comes first."""
        column = pa.array(texts, pa.string())
        found = pc.match_substring_regex(column, ODD)
        odd = found.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(column.filter(pc.invert(found)), " ")
        if odd.any():
            cut = (BORDER.split(t) for t, o in zip(texts, odd) if o)
            lists = pa.concat_arrays([lists, pa.array([[first, *(w[1:] for w in rest)] for first, *rest in cut], lists.type)])
        return np.argsort(odd, kind="stable"), lists

    def _keep(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Stores the ids of new words, ``sizes`` of them each; the numbers of the words."""
        self.flat.append(ids)
        self.starts.append(sizes)
        self.size += len(sizes)
        return np.arange(self.size - len(sizes), self.size)

    def learn(self, firsts: list[str], words: pa.Array) -> np.ndarray:
        """``firsts`` begin a text; ``words`` are distinct and follow a blank. The numbers of ``words``."""
        outer = [w for w in set(firsts) if w not in self.outer]
        place = pc.index_in(words, value_set=self.inner)
        new = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
        unknown = words.take(pa.array(new))
        # Words that end in white space would run into the next one.
        ends = pc.utf8_slice_codeunits(unknown, -1, None)
        blank = pa.array([c for c in ends.unique().to_pylist() if c.isspace()], pa.string())
        apart = pc.is_in(ends, value_set=blank).to_numpy(zero_copy_only=False)
        n_apart = int(apart.sum())
        if n_apart:
            order = np.argsort(~apart, kind="stable")
            new, unknown = new[order], unknown.take(pa.array(order))
        size = pc.binary_length(unknown).to_numpy()[n_apart:] + 1
        inner = unknown.to_pylist()
        loose, inner = inner[:n_apart], inner[n_apart:]
        numbers = []
        for own, lead in ((outer, ""), (loose, " ")):
            for k in range(0, len(own), WORDS_AT_ONCE):
                some = own[k : k + WORDS_AT_ONCE]
                found = [e.ids for e in self.model.encode_batch_fast([lead + w for w in some], add_special_tokens=False)]
                n = self._keep(np.array([i for f in found for i in f], np.int32), np.array([len(f) for f in found]))
                if lead:
                    numbers.append(n)
                else:
                    self.outer.update(zip(some, n.tolist()))
        for k in range(0, len(inner), WORDS_AT_ONCE):
            some = inner[k : k + WORDS_AT_ONCE]
            line = " " + " ".join(some)
            ids = np.array(self.model.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.int32)
            # Words are told apart by the bytes of their tokens.
            ends = np.cumsum(size[k : k + WORDS_AT_ONCE])
            reached = np.cumsum(self.bytes_of[ids])
            if reached[-1] != ends[-1]:
                raise ValueError("the vocabulary is not a byte-level one")
            until = np.searchsorted(reached, ends) + 1
            numbers.append(self._keep(ids, np.diff(until, prepend=0)))
        out = np.empty(len(words), np.int64)
        old = place.is_valid().to_numpy(zero_copy_only=False)
        seen = place.drop_null().to_numpy()
        out[old] = self.inner_at[seen]
        self.again[seen] = True
        if numbers:
            out[new] = np.concatenate(numbers)
            self.inner = pa.concat_arrays([self.inner, unknown])
            self.inner_at = np.concatenate([self.inner_at, out[new]])
            self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        self.held += sum(len(w) + 160 for w in outer) + unknown.nbytes + 40 * len(unknown)
        if self.flat:
            sizes = np.concatenate(self.starts)
            self.ids = np.concatenate([self.ids, *self.flat])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
            self.flat, self.starts = [], []
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.held > HELD_BYTES:
            self.trim()
        order, lists = self.pieces(texts)
        offsets, values = lists.offsets.to_numpy(), lists.values
        firsts = values.take(pa.array(offsets[:-1])).to_pylist()
        follows = np.ones(len(values), bool)
        follows[offsets[:-1]] = False
        words = values.filter(pa.array(follows)).dictionary_encode()
        learnt = self.learn(firsts, words.dictionary)
        outer = np.array([self.outer[w] for w in firsts], np.int64)
        place = words.indices.to_numpy()
        begin, size = np.empty(len(values), np.int64), np.empty(len(values), np.int64)
        for column, at in ((begin, self.at[:-1]), (size, np.diff(self.at))):
            column[offsets[:-1]] = at[outer]
            column[follows] = at[learnt][place]
        out = [None] * len(texts)
        for t, a, b in zip(order.tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            sizes = size[a:b]
            where = np.repeat(begin[a:b] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            out[t] = self.ids[where]
        return out


def encoder_of(path: str, held: dict) -> Encoder:
    """The encoder in ``held``. A broadcast dict is one object of a Python worker, so tasks that follow each other there load the
    vocabulary once and share the memory of words."""
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def portions(text: str, size: int) -> Iterator[str]:
    """Parts of a text of about ``size`` characters, cut at borders only."""
    at = 0
    while len(text) - at > size and (found := BORDER.search(text, at + size)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def encoded(encoder: Encoder, texts: list[str | None], size: int = CHARS_AT_ONCE) -> Iterator[list[np.ndarray]]:
    """Ids of texts with the end id, in lists of consecutive texts."""
    held, chars = [], 0
    for text in texts:
        text = text or ""
        if held and chars + len(text) > size:
            yield [np.append(ids, np.int32(END)) for ids in encoder.encode(held)]
            held, chars = [], 0
        if len(text) > size:
            parts = [encoder.encode([p])[0] for p in portions(text, size)]
            yield [np.concatenate([*parts, np.array([END], np.int32)])]
        else:
            held.append(text)
            chars += len(text)
    if held:
        yield [np.append(ids, np.int32(END)) for ids in encoder.encode(held)]


def rows_of(ids: list[np.ndarray], start: int, row_ids: int) -> tuple[np.ndarray, dict]:
    """Index of the document of each row, and the columns of rows; ``start`` is the number of ids before them."""
    total = np.array([len(i) for i in ids], np.int64)
    rows = -(-total // row_ids)
    document = np.repeat(np.arange(len(ids)), rows)
    at = (np.arange(len(document)) - np.repeat(np.cumsum(rows) - rows, rows)) * row_ids
    ends = np.cumsum(np.minimum(row_ids, total[document] - at))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
    return document, {
        "first": pa.array((start + np.cumsum(total) - total)[document]), "total": pa.array(total[document]),
        "rows": pa.array(rows[document], pa.int32()), "at": pa.array(at), "ids": lists}


def write(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
    stripe_bytes: int = STRIPE_BYTES, rows_per_index: int = ROWS_PER_INDEX, row_ids: int = ROW_IDS,
) -> None:
    """Files under ``path`` with the ids of each row of ``docs``.

    part (number of the file), first (ids before the document in its file), total (its ids), rows (rows it takes), at (place of
    the row's first id in it), doc_id, ids. Null and empty texts are the end id alone. Documents are in ascending order of
    doc_id, null first; those that share one follow in the order of a hash of their texts. An empty table gives
    files without rows. Other columns are not read.
    """
    vocabulary = vocabulary or vocabulary_path("byte_bpe_50k.json")
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["part", "first", "total", "rows", "at", "doc_id", "ids"]
    # The last key only spreads rows of one document and text, whose order among themselves makes no difference.
    keys = ["doc_id", "h", "salt"]
    dealt = (
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
        .withColumns({"h": F.xxhash64("text"), "salt": F.monotonically_increasing_id()})
        .repartitionByRange(*keys).sortWithinPartitions(*keys).select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )

    shared = docs.sparkSession.sparkContext.broadcast({})

    def run(batches):
        encoder, start = encoder_of(vocabulary, shared.value), 0
        for b in batches:
            done = 0
            for ids in encoded(encoder, (t.as_py() for t in b.column("text"))):
                document, columns = rows_of(ids, start, row_ids)
                own = b.select(["part", "doc_id"]).slice(done, len(ids)).take(pa.array(document))
                columns |= {"part": own.column("part"), "doc_id": own.column("doc_id")}
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)
                start, done = start + sum(map(len, ids)), done + len(ids)
        pa.default_memory_pool().release_unused()

    rows = dealt.mapInArrow(run, f"part int, first long, total long, rows int, at long, doc_id {kind}, ids array<int>")
    options = {
        "orc.stripe.size": stripe_bytes, "orc.row.index.stride": rows_per_index, "orc.create.index": "true",
        "orc.rows.between.memory.checks": ROWS_PER_LOOK, "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": FALSE_POSITIVES,
    }
    rows.write.options(**options).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all files; stripes of one file go to several tasks."""
    return spark.read.orc(path)


def documents(rows: DataFrame) -> DataFrame:
    """part, first, doc_id, ids: one row per document. Stripes without long documents are skipped in the search for them."""
    one = rows.where("rows = 1").select("part", "first", "doc_id", "ids")
    parts = F.array_sort(F.collect_list(F.struct("at", "ids")))
    many = rows.where("rows > 1").groupBy("part", "first").agg(F.first("doc_id").alias("doc_id"), parts.alias("parts")).select(
        "part", "first", "doc_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
    return one.union(many)


def find(spark: SparkSession, path: str, doc_ids: list) -> DataFrame:
    """doc_id and ids of some documents: stripes and groups of rows are skipped by their bounds and Bloom filters."""
    return documents(read(spark, path).where(F.col("doc_id").isin(doc_ids))).select("doc_id", "ids")


class Stripe(NamedTuple):
    rows: int
    offset: int
    data_bytes: int
    index_bytes: int


def stripes(spark: SparkSession, file: str) -> list[Stripe]:
    """The stripes of one file, from its footer."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(file), jvm.org.apache.orc.OrcFile.readerOptions(conf))
    try:
        return [Stripe(s.getNumberOfRows(), s.getOffset(), s.getDataLength(), s.getIndexLength()) for s in reader.getStripes()]
    finally:
        reader.close()


def positions(rows: DataFrame) -> DataFrame:
    """doc_id, start (ids before it in all files), n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers).

    Ids before a file are sums over files, one row each; within a file the start is stored. Tokens are counted in the ids.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["part", "first", "doc_id", "n_tokens", "ids_crc32"]

    def run(batches):
        for b in batches:
            ids = b.column("ids")
            ends, flat = ids.offsets.to_numpy().astype(np.int64), ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(flat[x:y]) for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("first"), b.column("doc_id"), pa.array(np.diff(ends)), pa.array(crc, pa.int64())], names=names)

    each = documents(rows).mapInArrow(run, f"part int, first long, doc_id {kind}, n_tokens long, ids_crc32 long")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.where("at = 0").groupBy("part").agg(F.sum("total").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return each.join(files, "part").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def stored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Writes ``docs`` to the shared folder and reads the files back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    write(docs, path, doc_id, text, vocabulary)
    return read(spark, path)
