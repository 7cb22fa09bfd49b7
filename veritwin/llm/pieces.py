"""SentencePiece encoding and decoding as a relational lattice.

Every distinct word of the corpus is encoded once: its substrings up to the longest piece are exploded and equi-joined
to the piece table, the edges that remain are grouped by word, and a higher-order ``aggregate`` folds them into the best path
(largest sum of piece scores; among equal sums the longer last piece). A character without a piece becomes its UTF-8 byte
pieces.

Texts get their words' ids back without a shuffle for frequent words, whose ids are broadcast (at most ``HEAD`` words).
The others travel as (text hash, word) to a join with the lattice's result and come back grouped by text hash.
Texts themselves travel as word numbers, compressed.

A blank before the text and each blank within it belongs to the word that follows, as in the pieces. Words end where
no piece can reach over: at blanks, and between letters and other characters if the piece table never
mixes them. The lattice of a word of more than ``LONGEST`` characters would be one large row, so such a word is not exploded:
``fold`` goes over it once with the best scores of the last characters, as many as the longest piece has. Its path is the same.
"""

from __future__ import annotations

import math
import re
from array import array
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_table
from .tokens import vocabulary_path
from .vocabulary import head, word_counts

LONGEST = 256
#: Partitions of the lattice per shuffle partition.
SPREAD = 8
HEAD = 1 << 18
#: Texts that are Python objects at a time, and blank-separated units whose words' numbers a task remembers.
AT_ONCE, REMEMBERED = 2000, 1 << 17
#: Word characters other than digits, the superscript ones and fractions included; and all others but the blank.
LETTERS = r"[^\W\d_\xb2\xb3\xb9\xbc-\xbe]"
OTHERS = rf"(?:(?!{LETTERS})[^\x20])"


class Pieces(NamedTuple):
    """``texts`` by id, a blank for the word mark; ``scores``; ids of the 256 byte pieces; whether a piece is usable."""

    texts: list[str]
    scores: list[float]
    bytes_: list[int]
    usable: list[bool]

    @property
    def mixed(self) -> bool:
        """Whether some piece reaches over a border between letters and others."""
        return any(u and len(re.findall(_pattern(False), t)) > 1 for t, u in zip(self.texts, self.usable))


def load(path: str | None = None) -> Pieces:
    """The piece table of a SentencePiece model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path("piece_bpe_32k.model"))
    ids = range(model.get_piece_size())
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
    raw = [model.id_to_piece(i) for i in ids]
    byte_ids = {int(raw[i][3:5], 16): i for i in ids if model.is_byte(i)}
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte pieces")
    return Pieces(
        [p.replace("▁", " ") for p in raw], [model.get_score(i) for i in ids], [byte_ids[b] for b in range(256)],
        [not special[i] and not model.is_byte(i) for i in ids])


def _pattern(mixed: bool) -> str:
    return r"\x20*[^\x20]+|\x20+" if mixed else rf"\x20*{LETTERS}+|\x20*{OTHERS}+|\x20+"


class Splitter:
    """Text -> words; their concatenation is a blank and the text.

    A unit is what one or more blanks lead in, without the first of them; equal units have equal words. No word is cut;
    those of more than ``longest`` characters are folded instead of exploded.
    """

    def __init__(self, mixed: bool, longest: int = LONGEST):
        self.find, self.longest = re.compile(_pattern(mixed)).findall, longest
        self.loose = re.compile(r"\x20+[^\x20]+|\x20+").findall

    def units(self, text: str | None) -> list[str]:
        if not text:
            return []
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [u[1:] for u in self.loose(" " + text)]
        return text.split(" ")

    def parts(self, unit: str) -> list[str]:
        return self.find(" " + unit)

    def __call__(self, text: str | None) -> list[str]:
        return [w for u in self.units(text) for w in self.parts(u)]


def best_pieces(pieces: Pieces) -> dict[str, tuple[float, int]]:
    """Text -> score and id of the usable pieces; of equal texts the best score, then the smallest id."""
    best: dict[str, tuple[float, int]] = {}
    for k, (text, score) in enumerate(zip(pieces.texts, pieces.scores)):
        if pieces.usable[k] and (text not in best or (score, -k) > (best[text][0], -best[text][1])):
            best[text] = (score, k)
    return best


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """piece, id, score: one row per usable piece."""
    rows = [(t, k, s) for t, (s, k) in best_pieces(pieces).items()]
    return spark.createDataFrame(rows, "piece string, id int, score double")


def fold_word(word: str, best: dict[str, tuple[float, int]], longest: int, unknown: float, bytes_: list[int]) -> np.ndarray:
    """Ids of the best path of one word, by the lattice's rules; holds a width per character and ``longest`` scores."""
    widths = np.zeros(len(word) + 1, np.int32)
    scores = [0.0] * (longest + 1)  # of the paths over the last characters, by their place modulo longest + 1
    ring = longest + 1
    for end in range(1, len(word) + 1):
        top, width = -math.inf, 1
        for size in range(min(longest, end), 0, -1):
            found = best.get(word[end - size : end])
            if found is None and size > 1:
                continue
            score = scores[(end - size) % ring] + (unknown if found is None else found[0])
            if score > top:
                top, width = score, size
        scores[end % ring], widths[end] = top, width
    ids, end = array("i"), len(word)
    while end:
        piece = word[end - widths[end] : end]
        found = best.get(piece)
        if found is None:
            ids.extend(bytes_[b] for b in reversed(piece.encode()))
        else:
            ids.append(found[1])
        end -= int(widths[end])
    return np.frombuffer(ids, np.int32)[::-1]


def fold(words: DataFrame, pieces: Pieces) -> DataFrame:
    """word (distinct, not empty) -> ids of its best path, one word at a time."""
    longest = max((len(t) for t, u in zip(pieces.texts, pieces.usable) if u), default=1)
    unknown = min(pieces.scores) - 10.0
    shared = words.sparkSession.sparkContext.broadcast((best_pieces(pieces), pieces.bytes_))

    def fn(batches):
        best, bytes_ = shared.value
        for b in batches:
            for k in range(b.num_rows):
                ids = fold_word(b.column("word")[k].as_py(), best, longest, unknown, bytes_)
                column = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column("word").slice(k, 1), column], names=["word", "ids"])

    return words.select("word").mapInArrow(fn, "word string, ids array<int>")


def lattice(words: DataFrame, pieces: Pieces, others: tuple[str, ...] = (), longest_word: int = LONGEST) -> DataFrame:
    """word (distinct, not empty) -> ids of its best path; ``others`` are columns of a word to keep.

    If ``words`` is partitioned by word, nothing is shuffled: the piece table, bounded by its file, is broadcast.
    Words of more than ``longest_word`` characters stay with null ids, for ``fold``.
    """
    longest = max((len(t) for t, u in zip(pieces.texts, pieces.usable) if u), default=1)
    unknown = min(pieces.scores) - 10.0
    size = F.when(F.length("word") <= longest_word, F.length("word")).otherwise(1)
    spans = (
        words.select("word", *others, F.explode(F.sequence(F.lit(1), size)).alias("start"))
        .select("word", *others, "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), size - F.col("start") + 1))).alias("width"))
        .withColumn("piece", F.substring("word", F.col("start"), F.col("width")))
    )
    table = F.broadcast(piece_table(words.sparkSession, pieces))
    # A character without a piece: the byte pieces of its UTF-8 form.
    form = F.hex(F.encode(F.col("piece"), "UTF-8"))
    byte_ids = F.array(*map(F.lit, pieces.bytes_))
    bytes_ = F.transform(
        F.split(F.regexp_replace(form, "(..)(?=.)", "$1 "), " "), lambda pair: F.get(byte_ids, F.conv(pair, 16, 10).cast("int")))
    edges = spans.join(table, "piece", "left").where("id is not null or width = 1").select(
        "word", *others, (F.col("start") + F.col("width")).alias("end"), "start",
        F.when(F.col("id").isNull(), bytes_).otherwise(F.array("id")).alias("ids"),
        F.when(F.col("id").isNull(), unknown).otherwise(F.col("score")).alias("score"))
    grouped = edges.groupBy("word").agg(
        F.sort_array(F.collect_list(F.struct("end", "start", "ids", "score"))).alias("edges"), *[F.first(c).alias(c) for c in others])
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")))

    def step(best: Column, edge: Column) -> Column:
        # best[k] is the best path over k characters. Edges come by end, so an edge opens a new end or may improve the last
        # one; most do neither, so the sum of scores is compared before any path is made.
        def path() -> Column:
            before = F.get(best, edge["start"] - 1)
            return F.array(F.struct((before["score"] + edge["score"]).alias("score"), F.concat(before["ids"], edge["ids"]).alias("ids")))

        better = F.get(best, edge["start"] - 1)["score"] + edge["score"] > F.get(best, F.size(best) - 1)["score"]
        return F.when(F.size(best) < edge["end"], F.concat(best, path())).when(
            better, F.concat(F.slice(best, 1, F.size(best) - 1), path())).otherwise(best)

    folded = F.aggregate("edges", start, step, lambda best: F.element_at(best, -1)["ids"])
    return grouped.select("word", *others, F.when(F.length("word") <= longest_word, folded).alias("ids"))


class Numbers(dict):
    """Unit -> numbers of its words: places in the broadcast list, or beyond it as words come."""

    def __init__(self, known: list[str], splitter: Splitter):
        super().__init__()
        self.places, self.splitter, self.known = dict(zip(known, range(len(known)))), splitter, len(known)
        self.later: dict[str, int] = {}
        self.more: list[str] = []
        self.size = 0

    def __missing__(self, unit: str) -> tuple[int, ...]:
        out = []
        for word in self.splitter.parts(unit):
            n = self.places.get(word)
            if n is None:
                n = self.later.get(word)
                if n is None:
                    n = self.later[word] = self.known + len(self.more)
                    self.more.append(word)
            out.append(n)
        self.size += len(unit)
        self[unit] = found = tuple(out)
        return found

    def of(self, text: str | None) -> np.ndarray:
        return np.fromiter(chain.from_iterable(map(self.__getitem__, self.splitter.units(text))), np.int64)

    def trim(self) -> None:
        """Forgets what has grown beyond its bound; between batches only, as numbers change."""
        if len(self) > REMEMBERED or len(self.more) > REMEMBERED or self.size > 256 * REMEMBERED:
            self.clear()
            self.later, self.more, self.size = {}, [], 0


def text_key(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8")) - (1 << 63) if text else 0


def slices(batches):
    for b in batches:
        for k in range(0, b.num_rows, AT_ONCE):
            yield b.slice(k, AT_ONCE)


def encode(docs: DataFrame, pieces: Pieces, doc_id: str = "doc_id", text: str = "text", head_words: int = HEAD, longest: int = LONGEST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_pieces, ids, round_trip (the ids decode to the text).

    A null or empty text has no words and empty ids. Repeated rows get a row each; texts that are equal share the
    ids of their words. Null ids stay; an empty table gives an empty result; other columns are ignored.
    """
    splitter = Splitter(pieces.mixed, longest)
    # The lattice follows the sums by word without a shuffle: rows of one word stay in its partition.
    # A word makes some 20 edges, so there are more and smaller partitions than for words alone.
    partitions = SPREAD * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = word_counts(docs, text, splitter.units, splitter.parts, partitions=partitions)
    known = shared_table(lattice(counts, pieces, ("n",), longest), "lattice")
    # Long words are never in the head, whose size is bounded by words of at most ``longest`` characters.
    often, seldom = head(known.where("ids is not null"), head_words)
    seldom = seldom.select("word", "ids").union(fold(known.where("ids is null"), pieces))
    frequent = often.select("word", "ids").toArrow()
    names = frequent.column("word").combine_chunks()
    lists = frequent.column("ids").combine_chunks()
    context = docs.sparkSession.sparkContext
    shared_names = context.broadcast(names)
    shared_ids = context.broadcast((lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()))
    n_known = len(names)
    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def open_words(batches):
        numbers = Numbers(shared_names.value.to_pylist(), splitter)
        for b in slices(batches):
            numbers.trim()
            keys, found = [], []
            for t in b.column("text").to_pylist():
                at = numbers.of(t)
                rest = np.unique(at[at >= n_known]).tolist()
                keys += [text_key(t)] * len(rest)
                found += [numbers.more[k - n_known] for k in rest]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.string())], names=["key", "word"])

    def skeletons(batches):
        numbers = Numbers(shared_names.value.to_pylist(), splitter)
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in slices(batches):
            numbers.trim()
            keys, lines, rest, n_words = [], [], [], []
            for t in b.column("text").to_pylist():
                at = numbers.of(t)
                n_words.append(len(at))
                beyond = np.flatnonzero(at >= n_known)
                own, place = np.unique(at[beyond], return_inverse=True)
                at[beyond] = n_known + place
                keys.append(text_key(t))
                lines.append(squeeze.compress(at.astype("<u4").tobytes()))
                rest.append([numbers.more[k - n_known] for k in own.tolist()])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(keys, pa.int64()), pa.array(n_words, pa.int64()), pa.array(lines, pa.binary()), pa.array(rest, pa.list_(pa.string()))],
                names=["doc_id", "key", "n_words", "line", "rest"])

    opened = chosen.select("text").mapInArrow(open_words, "key long, word string")
    back = opened.join(seldom.select("word", "ids"), "word").groupBy("key").agg(F.collect_set(F.struct("word", "ids")).alias("found"))
    lines = chosen.mapInArrow(skeletons, f"doc_id {kind}, key long, n_words long, line binary, rest array<string>")
    table = [t.encode() for t in pieces.texts]
    for value, k in enumerate(pieces.bytes_):
        table[k] = bytes([value])

    def fill(batches):
        offsets, flat = shared_ids.value
        expand = zstandard.ZstdDecompressor()
        for b in slices(batches):
            lengths, values, same = [], [], []
            for key, line, rest, found in zip(*(b.column(c).to_pylist() for c in ("key", "line", "rest", "found"))):
                at = np.frombuffer(expand.decompress(line), "<u4").astype(np.int64)
                own = {f["word"]: f["ids"] for f in found or ()}
                more = [own[w] for w in rest]
                ends = np.concatenate([offsets, offsets[-1] + np.cumsum([len(m) for m in more], dtype=np.int64)]) if more else offsets
                tail = np.array([i for m in more for i in m], np.int32)
                count = ends[at + 1] - ends[at]
                where = np.repeat(ends[at] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                inner = where < len(flat)
                ids = np.empty(len(where), np.int32)
                ids[inner] = flat[where[inner]]
                ids[~inner] = tail[where[~inner] - len(flat)]
                lengths.append(len(ids))
                values.append(ids)
                same.append(text_key(decode_ids(ids.tolist(), table)) == key)
            ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            column = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values) if values else np.empty(0, np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_words"), pa.array(lengths, pa.int64()), column, pa.array(same)],
                names=["doc_id", "n_words", "n_pieces", "ids", "round_trip"])

    return lines.join(back, "key", "left").mapInArrow(fill, f"doc_id {kind}, n_words long, n_pieces long, ids array<int>, round_trip boolean")


def decode_ids(ids: list[int], table: list[bytes]) -> str:
    """The text of ids: their bytes without the blank that encoding put before the text."""
    return b"".join(map(table.__getitem__, ids))[1:].decode("utf-8", "replace")


def decode(encoded: DataFrame, pieces: Pieces, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, text: null ids give a null text, empty ids an empty one. Ids outside the table are an error."""
    table = [t.encode() for t in pieces.texts]
    for value, k in enumerate(pieces.bytes_):
        table[k] = bytes([value])

    def fn(batches):
        for b in slices(batches):
            texts = [None if i is None else decode_ids(i, table) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(texts, pa.string())], names=["key", "text"])

    kind = encoded.schema[key].dataType.simpleString()
    out = encoded.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ids}`").alias("ids")).mapInArrow(fn, f"key {kind}, text string")
    return out.withColumnRenamed("key", key)
