"""Benchmark decontamination: one automaton over normalised items, each text scanned once.

A window is 13 consecutive words of an item (a shorter item is one window). Storing every window in
the automaton would store each item 13 times, so the automaton holds seeds instead: any 13 consecutive
words contain a whole block of 7 that starts at a multiple of 7 within the item. A seed that the scan
finds is widened word by word to the longest common run of document and item; runs of 13 words or
more are the occurrences of windows. The automaton is linear in the text of the items.

The items are cut into shards of at most ``SHARD_BYTES`` normalised bytes (one longer item is a shard of
its own); each shard is one automaton, broadcast, and one pass of a chain without any shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from .common import ALNUM, scan, utf8

WINDOW = 13
SEED = 7
SHARD_BYTES = 4 << 20
#: The scan feeds a text to the automaton in pieces of this size, so that no copy of a whole text is made.
PIECE = 1 << 20


class Shard(NamedTuple):
    """Distinct normalised items; ids[k] lists the item ids that share the words items[k]."""

    automaton: ahocorasick.Automaton
    items: list[list[bytes]]
    ids: list[list]


def build(pairs: Iterator[tuple[list[bytes], list]]) -> Shard:
    """Seeds of distinct items; a seed's value lists its places (item, first word)."""
    items, ids, seeds = [], [], {}
    for words, own in pairs:
        k = len(items)
        items.append(words)
        ids.append(own)
        starts = [0] if len(words) < WINDOW else range(0, len(words) - SEED + 1, SEED)
        for at in starts:
            seed = words if len(words) < WINDOW else words[at : at + SEED]
            seeds.setdefault(b" " + b" ".join(seed) + b" ", []).append((k, at, len(seed)))
    automaton = ahocorasick.Automaton()
    for seed, places in seeds.items():
        automaton.add_word(seed.decode("latin-1"), places)
    automaton.make_automaton()
    return Shard(automaton, items, ids)


def runs(shard: Shard, text: bytes) -> tuple[int, list[tuple[int, int, int]]]:
    """The number of words, and (item, first, end) of every maximal run of words that contains a window."""
    words = text.translate(ALNUM).split()
    if not shard.items or not words:
        return len(words), []
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")  # one code point a byte
    found, search = [], shard.automaton.iter("")
    for at in range(0, len(line), PIECE):
        search.set(line[at : at + PIECE], at == 0)
        found += search
    if not found:
        return len(words), []
    spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    out, reached = [], {}
    ends = np.searchsorted(spaces, [e for e, _ in found])  # the space after word k - 1 is number k
    for end, (_, places) in zip(ends.tolist(), found):
        for k, at, size in places:
            first, item = end - size, shard.items[k]
            if reached.get((k, first - at), -1) >= end:
                continue  # this seed lies in a run that is already known
            i, j, last, to = first, at, end, at + size
            while i and j and words[i - 1] == item[j - 1]:
                i, j = i - 1, j - 1
            while last < len(words) and to < len(item) and words[last] == item[to]:
                last, to = last + 1, to + 1
            reached[k, first - at] = last
            if last - i >= min(WINDOW, len(item)):
                out.append((k, i, last))
    return len(words), out


def word_spans(text: str) -> list[tuple[int, int]]:
    """Code point offsets of the words of a text, in order."""
    return [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]


def shards_of(benchmark: DataFrame, id_col: str, text_col: str, shard_bytes: int) -> Iterator[Shard]:
    """One shard at a time on the driver; equal items come together in the order of their texts."""
    rows = benchmark.select(benchmark[id_col].alias("i"), benchmark[text_col].alias("t")).na.drop("any", subset=["t"])
    held, size = {}, 0
    for row in rows.toLocalIterator():
        words = tuple(utf8(row.t).translate(ALNUM).split())
        if not words:
            continue
        cost = sum(map(len, words)) + len(words)
        if held and words not in held and size + cost > shard_bytes:
            yield build((list(w), ids) for w, ids in held.items())
            held, size = {}, 0
        size += cost * (words not in held)
        held.setdefault(words, []).append("" if row.i is None else row.i)
    if held:
        yield build((list(w), ids) for w, ids in held.items())


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shard_bytes: int = SHARD_BYTES,
    offsets: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``offsets=True`` adds ``spans``: merged hit runs as start and end offsets in the original text, in code points.
    A null or wordless text has no words and is clean; null and wordless items have no window. Repeated
    documents get a row each; repeated items count by distinct item_id. Empty tables give empty or clean
    results. Other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    final = f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    if offsets:
        final += ", spans array<struct<start:int,end:int>>"
    between = f"doc_id {kind}, text string, hits array<struct<first:int,last:int>>, items array<string>"
    state, columns = docs, {"doc_id": doc_id, "text": text}
    shards = shards_of(benchmark, item_id, item_text, shard_bytes)
    shard = next(shards, None) or build(iter(()))
    while shard is not None:
        after = next(shards, None)
        shared = docs.sparkSession.sparkContext.broadcast(tuple(shard))  # plain, so that executors need no copy of this package
        state = scan(state, columns, _pass(shared, after is None, offsets), final if after is None else between)
        columns, shard = {c: c for c in ("doc_id", "text", "hits", "items")}, after
    return state


def _pass(shared, last: bool, offsets: bool):
    """One shard's pass; the last one also sums up."""

    def fn(batches):
        shard = Shard(*shared.value)
        for ids, texts, *earlier in batches:
            hits, items = earlier or ([[] for _ in ids], [[] for _ in ids])
            n_words = []
            for n, text in enumerate(texts):
                words, found = runs(shard, utf8(text))
                n_words.append(words)
                if found:
                    hits[n] = hits[n] + [{"first": a, "last": b} for _, a, b in found]
                    items[n] = items[n] + [str(i) for k in {k for k, _, _ in found} for i in shard.ids[k]]
            yield summed(ids, texts, n_words, hits, items, offsets) if last else [ids, texts, hits, items]

    return fn


def merged(hits: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((h["first"], h["last"]) for h in hits):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def summed(ids, texts, n_words, hits, items, offsets: bool) -> list[list]:
    joined = [merged(h) for h in hits]
    n_hit = [sum(b - a for a, b in h) for h in joined]
    own = [sorted(set(i)) for i in items]
    out = [
        ids, n_words, n_hit, [len(i) for i in own], [hashlib.sha256(",".join(i).encode()).hexdigest() for i in own],
        [h > 0 and 20 * h >= n for h, n in zip(n_hit, n_words)],
    ]
    if offsets:
        spans = []
        for text, found in zip(texts, joined):
            at = word_spans(text) if found else []
            spans.append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in found])
        out.append(spans)
    return out
