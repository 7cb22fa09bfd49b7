"""Near-duplicate documents by SuperMinHash, banding, verification on full shingle sets, and components.

SuperMinHash gives each element one random permutation of the signature's slots; slot k becomes the least rank plus
fraction with which any element visits it. Ranks of one element differ in all slots, which lowers the variance
against independent hashes. Work goes rank by rank over all elements of a document and stops as soon as every slot
holds a value below the next rank, because later ranks can't lower any.

Documents with equal sets form a class, which its smallest doc_id stands for. The pairs of a bucket of equal band
keys are never made as rows. Each bucket first compares its members with one of them, drawn by hash; the links found join
most of a bucket into one component. A bucket that still holds several components sends its members to the group of its
largest one. There, in blocks of bounded size, every member of another component is compared with all members of the group on full
sets, and only links come back. Two documents that share a bucket meet in such a group unless they are in one
component already, so no link that joins two components is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLAIN, scan, shared_table, utf8
from .components import components

SHINGLE = 5
#: 100 * intersection >= 75 * union.
PERCENT = 75
#: Two documents at the limit of 0.75 miss each other with a chance of (1 - 0.75 ** 5) ** 48 = 0.000002.
BANDS, ROWS = 48, 5
#: Elements whose permutations are held at a time, and words whose hashes are remembered.
ELEMENTS, REMEMBERED = 1 << 16, 1 << 17
#: Sizes of the two sides of a block in which components are compared.
GUESTS, ALL = 256, 1024
#: Buckets of the pre-filter of documents whose sets are needed; at most so many integers are broadcast.
FILTER = 1 << 20


class Hashes(dict):
    """Word -> 64-bit hash; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, hashes: Hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = utf8(text).translate(PLAIN).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k])
    return np.unique(out)


def superminhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """One row of ``slots`` values per set; sets must not be empty. Equal slots estimate the Jaccard similarity."""
    out = np.empty((len(sets), slots))
    start = 0
    while start < len(sets):
        stop, held = start, 0
        while stop < len(sets) and (stop == start or held + len(sets[stop]) <= ELEMENTS):
            held += len(sets[stop])
            stop += 1
        if held <= ELEMENTS:
            out[start:stop] = _signatures(sets[start:stop], slots)
        else:  # one set larger than a block: the least of its parts' values, slot by slot
            parts = np.array_split(sets[start], -(-held // ELEMENTS))
            out[start] = np.min([_signatures([p], slots, True)[0] for p in parts], axis=0)
        start = stop
    return out


def _signatures(sets: list[np.ndarray], slots: int, part: bool = False) -> np.ndarray:
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    element = np.concatenate(sets)
    values = np.full((len(sets), slots), np.inf)
    order = np.tile(np.arange(slots, dtype=np.uint16), (len(element), 1))
    line = np.arange(len(element))
    for rank in range(slots):
        # the next place of each element's permutation (a Fisher-Yates step) and its fraction
        draw = mix(element + np.uint64((2 * rank + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        pick = rank + (draw % np.uint64(slots - rank)).astype(np.int64)
        slot = order[line, pick]
        order[line, pick] = order[line, rank]
        fraction = (mix(draw) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        np.minimum.at(values.reshape(-1), owner * slots + slot, fraction + rank)
        open_sets = np.isinf(values).any(axis=1)
        if not open_sets.any():
            break
        keep = open_sets[owner]
        if keep.mean() < 0.7:
            owner, element, order = owner[keep], element[keep], order[keep]
            line = np.arange(len(element))
    return values


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    bits = signatures.view(np.uint64).reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), bands)).copy()
    for k in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, k])
    return key.view(np.int64)


def signatures(docs: DataFrame, doc_id: str, text: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set, and the band keys; the latter two are null without words."""

    def fn(batches: Iterator):
        hashes = Hashes()
        for ids, texts in batches:
            sets = [shingles(t, hashes) for t in texts]
            full = [k for k, s in enumerate(sets) if len(s)]
            digests, keys = [None] * len(ids), [None] * len(ids)
            if full:
                found = band_keys(superminhash([sets[k] for k in full], bands * rows), bands, rows)
                for k, own in zip(full, found):
                    digests[k], keys[k] = hashlib.md5(sets[k].tobytes(), usedforsecurity=False).digest(), own
            yield ids, [len(s) for s in sets], digests, keys

    kind = docs.schema[doc_id].dataType.simpleString()
    return scan(docs, {"doc_id": doc_id, "text": text}, fn, f"doc_id {kind}, n_shingles long, digest binary, keys array<long>")


def full_sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """node and its sorted shingle hashes, for the ids in ``wanted`` (node, distinct).

    The distinct hash buckets of the wanted ids, at most ``FILTER`` integers, go to all tasks first, so that
    only texts that may be wanted are shuffled to the exact join.
    """
    bucket = F.pmod(F.xxhash64("node"), F.lit(FILTER)).cast("int")
    own = docs.select(F.col(f"`{doc_id}`").alias("node"), F.col(f"`{text}`").alias("text")).where("node is not null")
    few = F.broadcast(wanted.select(bucket.alias("bucket")).distinct())
    near = own.withColumn("bucket", bucket).join(few, "bucket", "left_semi").drop("bucket")

    def fn(batches):
        hashes = Hashes()
        for ids, texts in batches:
            yield ids, [shingles(t, hashes).view(np.int64) for t in texts]

    kind = docs.schema[doc_id].dataType.simpleString()
    return scan(near.join(wanted, "node", "left_semi"), {"node": "node", "text": "text"}, fn, f"node {kind}, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return pairs.join(right, "b").join(left, "a").where(common * 100 >= union * percent).select("a", "b")


def across(placed: DataFrame, sets: DataFrame, percent: int = PERCENT, guests: int = GUESTS, every: int = ALL) -> DataFrame:
    """Links (a, b) between different components of ``placed`` (key, rep, component) that share a bucket.

    A bucket's home is its largest component. Its members meet in the home's group, cut into blocks: members of other
    components (guests) against all. A row of the result joins a guest to one component; further links to it are left out.
    """
    weights = placed.groupBy("key", "component").count()
    homes = weights.groupBy("key").agg(F.max(F.struct("count", "component"))["component"].alias("home"), F.count("*").alias("parts"))
    met = placed.join(homes.where("parts > 1").drop("parts"), "key").select("home", "rep", "component").distinct()
    guest = (F.col("component") != F.col("home")).cast("int")
    sizes = met.groupBy("home").agg(F.ceil(F.sum(guest) / guests).cast("int").alias("rows"), F.ceil(F.count("*") / every).cast("int").alias("columns"))
    rows, columns = F.col("rows"), F.col("columns")
    cells = met.join(sizes, "home").select(
        "home", "rep", "component",
        # side 0: a guest stands in one row of blocks; side 1: everyone stands in one column of blocks
        F.explode(F.concat(
            F.when(guest == 1, F.transform(F.sequence(F.lit(0), columns - 1), lambda c: F.struct(
                F.lit(0).alias("side"), F.pmod(F.xxhash64("rep"), rows).cast("int").alias("i"), c.alias("j")))).otherwise(F.array()),
            F.transform(F.sequence(F.lit(0), rows - 1), lambda r: F.struct(
                F.lit(1).alias("side"), r.alias("i"), F.pmod(F.xxhash64(F.lit(1), "rep"), columns).cast("int").alias("j"))),
        )).alias("cell"),
    ).select("home", "cell.i", "cell.j", "cell.side", F.col("rep").alias("node"), "component")
    kind = met.schema["rep"].dataType.simpleString()

    def compare(t):
        side, own = t.column("side").to_numpy(), t.column("node").to_pylist()
        part, lists = t.column("component").to_pylist(), t.column("shingles").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        a, b = linked(side, part, ends, flat, percent)
        return pa.table({"a": pa.array([own[k] for k in a], t.schema.field("node").type), "b": pa.array([own[k] for k in b], t.schema.field("node").type)})

    return cells.join(sets, "node").groupBy("home", "i", "j").applyInArrow(compare, f"a {kind}, b {kind}")


def linked(side: np.ndarray, part: list, ends: np.ndarray, flat: np.ndarray, percent: int) -> tuple[list[int], list[int]]:
    """Places of guests (side 0) and of those of side 1 whose sets are similar: one link per guest and component.

    ``flat`` holds the sets, set k from ends[k] to ends[k + 1]; the sets of side 1 become one inverted index.
    """
    hosts = np.flatnonzero(side == 1)
    size = np.diff(ends)
    owner = np.repeat(np.arange(len(size)), size)
    inside = side[owner] == 1
    order = np.argsort(flat[ends[0] : ends[-1]][inside], kind="stable")
    key, who = flat[ends[0] : ends[-1]][inside][order], owner[inside][order]
    out_a, out_b = [], []
    for g in np.flatnonzero(side == 0).tolist():
        own = flat[ends[g] : ends[g + 1]]
        low, high = np.searchsorted(key, own, "left"), np.searchsorted(key, own, "right")
        count = high - low
        at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        common = np.bincount(who[at], minlength=len(size))[hosts]
        near = hosts[(common > 0) & (100 * common >= percent * (size[hosts] + size[g] - common))]
        seen = {part[g]}
        for h in near.tolist():
            if part[h] not in seen:
                seen.add(part[h])
                out_a.append(g)
                out_b.append(h)
    return out_a, out_b


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    A null or wordless text has an empty set and no links. Rows without doc_id are not linked: component_id is null
    and they are kept. Rows that share a doc_id are one node: each keeps its n_shingles, links of any count for all.
    Copies of one text have one set and link without being compared. An empty table gives an empty result;
    other columns are ignored.
    """
    made = shared_table(signatures(docs, doc_id, text, bands, rows), "signatures")
    usable = made.where("digest is not null and doc_id is not null")
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    own = usable.join(classes, "digest")
    members = own.where("doc_id = rep").select("rep", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    # Of each bucket one member, drawn by hash, so that buckets of the same documents draw different ones.
    drawn = members.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("rep", "key").alias("h"), F.col("rep").alias("rep"), F.col("n").alias("n"))).alias("first"),
        F.count("*").alias("size"),
    ).where("size > 1").select("key", F.col("first.rep").alias("first"), F.col("first.n").alias("first_n"))
    buckets = shared_table(members.join(drawn, "key"), "buckets")
    sets = shared_table(full_sets(docs, doc_id, text, buckets.select(F.col("rep").alias("node")).distinct()), "sets")

    def close(x: str, y: str):
        return F.least(x, y) * 100 >= F.greatest(x, y) * percent

    def pairs(df: DataFrame, x: str, y: str) -> DataFrame:
        return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    stars = pairs(buckets.where((F.col("rep") != F.col("first")) & close("n", "first_n")), "rep", "first")
    found = components(verified(stars, sets, percent))
    placed = buckets.select("key", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.withColumn("component", F.coalesce("component", "rep"))
    more = shared_table(across(placed, sets, percent), "links")
    nodes = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)).select(
        F.col("node").alias("rep"), "component")
    linked = own.select("doc_id", "n_shingles", "rep").join(nodes, "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    alone = made.where("digest is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
