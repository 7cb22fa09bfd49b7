"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, reranking with the vectors.

A rotation of the principal directions is learned so that the signs of a rotated vector lose least (alternating
between codes and an orthogonal Procrustes solution). A code of 64 bits is cut into 8 substrings, each the key of its own
table: vectors that differ in fewer than 8 bits agree in at least one substring, and most that differ in more. Vectors
of one label that meet in a table are compared by cosine in double precision.

A bucket is never turned into pairs. It is cut into blocks of at most ``BLOCK`` vectors on average; each pair of blocks is
one matrix product in one task, which returns a count of links per vector and one edge per vector to the
smallest id of its part of the block pair. A pair that meets in several tables counts in the first of them.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table
from .components import components

COSINE = 0.93
BITS, PART = 64, 8
#: Vectors that the rotation is learned from, drawn by a hash of the id; all vectors are indexed.
SAMPLE = 20_000
BLOCK = 512


class Rotation(NamedTuple):
    mean: np.ndarray
    matrix: np.ndarray  # dimensions x bits


def learn_rotation(x: np.ndarray, bits: int = BITS, steps: int = 50, seed: int = 11) -> Rotation:
    """From unit vectors: principal directions, then a rotation towards balanced signs."""
    dims = x.shape[1]
    rng = np.random.default_rng(seed)
    mean = x.mean(0) if len(x) else np.zeros(dims)
    centred = x - mean
    if len(x) > 1:
        _, vectors = np.linalg.eigh(centred.T @ centred)
        directions = vectors[:, ::-1]
    else:
        directions = np.eye(dims)
    if bits <= dims:
        directions = directions[:, :bits]
    else:  # more bits than dimensions: further random directions
        directions = np.concatenate([directions, rng.normal(size=(dims, bits - dims))], axis=1)
    rotation = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    projected = centred @ directions
    for _ in range(steps if len(x) > 1 else 0):
        codes = np.where(projected @ rotation >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(codes.T @ projected)
        rotation = (u @ v).T
    return Rotation(mean, directions @ rotation)


def encode(x: np.ndarray, rotation: Rotation) -> np.ndarray:
    """Codes of unit vectors, one byte per substring."""
    return np.packbits((x - rotation.mean) @ rotation.matrix >= 0, axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, without overflow or underflow on the way."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def compare(ids, codes, weights, x, side_a, side_b, table: int, cosine: float):
    """Links between two blocks of a bucket (or within one): counted by the first common table; and parts."""
    a, b = np.flatnonzero(side_a), np.flatnonzero(side_b)
    same = a is b or (len(a) == len(b) and (a == b).all())
    p, q = np.nonzero(x[a] @ x[b].T >= cosine)
    p, q = a[p], b[q]
    keep = p < q if same else p != q
    p, q = p[keep], q[keep]
    part = np.arange(len(ids))
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    part = rank.copy()
    while True:  # the least rank spreads along links
        low = np.minimum(part[p], part[q])
        after = part.copy()
        np.minimum.at(after, p, low)
        np.minimum.at(after, q, low)
        after = np.minimum(after, after[order[after]])
        if (after == part).all():
            break
        part = after
    first = ~(codes[p, :table] == codes[q, :table]).any(axis=1)
    counts = np.bincount(p[first], weights[q[first]], len(ids)) + np.bincount(q[first], weights[p[first]], len(ids))
    return counts.astype(np.int64), ids[order[part]]


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    cosine: float = COSINE, sample: int = SAMPLE, block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id (smallest vec_id reachable), kept.

    Only vectors of equal, non-null labels and equal dimension are compared. Vectors that are null, empty or zero, or hold
    null or non-finite components, link with nothing, and so do rows without vec_id, whose component_id is null
    and which are kept. Copies form one class and link with each other without being compared; each counts. Rows that share a
    vec_id are one node. An empty table gives an empty result; other columns are ignored.
    """
    schema = vectors.schema
    id_type, label_type = schema[vec_id].dataType.simpleString(), schema[label].dataType.simpleString()
    number = schema[embedding].dataType.elementType.simpleString()
    width = {"float": "<f4"}.get(number, "<f8")
    rows = vectors.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"),
        F.col(f"`{embedding}`").cast("array<float>" if width == "<f4" else "array<double>").alias("v"))
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall("v", fine) & F.exists("v", lambda c: c != 0)
    good = rows.where(usable)
    # Copies: one representative with its weight; adding up happens before the shuffle.
    classes = shared_table(good.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "classes")
    n_rows = classes.count()
    share = min(1.0, sample / max(1, n_rows))
    picked = classes.where(F.xxhash64(F.lit(5), "rep") < int(-(2**63) + 2**64 * share) - 1).select("v").limit(2 * sample).collect()
    by_dims: dict[int, list] = {}
    for row in picked:
        by_dims.setdefault(len(row["v"]), []).append(row["v"])
    rotations = {d: learn_rotation(unit(np.array(x, np.float64))) for d, x in by_dims.items()}
    shared = vectors.sparkSession.sparkContext.broadcast({d: tuple(r) for d, r in rotations.items()})  # plain: executors need no copy of this package
    tables = BITS // PART

    def code(batches):
        known = {d: Rotation(*r) for d, r in shared.value.items()}
        for b in batches:
            lists = b.column("v").to_pylist()
            codes = [b""] * len(lists)
            for dims in {len(v) for v in lists}:
                at = [n for n, v in enumerate(lists) if len(v) == dims]
                if dims not in known:  # no vector of this dimension was drawn
                    known[dims] = learn_rotation(np.zeros((0, dims)))
                for n, c in zip(at, encode(unit(np.array([lists[n] for n in at], np.float64)), known[dims])):
                    codes[n] = c.tobytes()
            raw = [np.asarray(v, width).tobytes() for v in lists]
            yield pa.RecordBatch.from_arrays(
                [b.column("rep"), b.column("label"), b.column("weight"), pa.array(codes, pa.binary()), pa.array(raw, pa.binary())],
                names=["rep", "label", "weight", "code", "raw"])

    coded = shared_table(
        classes.select("rep", "label", "weight", "v").mapInArrow(code, f"rep {id_type}, label {label_type}, weight long, code binary, raw binary"), "codes")
    placed = coded.select(
        "*", F.length("raw").alias("size"), F.posexplode(F.array(*[F.substring("code", t + 1, 1) for t in range(tables)])).alias("table", "key"))
    bucket = ["label", "size", "table", "key"]
    crowds = placed.groupBy(bucket).count().where(F.col("count") > 1).withColumn("blocks", F.ceil(F.col("count") / block).cast("int"))
    own = placed.join(crowds.drop("count"), bucket).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # A vector goes to every pair of blocks that holds its own.
    spread = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "rep", "weight", "code", "raw", *bucket, "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def meet(key, t):
        i, j, table = key[-2].as_py(), key[-1].as_py(), key[2].as_py()
        names = t.column("rep").to_pylist()
        ids = np.array(names) if not isinstance(names[0], str) else np.array(names, object)
        x = unit(np.frombuffer(b"".join(t.column("raw").to_pylist()), width).reshape(len(ids), -1))
        codes = np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
        side = np.array(t.column("own"))
        counts, part = compare(ids, codes, np.array(t.column("weight")), x, side == i, side == j, table, cosine)
        linked = (counts > 0) | (part != ids)
        return pa.table({"rep": pa.array(ids[linked].tolist(), t.schema.field("rep").type), "links": counts[linked],
                         "part": pa.array(part[linked].tolist(), t.schema.field("rep").type)})

    met = shared_table(
        spread.groupBy(*bucket, "i", "j").applyInArrow(meet, f"rep {id_type}, links long, part {id_type}"), "links")
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = components(met.select(F.col("rep").alias("a"), F.col("part").alias("b")))
    each = classes.select("rep", "label", "v", "weight").join(links, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    linked = good.join(each, ["label", "v"]).select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
