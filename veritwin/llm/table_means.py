"""Centroid clustering of integer vectors by scalar lookup tables.

Vectors become integers once and are stored in blocks: for each dimension the values that occur in the block, and for
each vector the place of its value. In a round a block needs one squared difference per dimension, occurring value
and centroid; the distances are then gathers from that table, added up over dimensions. Everything is integer, so
results don't depend on the order of vectors, blocks or tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 8, 10, 1024
#: Vectors of a block; places fit 16 bits.
BLOCK = 1024
#: Integers below this keep every distance within a long.
LIMIT = 1 << 26


def integers(vectors: DataFrame, embedding: str, dimensions: int) -> DataFrame:
    """All columns of the vectors that count, with ``v``: their components as integers."""
    double = F.transform(F.col(f"`{embedding}`"), lambda x: x.cast("double") * SCALE)
    fine = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT))
    usable = vectors.where((F.size(F.col(f"`{embedding}`")) == dimensions) & F.coalesce(fine, F.lit(False)))
    return usable.withColumn("v", F.transform(double, lambda x: F.floor(x)))


def first_centroids(kept: DataFrame, clusters: int) -> np.ndarray:
    """The vectors of the smallest hashes of their ids; of equal hashes the least vector."""
    line = F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = kept.select(F.sha2(line.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64)


def encoded(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurring values, dimension after dimension; how many each dimension has; place of each component among them."""
    values, places = [], np.empty(v.shape, np.uint16)
    for d in range(v.shape[1]):
        own, places[:, d] = np.unique(v[:, d], return_inverse=True)
        values.append(own)
    return np.concatenate(values), np.array([len(x) for x in values]), places


def distances(values: np.ndarray, widths: np.ndarray, places: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each vector of a block to each centroid."""
    table = (values[:, None] - np.repeat(centroids.T, widths, axis=0)) ** 2
    total, start = np.zeros((len(places), len(centroids)), np.int64), 0
    for d, width in enumerate(widths.tolist()):
        total += table[start : start + width][places[:, d]]
        start += width
    return total


def blocks_of(kept: DataFrame, block: int = BLOCK) -> DataFrame:
    """ids, n, values, widths, places: one row per block of vectors."""
    kind = kept.schema["vec_id"].dataType.simpleString()
    names = ["ids", "values", "widths", "places"]

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, block):
                part = b.slice(k, block)
                flat = part.column("v").flatten().to_numpy(zero_copy_only=False)
                values, widths, places = encoded(flat.reshape(part.num_rows, -1))
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("vec_id"))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([values]), pa.array([widths.astype(np.int32)]), pa.array([places.tobytes()], pa.binary())], names=names)

    return kept.select("vec_id", "v").mapInArrow(run, f"ids array<{kind}>, values array<long>, widths array<int>, places binary")


def _block(b: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values, widths = (b.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("values", "widths"))
    return values, widths, np.frombuffer(b.column("places")[k].as_py(), np.uint16).reshape(-1, len(widths))


def sums(blocks: DataFrame, centroids: np.ndarray) -> list:
    """cluster, n and the sums of the components of its vectors: a row per cluster, added up per task before the shuffle."""
    clusters, dims = centroids.shape
    own = centroids.tolist()

    def run(batches):
        table = np.array(own, np.int64)
        total, n = np.zeros((clusters, dims), np.int64), np.zeros(clusters, np.int64)
        for b in batches:
            for k in range(b.num_rows):
                values, widths, places = _block(b, k)
                nearest = distances(values, widths, places, table).argmin(axis=1)
                n += np.bincount(nearest, minlength=clusters)
                x = values[places + (np.cumsum(widths) - widths)]
                for c in np.unique(nearest).tolist():
                    total[c] += x[nearest == c].sum(axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    parts = blocks.select("values", "widths", "places").mapInArrow(run, "cluster int, n long, total array<long>")
    whole = [F.sum(F.col("total")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *whole).collect()


def assigned(blocks: DataFrame, centroids: np.ndarray, kind: str) -> DataFrame:
    """vec_id, cluster, distance; of equal distances the smaller number."""
    own = centroids.tolist()

    def run(batches):
        table = np.array(own, np.int64)
        for b in batches:
            for k in range(b.num_rows):
                found = distances(*_block(b, k), table)
                nearest = found.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("ids")[k].values, pa.array(nearest, pa.int32()), pa.array(found[np.arange(len(found)), nearest])],
                    names=["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def cluster(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, block: int = BLOCK,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per vector that counts.

    A vector counts if it has ``dimensions`` components, none null or non-finite; a component whose integer is ``LIMIT`` or more
    counts as non-finite, as distances could leave the range of a long. With fewer vectors than clusters there are fewer
    clusters. Null ids count and hash as an empty text; repeated rows get a row each. An empty table, or one without
    such a vector, gives an empty result; a sum beyond a long is null. Other columns are not read.

    The driver sees the centroids, and one row of sums per cluster and round.
    """
    kind = vectors.schema[vec_id].dataType.simpleString()
    named = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").alias("embedding"))
    kept = integers(named, "embedding", dimensions).select("vec_id", "v")
    centroids = first_centroids(kept, clusters)
    if not len(centroids):
        empty = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    blocks = shared_table(blocks_of(kept, block), "blocks")
    for _ in range(rounds):
        for row in sums(blocks, centroids):
            centroids[row["cluster"]] = [int(row[f"s{d}"]) // row["n"] for d in range(dimensions)]
    found = shared_table(assigned(blocks, centroids, kind), "assigned")
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    inertia = {c: s if s < 1 << 63 else None for c, s in inertia.items()}
    whole = None if None in inertia.values() or sum(inertia.values()) >= 1 << 63 else sum(inertia.values())
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, own, whole, names[c]) for c, own in inertia.items()]
    each = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
