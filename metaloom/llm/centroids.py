"""Centroid clustering of integer vectors by scalar lookup tables.

Components are whole numbers, so in one round the squared difference of a component and a centroid's can
take only as many values as the dimension has different components. Each round a task tabulates it per
dimension, occurring value and centroid; the distances of its vectors are then gathers from that table and
sums, without a multiplication per vector. Tables are made per block of vectors, so their size is bounded
by the block whatever values occur. A round sends one row of sums per task and cluster.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metaloom.llm.common import stored

CLUSTERS, ROUNDS, SCALE = 40, 5, 256
# Vectors that share one set of tables.
BLOCK = 8192
# Squared lengths stay below this, so that distances and their parts fit 64 bits.
LONGEST = float(2 ** 60)


def quantised(vectors: DataFrame, vector_col, scale=SCALE, dimensions=None, longest=LONGEST) -> DataFrame:
    """Adds `_v`: floor(scale * x) of each component, x as double, as bigints; rows that cannot be go.

    A vector goes if it is null or holds a null or non-finite component, if it has not exactly
    `dimensions` components (where given), or if its squared length reaches `longest`: its
    distances or products would not fit a bigint.
    """
    x = F.transform(F.col(vector_col).cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale)).cast("double")))
    raw = F.col(vector_col).cast("array<double>")
    sound = F.forall(raw, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    length = F.aggregate(raw, F.lit(0.0), lambda s, c: s + (c * scale) * (c * scale))
    fits = F.coalesce(sound & (length < longest), F.lit(False))
    if dimensions is not None:
        fits &= F.size(raw) == dimensions
    return vectors.where(fits).withColumn("_v", x)


def _matrix(column, dimensions):
    """A list column without nulls as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dimensions)


def nearest(block, centroids):
    """(cluster, squared distance) of each vector; ties go to the smaller number."""
    distance = np.zeros((len(block), len(centroids)), dtype=np.int64)
    for d in range(block.shape[1]):
        low, high = block[:, d].min(), block[:, d].max()
        if high - low < 4 * BLOCK:  # the span itself is a short list of values
            values, place = np.arange(low, high + 1), block[:, d] - low
        else:
            values, place = np.unique(block[:, d], return_inverse=True)
        table = (values[:, None] - centroids[None, :, d]) ** 2
        distance += table.take(place, axis=0)
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(block)), best]


def _blocks(batches, dimensions):
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK):
            part = batch.slice(low, BLOCK)
            yield part, _matrix(part.column("_v"), dimensions)


def _summing(centroids):
    """Per task and cluster: how many vectors are nearest to it, and their sum."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters, dimensions = centroids.shape
        counts = np.zeros(clusters, dtype=np.int64)
        # High and low halves: no task can overflow them.
        sums = np.zeros((2, clusters, dimensions), dtype=np.int64)
        for _, block in _blocks(batches, dimensions):
            best, _ = nearest(block, centroids)
            counts += np.bincount(best, minlength=clusters)
            order = np.argsort(best, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(best[order]) != 0])
            rows = block[order]
            for half, part in ((0, rows >> 32), (1, rows & 0xFFFFFFFF)):
                sums[half, best[order][starts]] += np.add.reduceat(part, starts, axis=0)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(counts[held]),
             pa.array(list(sums[0, held]), pa.list_(pa.int64())), pa.array(list(sums[1, held]), pa.list_(pa.int64()))],
            names=["cluster", "n", "high", "low"])
    return total


def _assigning(centroids):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block in _blocks(batches, centroids.shape[1]):
            best, distance = nearest(block, centroids)
            yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(best.astype(np.int32)), pa.array(distance)],
                                             names=["_id", "cluster", "distance"])
    return assign


def moved(vectors: DataFrame, centroids):
    """The centroids after one round: floors of exact means; those without vectors stay."""
    dimensions = centroids.shape[1]
    halves = [F.sum(F.col(half)[d].cast("decimal(38,0)")) for d in range(dimensions) for half in ("high", "low")]
    # As many rows as there are clusters.
    found = (vectors.select("_v").mapInArrow(_summing(centroids), "cluster int, n bigint, high array<bigint>, low array<bigint>")
             .groupBy("cluster").agg(F.sum("n"), F.array(*halves)).collect())
    new = centroids.copy()
    for cluster, n, sums in found:
        new[cluster] = [(int(high) * 2 ** 32 + int(low)) // n for high, low in zip(sums[::2], sums[1::2])]
    return new


def seeded(vectors: DataFrame, clusters, seed):
    """The vectors with the smallest hashes of their ids, in that order; the hash is the seed's text and the id's.

    Ids that repeat are taken in the order of their vectors, rows without an id come last.
    """
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")), 256)
    rows = vectors.orderBy(order.asc_nulls_last(), "_v").limit(clusters).select("_v").collect()
    return np.array([r[0] for r in rows], dtype=np.int64)


def cluster(vectors: DataFrame, dimensions, id_col="vec_id", vector_col="embedding", clusters=CLUSTERS, rounds=ROUNDS,
            seed="2", scale=SCALE) -> DataFrame:
    """One row per vector of `dimensions` components: id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256, and centroid (the final one's components).

    Null vectors, those of another length, with a null or non-finite component or a length that 64
    bits cannot hold (`quantised`) get no row. Fewer vectors than `clusters` are as many clusters. Rows
    that repeat count as often as they stand there. Ties go to the smaller number, equal centroids
    included. An empty table gives no rows; other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_vector"))
    rows = stored(quantised(rows, "_vector", scale, dimensions).select("_id", "_v"), "quantised")
    kind = rows.schema["_id"].dataType.simpleString()
    centroids = seeded(rows, clusters, seed)
    if not len(centroids):
        none = F.lit(None)
        return rows.select(F.col("_id").alias(id_col), none.cast("int").alias("cluster"), none.cast("bigint").alias("distance"),
                           none.cast("bigint").alias("cluster_inertia"), none.cast("bigint").alias("inertia"),
                           none.cast("string").alias("centroid_sha256"), none.cast("array<bigint>").alias("centroid"))
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    assigned = stored(rows.mapInArrow(_assigning(centroids), f"_id {kind}, cluster int, distance bigint"), "assigned")
    described = rows.sparkSession.createDataFrame(
        [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest(), c.tolist()) for i, c in enumerate(centroids)],
        "cluster int, centroid_sha256 string, centroid array<bigint>")
    # One row per cluster, so at most `clusters` of them are broadcast. A sum beyond 64 bits is null.
    total = F.sum("_sum").over(Window.partitionBy(F.lit(0)))
    inertia = (assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("_sum"))
               .select("cluster", F.expr("try_cast(_sum AS bigint)").alias("cluster_inertia"), total.alias("_total")))
    inertia = inertia.select("cluster", "cluster_inertia", F.expr("try_cast(_total AS bigint)").alias("inertia"))
    return (assigned.join(F.broadcast(inertia.join(described, "cluster")), "cluster")
            .select(F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"))
