"""Centroid clustering with zone maps along a space-filling curve.

Vectors are rounded to integers, so all that follows is exact. They are ordered along a Hilbert curve through
their leading principal coordinates and cut into blocks; a block keeps the smallest and largest value of every
component, its box. For a centroid, the box gives a least and a largest distance of any vector of the block. A centroid whose
least distance exceeds the smallest of the largest ones is nearest to no vector there; the others are the block's
candidates, and only they are compared with its vectors. A round sums vectors by cluster in the tasks and brings one row a
cluster to the driver, where the next centroids are made.

The axes and the grid of the curve come from the ``sample`` vectors that are first by hash (a bound, at most 4,096 by
default). They decide the order of the vectors and so how much the boxes save, never a result.

Odd input: vectors of another length, null ones and those with a null or non-finite component are left out, and so are those
with a component that is 2^27 or more when rounded, whose distances exceed a long. Equal ids are vectors of their own; as
starting centroids they are ordered by their values. Null ids are hashed as if empty and start a centroid only after all
others. Fewer vectors than centroids make fewer centroids. Equal vectors are spread over blocks like others. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.session import stored

BLOCK = "ids binary, no_id binary, vectors binary, low binary, high binary"
LIMIT = 1 << 27
FLOAT_LIMIT = 1 << 22
"""Below it, all sums of 64 products are exact in double arithmetic."""


@dataclass(frozen=True)
class ClusterConfig:
    """``axes`` coordinates of ``bits`` bits make a place on the curve, 63 bits at most."""

    dimensions: int = 64
    scale: int = 256
    clusters: int = 40
    rounds: int = 5
    seed: int = 2
    axes: int = 7
    bits: int = 9
    sample: int = 4096
    block: int = 256


def rounded(vectors: DataFrame, config: ClusterConfig) -> DataFrame:
    """vec_id, v (array<long>) of the vectors that count."""
    value = F.transform("embedding", lambda x: F.floor(x.cast("double") * config.scale))
    limit = float(LIMIT) / config.scale
    # A comparison with null is null and one with NaN is false, so neither passes.
    fine = F.forall("embedding", lambda x: x.isNotNull() & (x.cast("double") < limit) & (x.cast("double") >= -limit))
    return (vectors.filter((F.size("embedding") == config.dimensions) & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("v")))


def first_by_hash(vectors: DataFrame, config: ClusterConfig) -> np.ndarray:
    """The ``sample`` vectors first by hash, in that order: a row of bounded length each, on the driver.

    Only vectors below a hash value under which about four times as many lie are sorted; it rises until enough are below.
    """
    wanted, total, top = max(config.sample, config.clusters), vectors.count(), 1 << 52
    digest = F.sha2(F.concat(F.lit(f"{config.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    hashed = vectors.withColumn("digest", digest).withColumn("at", F.conv(F.substring("digest", 1, 13), 16, 10).cast("long"))
    bound = min(top, 4 * wanted * top // max(total, 1))
    while bound < top and hashed.filter((F.col("at") < bound) & F.col("vec_id").isNotNull()).count() < wanted:
        bound = min(top, 4 * bound)
    rows = hashed.filter(F.col("at") < bound).orderBy(F.col("vec_id").isNull(), "digest", "v").limit(wanted).select("v").toArrow()
    values = rows.column("v").combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, config.dimensions).astype(np.int64)


def hilbert_place(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with coordinates of ``bits`` bits, a row each (Skilling's transposition)."""
    x = grid.astype(np.uint64).T.copy()
    axes, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q = np.uint64(1 << level)
        below = q - one
        for i in range(axes):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(high, below, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        q = np.uint64(1 << level)
        flip ^= np.where((x[axes - 1] & q) != 0, q - one, np.uint64(0))
    x ^= flip
    place = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            place = (place << one) | ((x[i] >> np.uint64(level)) & one)
    return place.astype(np.int64)


@dataclass(frozen=True)
class Curve:
    """Axes of the sample's largest variances and the cells they are cut into."""

    axes: np.ndarray
    least: np.ndarray
    cells: np.ndarray
    bits: int

    @classmethod
    def of(cls, sample: np.ndarray, config: ClusterConfig) -> Curve:
        real = sample.astype(float)
        spread = np.atleast_2d(np.cov(real.T)) if len(real) > 1 else np.zeros((config.dimensions, config.dimensions))
        axes = np.linalg.eigh(spread)[1][:, ::-1][:, :config.axes]
        at = real @ axes
        least = at.min(axis=0)
        return cls(axes, least, np.maximum(at.max(axis=0) - least, 1e-9), config.bits)

    def place(self, vectors: np.ndarray) -> np.ndarray:
        share = (vectors.astype(float) @ self.axes - self.least) / self.cells
        top = (1 << self.bits) - 1
        return hilbert_place(np.clip(share * (top + 1), 0, top).astype(np.int64), self.bits)


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def blocks(vectors: DataFrame, sample: np.ndarray, config: ClusterConfig) -> DataFrame:
    """The zone map: a row per block of neighbours on the curve, with its ids, vectors and box."""
    curve, d = Curve.of(sample, config), config.dimensions

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                pa.array(curve.place(matrix(batch.column(1), d))), batch.column(0),
                pa.array([row.tobytes() for row in matrix(batch.column(1), d).astype("<i4")], pa.binary())], names=["place", "vec_id", "v"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def block(table: pa.Table) -> pa.RecordBatch:
            own = np.frombuffer(b"".join(table.column("v").to_pylist()), "<i4").reshape(-1, d)
            ids = table.column("vec_id").combine_chunks()
            return pa.RecordBatch.from_pylist([{
                "ids": ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), "no_id": ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                "vectors": own.tobytes(), "low": own.min(axis=0).tobytes(), "high": own.max(axis=0).tobytes()}],
                schema=pa.schema([(f.split()[0], pa.binary()) for f in BLOCK.split(", ")]))

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= config.block:
                table = pa.Table.from_batches(held)
                whole = rows - rows % config.block
                for at in range(0, whole, config.block):
                    yield block(table.slice(at, config.block))
                held, rows = table.slice(whole).to_batches(), rows - whole
        if rows:
            yield block(pa.Table.from_batches(held))

    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64("vec_id", "v")  # equal vectors share a place, so they are told apart by their ids
    placed = vectors.mapInArrow(place, "place long, vec_id long, v binary").withColumn("spread", spread)
    return stored(placed.repartitionByRange(n, "place", "spread").sortWithinPartitions("place", "spread").select("vec_id", "v").mapInArrow(cut, BLOCK), "cluster-blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector between ``low`` and ``high``, in ascending order."""
    beneath, above = low - centroids, centroids - high
    least = np.square(np.maximum(np.maximum(beneath, above), 0)).sum(axis=1)
    largest = np.square(np.maximum(np.abs(beneath), np.abs(above))).sum(axis=1)
    return np.flatnonzero(least <= largest.min())


def nearest(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of every vector's nearest centroid; of equally near ones the smallest number."""
    may = candidates(low, high, centroids)
    some = centroids[may]
    if max(np.abs(low).max(), np.abs(high).max(), np.abs(some).max()) < FLOAT_LIMIT:
        own, other = vectors.astype(float), some.astype(float)
        apart = np.square(own).sum(axis=1)[:, None] - 2 * (own @ other.T) + np.square(other).sum(axis=1)
        apart = apart.astype(np.int64)
    else:
        apart = np.stack([np.square(vectors - one).sum(axis=1) for one in some], axis=1)
    at = apart.argmin(axis=1)
    return may[at], apart[np.arange(len(at)), at]


def unpacked(row: dict, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(row[name], "<i4").astype(np.int64).reshape(shape) for name, shape in (("vectors", (-1, d)), ("low", d), ("high", d)))


def cluster_sums(zone_map: DataFrame, centroids: np.ndarray) -> list:
    """cluster, component, n and sum of that component: added up in the tasks, then a row a cluster and component on the driver."""
    k, d = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                vectors, low, high = unpacked(row, d)
                cluster, _ = nearest(vectors, low, high, centroids)
                order = np.argsort(cluster, kind="stable")
                starts = np.flatnonzero(np.diff(cluster[order], prepend=-1))
                sums[cluster[order][starts]] += np.add.reduceat(vectors[order], starts, axis=0)
                counts += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(used, d).astype(np.int32)), pa.array(np.tile(np.arange(d, dtype=np.int32), len(used))),
            pa.array(np.repeat(counts[used], d)), pa.array(sums[used].ravel())], names=["cluster", "component", "n", "s"])

    parts = zone_map.select("vectors", "low", "high").mapInArrow(add, "cluster int, component int, n long, s long")
    return parts.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(28,0)")).alias("s")).collect()


def assigned(zone_map: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every vector."""
    d = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                cluster, distance = nearest(*unpacked(row, d), centroids)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.frombuffer(row["ids"], "<i8"), pa.int64(), mask=np.frombuffer(row["no_id"], bool)),
                    pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return zone_map.mapInArrow(assign, "vec_id long, cluster int, distance long")


def clustered(embeddings: DataFrame, config: ClusterConfig = ClusterConfig()) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of the vectors of ``embeddings`` (vec_id, embedding)."""
    spark = embeddings.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    vectors = rounded(embeddings, config)
    sample = first_by_hash(vectors, config)
    if not len(sample):
        return spark.createDataFrame([], schema)
    zone_map, centroids = blocks(vectors, sample, config), sample[:config.clusters].copy()
    for _ in range(config.rounds):
        for row in cluster_sums(zone_map, centroids.copy()):
            centroids[row["cluster"], row["component"]] = int(row["s"]) // row["n"]
    rows = stored(assigned(zone_map, centroids), "clusters")
    inertia = {row["cluster"]: row["inertia"] for row in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    total = sum(inertia.values())
    told = spark.createDataFrame([
        (number, inertia.get(number, 0), total, hashlib.sha256(",".join(map(str, one.tolist())).encode()).hexdigest())
        for number, one in enumerate(centroids)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row a cluster on the broadcast side.
    return rows.join(F.broadcast(told), "cluster").select(*[f.split()[0] for f in schema.split(", ")])
