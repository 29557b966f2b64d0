"""Clustering integer vectors around centroids, with the equal-average equal-variance search.

For a vector x of k components with sum s and deviation v (v*v = sum of squares - s*s/k) and a
centroid likewise, the squared distance is at least (s - s')**2 / k + (v - v')**2.  Centroids are
sorted by their component sum; a vector starts at the one with the nearest sum and looks outward.  A
centroid whose sum alone is too far closes its side, since all further ones are farther; one that
the deviations rule out is passed over; for the rest the distance is added up in integers.  Bounds
are compared with a margin for rounding, so the result is that of the full search, ties included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.workspace import materialize

CLUSTERS = 16
ROUNDS = 3
SCALE = 64
SIZE = 64
LARGEST = 1 << 27  # of a scaled component: distances of 64 components stay below 2**62
BLOCK = 4096


@dataclass(frozen=True)
class Centroids:
    """Centroids in the order of their numbers, and what the search compares."""

    vectors: np.ndarray

    def __post_init__(self):
        sums, deviations = features(self.vectors)
        order = np.argsort(sums, kind="stable")
        object.__setattr__(self, "order", order)
        object.__setattr__(self, "sums", sums[order])
        object.__setattr__(self, "deviations", deviations[order])

    def digests(self) -> list[str]:
        texts = [",".join(map(str, v)) for v in self.vectors.tolist()]
        return [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def features(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component sums (exact) and deviations of integer vectors."""
    sums = vectors.sum(axis=1)
    wide = vectors.astype(np.float64)
    spread = wide - (sums / max(1, vectors.shape[1]))[:, None]
    return sums, np.sqrt((spread * spread).sum(axis=1))


def nearest(vectors: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of every vector, and how many distances were added up."""
    n, k = vectors.shape
    count = len(centroids.order)
    sums, deviations = features(vectors)
    best = np.full(n, np.iinfo(np.int64).max)
    cluster = np.full(n, count)
    above = np.searchsorted(centroids.sums, sums)
    # of the two sums around the vector's own, the nearer one is looked at first
    left, right = np.maximum(above - 1, 0), np.minimum(above, count - 1)
    nearer = np.abs(centroids.sums[left] - sums) < np.abs(centroids.sums[right] - sums)
    start = np.where(nearer, left, right)
    summed = 0

    def look(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Compare ``rows`` with the centroids at ``at``; which of them may go on in this direction."""
        nonlocal summed
        gap = (centroids.sums[at] - sums[rows]).astype(np.float64)
        apart = centroids.deviations[at] - deviations[rows]
        limit = best[rows].astype(np.float64) * (1 + 1e-9) + 1e-3
        by_sum = gap * gap / k
        wanted = by_sum + apart * apart * (1 - 1e-9) <= limit
        some, place = rows[wanted], centroids.order[at[wanted]]
        difference = vectors[some] - centroids.vectors[place]
        distance = np.einsum("ij,ij->i", difference, difference)
        summed += len(some)
        better = (distance < best[some]) | ((distance == best[some]) & (place < cluster[some]))
        best[some[better]], cluster[some[better]] = distance[better], place[better]
        return by_sum <= limit

    everyone = np.arange(n)
    look(everyone, start)
    up, down = everyone, everyone
    for step in range(1, count):
        up = up[start[up] + step < count]
        up = up[look(up, start[up] + step)]
        down = down[start[down] - step >= 0]
        down = down[look(down, start[down] - step)]
        if not len(up) and not len(down):
            break
    return cluster, best, summed


def scaled(column: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The integers ``floor(scale * x)`` of the rows that have ``size`` finite components, and those rows."""
    if not len(column):
        return np.zeros((0, size), np.int64), np.zeros(0, np.int64)
    lengths = np.diff(np.asarray(column.offsets))
    whole = (lengths == size) & np.asarray(column.is_valid())
    rows = np.flatnonzero(whole)
    flat = column.take(pa.array(rows)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), size)
    finite = np.isfinite(values).all(axis=1)  # a null component is a nan here
    rows, values = rows[finite], np.floor(values[finite] * scale)
    if len(values) and np.abs(values).max() > LARGEST:
        raise ValueError(f"scaled components beyond {LARGEST} have distances beyond 64 bits")
    return values.astype(np.int64), rows


def _blocks(batches: Iterator[pa.RecordBatch], size: int, scale: int) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            part = batch.slice(at, BLOCK)
            vectors, rows = scaled(part.column("vector"), size, scale)
            if len(rows):
                yield part, vectors, rows


def first_centroids(vectors: DataFrame, key: str, count: int, seed: int, size: int, scale: int) -> Centroids:
    """The ``count`` vectors whose ``seed:key`` has the smallest sha256; ties by components.

    The kept vectors are found in the tasks; ``count`` rows reach the driver.
    """
    names = ["digest", "components"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, integers, rows in _blocks(batches, size, scale):
            digests = part.column("digest").take(pa.array(rows))
            components = pa.array(integers.tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([digests, components], names=names)

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256).alias("digest")
    kept = vectors.select(digest, "vector").mapInArrow(emit, "digest string, components array<bigint>")
    least = kept.orderBy("digest", "components").limit(count).collect()
    return Centroids(np.array([r.components for r in least], np.int64).reshape(-1, size))


def _updated(vectors: DataFrame, centroids: Centroids, size: int, scale: int) -> Centroids:
    """Centroids moved to the floored mean of their vectors; those without vectors stay.

    A task adds up its own vectors and emits one row for each (cluster, component) that it met.
    """
    count = len(centroids.order)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, members = np.zeros((count, size), np.int64), np.zeros(count, np.int64)
        for _, integers, _ in _blocks(batches, size, scale):
            cluster, _, _ = nearest(integers, centroids)
            members += np.bincount(cluster, minlength=count)
            np.add.at(total, cluster, integers)
        met = np.flatnonzero(members)
        columns = {
            "cluster": np.repeat(met, size).astype(np.int32),
            "place": np.tile(np.arange(size, dtype=np.int32), len(met)),
            "total": total[met].ravel(),
            "members": np.repeat(members[met], size),
        }
        yield pa.RecordBatch.from_pydict(columns)

    rows = vectors.select("vector").mapInArrow(emit, "cluster int, place int, total long, members long")
    added = rows.groupBy("cluster", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("members").alias("members")
    )
    moved = centroids.vectors.copy()
    for cluster, place, total, members in added.collect():  # clusters x components rows at most
        moved[cluster, place] = int(total) // members
    return Centroids(moved)


def cluster_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = 1,
    size: int = SIZE,
    scale: int = SCALE,
) -> DataFrame:
    """``key``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Rows whose vector is null, has another length or a component that is null or not finite are
    left out.  Repeated rows count and are returned each; a null key is hashed as an empty one; with
    fewer rows than ``clusters`` there are as many centroids as rows; no vectors give no rows.
    Vectors of one cluster may be any share of all: sums are added up in the tasks, and only
    ``clusters`` x ``size`` numbers meet at the driver.  Other columns are not read.
    """
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    schema = rows.select("key").schema.simpleString()[7:-1]
    centroids = first_centroids(rows, "key", clusters, seed, size, scale)
    if len(centroids.order):
        for _ in range(rounds):
            centroids = _updated(rows, centroids, size, scale)
    digests = centroids.digests()
    names = ["key", "cluster", "distance", "centroid_sha256"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, integers, kept in _blocks(batches, size, scale):
            cluster, distance, _ = nearest(integers, centroids)
            keys = part.column("key").take(pa.array(kept))
            hashes = pa.array([digests[c] for c in cluster.tolist()])
            columns = [keys, pa.array(cluster.astype(np.int32)), pa.array(distance), hashes]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    placed = rows.mapInArrow(emit, f"{schema}, cluster int, distance long, centroid_sha256 string")
    placed = materialize(placed, "clustered")
    sizes = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    listed = sizes.agg(F.sum("cluster_inertia").alias("inertia"), F.collect_list(F.struct("*")).alias("all"))
    totals = listed.select("inertia", F.inline("all"))  # as many rows as clusters
    return placed.join(F.broadcast(totals), "cluster").withColumnRenamed("key", key)
