"""Clustering around centroids by a bisector tournament.

A vector lies nearer to centroid b than to centroid a if it is on b's side of
the plane half-way between them: with integer vectors, if its product with
the normal 2(b - a) is greater than the threshold |b|^2 - |a|^2.  Normals and
thresholds of all pairs of centroids are computed once per round.  Of a vector
the centroids then play k - 1 matches, one sign each: the winner so far against
the next number; a zero favours the smaller number, which is the winner so
far.  Distances are computed to the last winner only, exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import discard, in_arrow, landed

#: Rows of a step of a task.
STEP = 4096
#: Up to this absolute value, sums of products in doubles are exact.
EXACT = 1 << 53


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """(id, v array<int>): floor(scale * x) of the vectors of exactly ``dim`` components, none of them null or non-finite."""
    limit = greatest(dim)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(F.size("v") == dim)
    rows = rows.filter(F.forall("v", lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")) & ~F.isnan(x), F.lit(False))))
    whole = lambda x: F.when(F.abs(x * scale) < limit, F.floor(x * scale).cast("int")).otherwise(F.raise_error(F.lit("component too large for 64-bit distances")).cast("int"))
    return rows.select("id", F.transform("v", whole).alias("v"))


def greatest(dim: int) -> int:
    """Components up to this absolute value have squared distances, and products with normals, of 62 bits at most."""
    return int((2**60 / max(dim, 1)) ** 0.5)


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals (a, b, dim) and thresholds (a, b) of the planes half-way between centroids a and b."""
    norm = (centroids * centroids).sum(1)
    return 2 * (centroids[None, :] - centroids[:, None]), norm[None, :] - norm[:, None]


def tournament(x: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of every row of ``x``, ties to the smaller number."""
    bound = int(np.abs(x).max(initial=0)) * int(np.abs(normals).max(initial=0)) * max(x.shape[1], 1)
    if max(bound, int(np.abs(thresholds).max(initial=0))) < EXACT:
        x, normals, thresholds = x.astype(np.float64), normals.astype(np.float64), thresholds.astype(np.float64)
    winner = np.zeros(len(x), np.int64)
    for b in range(1, len(thresholds)):
        side = np.einsum("ij,ij->i", x, normals[winner, b])
        winner[side > thresholds[winner, b]] = b
    return winner


def _rows(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer vectors in steps."""
    for batch in batches:
        flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        for i in range(0, len(flat), STEP):
            yield batch.column("id").slice(i, STEP), flat[i:i + STEP].astype(np.int64)


def _sums(pool: DataFrame, centroids: np.ndarray) -> list:
    """(cluster, n, sums) of the non-empty clusters: at most one row per task and cluster crosses the network."""
    k, dim = centroids.shape
    state = pool.sparkSession.sparkContext.broadcast(bisectors(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = state.value
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, x in _rows(batches, dim):
            own = tournament(x, *planes)
            order = np.argsort(own, kind="stable")
            first = np.flatnonzero(np.diff(own[order], prepend=-1))
            total[own[order][first]] += np.add.reduceat(x[order], first)
            n += np.bincount(own, minlength=k)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(total[some].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = in_arrow(pool, run, "cluster int, n long, sums array<bigint>")
    sums = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dim)]
    return [(r[0], int(r[1]), [int(s) for s in r[2:]]) for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect()]  # k rows at most


def clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of exactly ``dim``
    components, none of them null or non-finite; the others are left out.

    Components become floor(scale * x).  The first centroids are the k vectors of the least hexadecimal
    sha256 of ``<seed>:<id>``, in that order (vectors that share an id in the order of their components;
    all vectors, if there are fewer than k).  Every round assigns all vectors and moves each non-empty
    centroid to the floored mean of its vectors; empty ones stay.  Distances are squared, ties go to
    the smaller number.  Rows with a null id are assigned and counted, but start no centroid.  A component too
    large for distances of 64 bits fails the job.  No vectors with an id give an empty result; other columns are
    not read.  Driver and tasks hold k * k * dim numbers, so k is meant to be some hundreds at most."""
    spark = vectors.sparkSession
    pool = landed(kept_vectors(vectors, id_col, vector_col, dim, scale), "kept")
    named = pool.filter("id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    first = named.orderBy("h", "v").limit(k).select("v").collect()  # k rows
    shape = f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], shape)
    centroids = np.array([r["v"] for r in first], np.int64).reshape(len(first), dim)
    for _ in range(rounds):
        for cluster, n, sums in _sums(pool, centroids):
            centroids[cluster] = [s // n for s in sums]
    state = spark.sparkContext.broadcast((bisectors(centroids), centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, ends = state.value
        for ids, x in _rows(batches, dim):
            own = tournament(x, *planes)
            yield pa.RecordBatch.from_arrays([ids, pa.array(own.astype(np.int32)), pa.array(((x - ends[own]) ** 2).sum(1))], names=["id", "cluster", "distance"])

    out = landed(in_arrow(pool, assign, "id long, cluster int, distance long"), "assigned")
    discard(pool)
    within = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows at most
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    about = spark.createDataFrame([(c, s, sum(within.values()), digest(c)) for c, s in within.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(about), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
