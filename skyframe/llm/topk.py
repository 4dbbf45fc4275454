"""Exact top-k search by distributed histogram selection.

Queries are taken in blocks of bounded size.  For a block, every task scores
its vectors against all queries of the block, and only counts: scores fall
into ``BINS`` bins between two edges per query.  Spark sums the counts, and the
bin that holds a query's k-th greatest score becomes its next range, until
few enough scores lie at or above its lower edge or the range is one value.
A last pass keeps scores at or above the edge, of each task the k first by
score and id, which cannot leave out any of the k first of all; Spark ranks
the rest.  So no pass ships a score per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import in_arrow, landed

BINS = 512
#: Values (queries times dimensions) of a block of queries; eight bytes each are broadcast.
BLOCK_VALUES = 1 << 20
#: Scores per step of a task.
STEP = 1 << 20
EXACT = float(1 << 53)


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v array<bigint>) with floor(scale * x) of every component; rows with a null id, a null vector, or
    null or non-finite components are left out."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    whole = F.forall("v", lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")) & ~F.isnan(x), F.lit(False)))
    return rows.filter(whole).select("id", F.transform("v", lambda x: F.floor(x * scale).cast("bigint")).alias("v"))


def matrices(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and (rows, width) vectors of the rows of a batch that have ``width`` components, in steps."""
    lists = batch.column("v")
    at = lists.offsets.to_numpy()
    rows = np.flatnonzero(np.diff(at) == width)
    values, ids = lists.values.to_numpy(), batch.column("id").to_numpy()
    for i in range(0, len(rows), max(1, STEP // max(width, 1))):
        some = rows[i:i + max(1, STEP // max(width, 1))]
        yield ids[some], values[at[some][:, None] + np.arange(width)]


def inner(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point only while that is exact."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(queries.shape[1], 1)
    if bound < EXACT:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return queries @ vectors.T


def _scored(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray):
    """(vector ids, scores (queries, vectors), is it another than the query's own) for steps of the batches."""
    per = max(1, STEP // max(len(ids), 1))
    for batch in batches:
        for vec, v in matrices(batch, queries.shape[1]):
            for i in range(0, len(vec), per):
                yield vec[i:i + per], inner(queries, v[i:i + per]), vec[None, i:i + per] != ids[:, None]


def _select_block(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int, few: int) -> np.ndarray:
    """A lower edge per query with k scores at or above it (if there are so many) and, unless they are
    ties, ``few`` at most."""
    spark = vectors.sparkSession
    low, high = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    greatest = vectors.select(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("s")).agg(F.max("s")).first()[0]
    reach = np.ceil(np.sqrt((queries.astype(np.float64) ** 2).sum(1)) * (greatest or 0) * (1 + 1e-9)).clip(max=2.0**62) + 1
    low[:], high[:] = -reach.astype(np.int64), reach.astype(np.int64) + 1  # scores lie in [low, high)
    above = np.zeros(len(ids), np.int64)  # scores at or over high
    open_ = np.ones(len(ids), bool)
    while open_.any():
        which = np.flatnonzero(open_)
        width = np.maximum(1, -((low[which] - high[which]) // BINS))
        state = spark.sparkContext.broadcast((ids[which], queries[which], low[which], high[which], width))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, q, lo, hi, w = state.value
            total = np.zeros(len(own) * BINS, np.int64)
            for _, score, other in _scored(batches, own, q):
                inside = other & (score >= lo[:, None]) & (score < hi[:, None])
                place = (score - lo[:, None]) // w[:, None] + np.arange(len(own))[:, None] * BINS
                total += np.bincount(place[inside], minlength=len(total))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at // BINS), pa.array(at % BINS), pa.array(total[at])], names=["query", "bin", "n"])

        bins = in_arrow(vectors, count, "query long, bin long, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))
        over = F.sum("n").over(Window.partitionBy("query").orderBy(F.col("bin").desc()))
        need = spark.createDataFrame([(int(i), int(k - a)) for i, a in enumerate(above[which])], "query long, need long")
        # a row per query of the block: the bin at which its k-th greatest score is reached
        reached = (bins.withColumn("over", over).join(F.broadcast(need), "query").filter("over >= need")
                   .groupBy("query").agg(F.max_by(F.struct("bin", "n", "over"), "bin").alias("b")).select("query", "b.*").collect())
        got = {r["query"]: r for r in reached}
        for i, q in enumerate(which):
            r = got.get(i)
            if r is None:  # fewer than k scores in all: everything counts
                open_[q] = False
                continue
            high[q] = min(high[q], low[q] + (r["bin"] + 1) * width[i])
            low[q] += r["bin"] * width[i]
            above[q] += r["over"] - r["n"]
            open_[q] = width[i] > 1 and above[q] + r["n"] > few
    return low


def top_k(vectors: DataFrame, queries: DataFrame | None = None, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024, few: int | None = None) -> DataFrame:
    """(query_id, rank, id, score): of every query the k rows of ``vectors`` of the greatest integer inner
    products with it, but its own; all, if there are fewer.  Ties go to the smaller id.

    Components become floor(scale * x).  Rows with a null id, a null vector, or null
    or non-finite components take no part; a query is scored against vectors of its
    own length.  Rows of ``vectors`` that share an id are candidates each (equal
    scores of one id keep any order); of queries that share an id, the one of the
    least vector stands.  Scores must fit 64 bits.  Without queries the result is empty."""
    spark = vectors.sparkSession
    pool = landed(quantized(vectors, id_col, vector_col, scale), "vectors")
    asked = landed(quantized(vectors if queries is None else queries, id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v")).withColumn("width", F.size("v")), "queries")
    parts = []
    for width, n in sorted((r["width"], r["n"]) for r in asked.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()):
        blocks = -(-n * max(width, 1) // BLOCK_VALUES)
        for b in range(blocks):
            block = asked.filter((F.col("width") == width) & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)).toPandas().sort_values("id")  # about BLOCK_VALUES values
            if not len(block):
                continue
            ids = block["id"].to_numpy(np.int64)
            matrix = np.stack(block["v"].to_numpy()).astype(np.int64).reshape(len(ids), width)
            edges = _select_block(pool, ids, matrix, k, few or 4 * k)
            state = spark.sparkContext.broadcast((ids, matrix, edges))

            def keep(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
                own, q, edge = state.value
                held = np.zeros((0, 3), np.int64)
                for vec, score, other in _scored(batches, own, q):
                    row, col = np.nonzero(other & (score >= edge[:, None]))
                    held = first_k(np.concatenate([held, np.column_stack([row, score[row, col], vec[col]])]), k)
                yield pa.RecordBatch.from_arrays([pa.array(own[held[:, 0]]), pa.array(held[:, 1]), pa.array(held[:, 2])], names=["query_id", "score", "id"])

            parts.append(landed(in_arrow(pool, keep, "query_id long, score long, id long"), "best"))
    if not parts:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def first_k(rows: np.ndarray, k: int) -> np.ndarray:
    """Of rows (query, score, id) the k first of every query by falling score and rising id."""
    order = np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))
    rows = rows[order]
    start = np.flatnonzero(np.diff(rows[:, 0], prepend=-1))
    place = np.arange(len(rows)) - np.repeat(start, np.diff(np.append(start, len(rows))))
    return rows[place < k]
