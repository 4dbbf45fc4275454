"""Importance resampling of documents towards a target distribution.

The features of a text are its runs of 1 to ``max_words`` consecutive words,
hashed into a fixed number of buckets.  Each task counts buckets in one array,
Spark sums the arrays of the documents and of the target texts, and the log
ratio of the two bucket distributions becomes one array of gains.  A second
pass looks the gains up per document.  Adding Gumbel noise from a hash of the
id, the greatest scores are a draw without replacement by those weights.

The cutoff is not found by sorting the scores: a quantile sketch of them gives
a bracket around it, the rows above and inside of the bracket are counted
exactly, the bracket is widened until it holds the cutoff, and the rows inside
of it alone are sorted.  Then the drawn rows are numbered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_rank
from .scratch import in_arrow, landed
from .words import bytes_of, pieces

#: Relative error of the sketch is one in so many rows.
ACCURACY = 10_000
#: Bytes of a feature that are hashed in step with the others; longer ones are hashed alone.
LONG = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    """CRC-32 of every byte, by the reflected polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of the byte stretches [start, end) of ``data``."""
    size = np.minimum(end - start, LONG + 1).astype(np.uint8)
    order = np.argsort(LONG + 1 - size, kind="stable")
    at, left = start[order], size[order]
    c = np.full(len(at), 0xFFFFFFFF, np.uint32)
    longer = len(at) - np.searchsorted(left[::-1], np.arange(LONG), side="right")
    for j in range(int(min(left.max(initial=0), LONG))):
        n = longer[j]
        c[:n] = _CRC[(c[:n] ^ data[at[:n] + j]) & 0xFF] ^ (c[:n] >> np.uint32(8))
    out = np.empty(len(at), np.int64)
    out[order] = c ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(end - start > LONG).tolist():
        out[i] = zlib.crc32(data[start[i]:end[i]].tobytes())
    return out


def features(column: pa.Array, max_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, offsets of the features by text, words by text) of a text column.

    Features are ordered by text, then by length of run."""
    data, at = bytes_of(column)
    data = _LOWER[data]
    word = _WORD[data]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    edges = at[:-1][at[:-1] < len(data)]
    starts[edges] = word[edges]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    lasts = at[1:][at[1:] > 0] - 1
    ends[lasts] = word[lasts]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    offsets = np.searchsorted(first, at)
    words = np.diff(offsets)
    if max_words == 1:
        return crc32(data, first, last) % buckets, offsets, words
    # words joined by one space each, so that a run of words is one stretch of bytes
    size = last - first + 1
    new_last = np.cumsum(size) - 1
    new_first = new_last - size + 1
    joined = np.full(int(size.sum()), 0x20, np.uint8)
    inside = np.repeat(first - new_first, size - 1)
    place = np.delete(np.arange(len(joined)), new_last) if len(first) else np.zeros(0, np.int64)
    joined[place] = data[place + inside]
    text = np.repeat(np.arange(len(words)), words)
    parts, owner = [], []
    for run in range(1, max_words + 1):
        a = np.flatnonzero(np.arange(len(first)) + run <= offsets[1:][text])
        parts.append(crc32(joined, new_first[a], new_last[a + run - 1]) % buckets)
        owner.append(text[a])
    order = np.argsort(np.concatenate(owner), kind="stable")
    counts = np.bincount(np.concatenate(owner), minlength=len(words))
    return np.concatenate(parts)[order], np.concatenate([[0], np.cumsum(counts)]), words


def bucket_counts(texts: DataFrame, text_col: str, max_words: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket: an array of ``buckets`` counts, summed by Spark over the tasks' arrays."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in pieces(batch, "text"):
                total += np.bincount(features(part.column("text"), max_words, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    rows = in_arrow(texts.select(F.col(text_col).alias("text")).filter("text IS NOT NULL"), count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket at most
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the target's share of each bucket over the source's), one added to every count."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    n = float(len(source))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weights(docs: DataFrame, id_col: str, text_col: str, gain: np.ndarray, max_words: int) -> DataFrame:
    """(id, tie, n_words, n_features, weight) of every row; the weight is the floored mean gain of its features."""
    state = docs.sparkSession.sparkContext.broadcast(gain)  # a value per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = state.value
        for batch in batches:
            for part in pieces(batch, "text"):
                bucket, at, words = features(part.column("text"), max_words, len(gain))
                total = np.concatenate([[0], np.cumsum(gain[bucket])])
                n = np.diff(at)
                weight = (total[at[1:]] - total[at[:-1]]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("tie"), *map(pa.array, (words.astype(np.int64), n.astype(np.int64), weight))], names=["id", "tie", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    return in_arrow(rows, run, "id long, tie long, n_words long, n_features long, weight long")


def bracket(pool: DataFrame, want: int, n: int) -> tuple[int, int, int]:
    """(low, high, above): the ``want``-th greatest of ``n`` scores lies in [low, high], and exactly ``above`` lie over it.

    Brackets come from one sketch of the scores, each four times as wide as the one before, at last all
    scores; the exact counts decide, so no error of the sketch moves the cutoff."""
    p, reach = 1 - want / n, [2 * 4**i / ACCURACY for i in range(7)]
    asked = [q for r in reach for q in (max(0.0, p - r), min(1.0, p + r))]
    row = pool.agg(F.percentile_approx("score", asked, ACCURACY).alias("q"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    sides = [(row["q"][2 * i], row["q"][2 * i + 1]) for i in range(len(reach))] + [(row["low"], row["high"])]
    for low, high in sides:
        got = pool.agg(F.count_if(F.col("score") > high).alias("above"), F.count_if(F.col("score").between(low, high)).alias("inside")).first()
        if got["above"] < want <= got["above"] + got["inside"]:
            break
    return low, high, got["above"]


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", max_words: int = 1,
             buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row of ``docs``, all long: the draw of ``percent`` per
    cent of the documents of ``min_words`` words or more towards the words of ``target``, numbered from
    the greatest score on; the rank of documents not drawn is null.

    Words are runs of digits, letters a-z (A-Z are lower-cased) and characters beyond ASCII.  Null and empty texts have no
    features and weight 0; whole texts count, however long.  Ties of scores go to the smaller id.
    Rows that share an id are documents each (equal noise, ties by a hash of their texts; identical rows
    in any order).  Rows with a null id count as features of the documents, but have no score and are
    never drawn.  Without target texts, weights compare with an even distribution.  Empty ``docs``
    give an empty result.  Other columns are not read.  The driver holds ``buckets`` counts."""
    source = bucket_counts(docs, text_col, max_words, buckets)
    gain = gains(source, bucket_counts(target, target_col, max_words, buckets))
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296))).cast("long")
    scored = landed(weights(docs, id_col, text_col, gain, max_words).withColumn("score", score), "scores")
    fit = (F.col("n_words") >= min_words) & F.col("id").isNotNull()
    pool = scored.filter(fit)
    n = pool.count()
    want = percent * n // 100
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    nothing = F.lit(None).cast("long").alias("rank")
    if not want:
        return scored.select(*columns, nothing)
    low, high, above = bracket(pool, want, n)
    order = [F.col("score").desc(), "id", "tie"]
    inside = global_rank(pool.filter(F.col("score").between(low, high)), order, name="place")
    cut = inside.filter(F.col("place") == want - above).first()
    here = (F.col("score") > cut["score"]) | ((F.col("score") == cut["score"]) & ((F.col("id") < cut["id"]) | ((F.col("id") == cut["id"]) & (F.col("tie") <= cut["tie"]))))
    drawn = fit & here
    ranked = global_rank(scored.filter(drawn), order, name="rank")
    # identical rows at the cutoff are drawn only as far as the draw goes
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= want, F.col("rank")))
    return ranked.select(*columns, "rank").unionByName(scored.filter(~F.coalesce(drawn, F.lit(False))).select(*columns, nothing))
