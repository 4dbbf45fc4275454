"""Language identification by string kernels.

The kernel of two texts is the number of character n-grams of all lengths in
``GRAMS`` that both have (presence, not counts), divided by the geometric
mean of their own numbers.  Nyström landmarks drawn from labelled texts give
each text a feature per landmark; one ridge regression per language on those
features (one versus the rest) scores it.  N-grams go by 64-bit codes: those of
a text are looked up in a dictionary of the landmarks' own, and the kernels of a batch
of texts with all landmarks are products of two presence matrices over it, so kernels
are exact for texts of every length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import in_arrow, landed
from .words import U64, pieces

GRAMS = (1, 2, 3, 4)
ROWS, BLOCK = 64, 1 << 14
UNKNOWN = "und"
_factors = np.random.default_rng(31).integers(1, 2**64 - 1, (max(GRAMS) + 1, max(GRAMS)), dtype=U64) | U64(1)


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts of a column, digits as 0 and white space as blanks, and the texts' offsets."""
    texts = pc.fill_null(column.cast(pa.string()), "")
    lower = pc.utf8_lower(texts)
    at = np.concatenate([[0], np.cumsum(pc.utf8_length(lower).to_numpy(zero_copy_only=False))]).astype(np.int64)
    points = np.frombuffer("".join(lower.to_pylist()).encode("utf-32-le"), np.uint32)
    points = np.where((points >= 48) & (points < 58), np.uint32(48), points)
    return np.where(points <= 32, np.uint32(32), points), at


def grams(column: pa.Array) -> list[np.ndarray]:
    """Codes of the distinct n-grams of each whole text."""
    points, at = code_points(column)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        wide, codes = points[a:b].astype(U64), [np.zeros(0, U64)]
        for k in GRAMS:
            if b - a >= k:
                code = np.zeros(b - a - k + 1, U64)
                for j in range(k):
                    code += wide[j:b - a - k + 1 + j] * _factors[k, j]
                codes.append(np.unique(code))
        out.append(np.unique(np.concatenate(codes)))
    return out


class Landmarks:
    """The n-grams of the landmarks, each with one bit for every landmark that has it."""

    def __init__(self, texts: list[np.ndarray]):
        self.sizes = np.array([len(t) for t in texts])
        self.codes, place = np.unique(np.concatenate(texts), return_inverse=True)
        holds = np.zeros((len(self.codes), len(texts)), bool)
        holds[place, np.repeat(np.arange(len(texts)), self.sizes)] = True
        self.bits = np.packbits(holds, axis=1)

    def kernel(self, texts: list[np.ndarray]) -> np.ndarray:
        """Normalized presence kernels of texts with all landmarks; a text without n-grams has 0 with all.
        Texts by n-grams times n-grams by landmarks, ``BLOCK`` n-grams at a time."""
        sizes = np.array([len(t) for t in texts])
        grams_of = np.concatenate([np.zeros(0, U64), *texts])
        shared = np.zeros((len(texts), len(self.sizes)))
        if len(grams_of) and len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, grams_of), len(self.codes) - 1)
            known = self.codes[at] == grams_of
            at, row = at[known], np.repeat(np.arange(len(texts)), sizes)[known]
            order = np.argsort(at)
            at, row = at[order], row[order]
            edges = np.searchsorted(at, np.arange(0, len(self.codes) + BLOCK, BLOCK))
            for i, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                if hi > lo:
                    held = np.unpackbits(self.bits[i * BLOCK:(i + 1) * BLOCK], axis=1, count=len(self.sizes)).astype(np.float32)
                    has = np.zeros((len(texts), len(held)), np.float32)
                    has[row[lo:hi], at[lo:hi] - i * BLOCK] = 1
                    shared += has @ held
        return (shared / np.sqrt(np.maximum(sizes, 1.0)[:, None] * np.maximum(self.sizes, 1.0)[None])).astype(np.float32)


class Classifier:
    """Landmarks, their whitening and one ridge regression per language."""

    def __init__(self, texts: list[str], langs: list[str], landmarks: int = 96, ridge: float = 1e-3, seed: int = 13):
        self.langs = sorted(set(langs))
        if not self.langs:
            return
        x = [t for i in range(0, len(texts), ROWS) for t in grams(pa.array(texts[i:i + ROWS], pa.string()))]
        r = np.random.default_rng(seed)
        y = np.array([self.langs.index(v) for v in langs])
        share = max(1, landmarks // len(self.langs))
        chosen = np.concatenate([r.permutation(np.flatnonzero(y == c))[:share] for c in range(len(self.langs))])
        self.landmarks = Landmarks([x[c] for c in chosen])
        values, vectors = np.linalg.eigh(self.landmarks.kernel([x[c] for c in chosen]).astype(np.float64))
        keep = values > 1e-6 * values.max()
        self.whiten = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)
        phi = self.features(x).astype(np.float64)
        target = np.where(y[:, None] == np.arange(len(self.langs)), 1.0, -1.0)
        weight = (1 / np.bincount(y, minlength=len(self.langs)))[y]  # languages count alike
        self.weights = np.linalg.solve((phi * weight[:, None]).T @ phi + ridge * np.eye(phi.shape[1]), (phi * weight[:, None]).T @ target).astype(np.float32)

    def features(self, x: list[np.ndarray]) -> np.ndarray:
        phi = self.landmarks.kernel(x) @ self.whiten
        return np.concatenate([phi, np.ones((len(phi), 1), np.float32)], 1)

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        if not self.langs:
            return [UNKNOWN] * len(column), np.zeros(len(column))
        margin = self.features(grams(column)) @ self.weights
        e = np.exp(4.0 * (margin - margin.max(1, keepdims=True)))
        score = (e.max(1) / e.sum(1)).astype(np.float64)
        letters = pc.fill_null(pc.match_substring_regex(column.cast(pa.string()), r"\pL"), False).to_numpy(zero_copy_only=False)
        best = margin.argmax(1)
        return [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters)], np.where(letters, score, 0.0)


def excerpt(text: Column, chars: int, parts: int = 4) -> Column:
    """The whole text, or, of one of more than ``chars`` code points, ``parts`` stretches of ``chars // parts`` spread evenly from its start to its end."""
    n, width = F.length(text), chars // parts
    starts = [F.floor((n - width) * i / (parts - 1)).cast("int") + 1 for i in range(parts)]
    return F.when(n <= chars, text).otherwise(F.concat_ws(" ", *[F.substring(text, at, F.lit(width)) for at in starts]))


def language_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int, max_chars: int) -> pd.DataFrame:
    """``per_lang`` texts of each language (all, if fewer), those with the least hashes of their ids, each as an excerpt of about ``max_chars`` code points.

    The ids of each language are counted (approximately) first, so that rows are kept by a bound on their hash alone,
    without sorting a language: about ``per_lang`` and ten deviations more reach the driver, which takes the first ``per_lang``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("hash")).filter(
        F.col("lang").isNotNull() & F.col("id").isNotNull() & (F.length("text") > 0))
    part = (1.1 * per_lang + 10 * per_lang ** 0.5) / F.approx_count_distinct("id", 0.02)
    share = landed(rows.groupBy(F.col("lang").alias("_lang")).agg(part.alias("part")), "shares")  # its bytes are known: texts are not shuffled for it
    few = rows.join(share, F.col("lang") == F.col("_lang")).filter(F.shiftrightunsigned("hash", 11) / F.lit(float(1 << 53)) < F.col("part"))
    got = few.groupBy("lang", "id", "hash").agg(F.min(excerpt(F.col("text"), max_chars)).alias("text")).toPandas()
    got = got.sort_values(["lang", "hash", "id"], ignore_index=True).groupby("lang").head(per_lang)
    return got.sort_values(["id", "lang"], ignore_index=True)


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", learn: Column | None = None,
              per_lang: int = 400, max_chars: int = 6000, landmarks: int = 96) -> DataFrame:
    """(id, lang_pred, score) of every row of ``docs``.

    Learns from the text and non-null language of documents for which
    ``learn`` holds (all if None): at most ``per_lang`` of each language, those
    of more than ``max_chars`` code points by stretches spread over them; scores
    read whole texts.  A text that
    is null or has no letter is ``und`` with score 0, as are all texts where
    nothing is labelled.  Rows with null or repeated ids are scored alike."""
    sample = language_sample(docs if learn is None else docs.filter(learn), id_col, text_col, lang_col, per_lang, max_chars)
    model = docs.sparkSession.sparkContext.broadcast(Classifier(sample["text"].tolist(), sample["lang"].tolist(), landmarks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = model.value
        for batch in batches:
            for part in pieces(batch, "text"):
                for i in range(0, len(part), ROWS):
                    few = part.slice(i, ROWS)
                    lang, score = classifier.predict(few.column("text"))
                    yield pa.RecordBatch.from_arrays([few.column("id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return in_arrow(rows, run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
