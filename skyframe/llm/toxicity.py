"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs of a word are an embedding of the word's hash and the mean of the
embeddings of its character n-grams (bytes, with marks at both ends).  A
window of ``WINDOW`` words is read in both directions by gated recurrent
cells; attention pools their states, and a logistic unit scores the window.
Windows overlap by half and cover every word of every text.  A text's score is
its highest window's, calibrated on the training texts.

Training is by alternation: a toxic text need only have some toxic windows, so
after some passes with the texts' labels, the windows of toxic texts that
score low are left out of the next passes, in which half of the clean windows are
those that score highest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .scratch import free_name, in_arrow
from .words import U64, Words, mix, pieces, words

WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM = 8, 6, 10
WORD_ROWS, CHAR_ROWS = 1 << 12, 1 << 14
GRAMS = (3, 5)
CHUNK = 1024
#: Part of the distinct words that is blank in a training step, first step size, passes before windows are picked by score.
DROPPED, RATE, MINE = 0.3, 0.02, 3

_rng = np.random.default_rng(11)
_BYTES = _rng.integers(1, 2**64 - 1, (max(GRAMS), 256), dtype=U64)
_BYTES[:, 65:91] = _BYTES[:, 97:123]
MARK = 0x01


@dataclass
class Lexicon:
    """Distinct words of several texts: the row of each word in the two embeddings."""

    word_rows: np.ndarray
    gram_rows: np.ndarray
    gram_at: np.ndarray
    of_word: np.ndarray


def lexicon(w: Words) -> Lexicon:
    """Distinct words of ``w`` with their n-gram rows; ``of_word`` gives each word's place among them."""
    _, first, of_word = np.unique(w.hashes, return_index=True, return_inverse=True)
    if not len(first):
        return Lexicon(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), of_word)
    size = w.ends[first] - w.starts[first] + 2  # with a mark at either end
    at = np.concatenate([[0], np.cumsum(size)])
    slot = np.arange(at[-1]) - np.repeat(at[:-1], size)
    inner = (slot > 0) & (slot < np.repeat(size, size) - 1)
    body = np.full(at[-1], MARK, np.uint8)
    body[inner] = w.data[(np.repeat(w.starts[first], size) + slot - 1)[inner]]
    left = np.repeat(size, size) - slot
    owner, rows = [], []
    for n in GRAMS:
        if len(body) >= n:
            total = sum(_BYTES[j][body[j:len(body) - n + 1 + j]] for j in range(n))
            ok = left[:len(total)] >= n
            rows.append((mix(total[ok] + U64(n)) % U64(CHAR_ROWS)).astype(np.int64))
            owner.append(np.repeat(np.arange(len(size)), size)[:len(total)][ok])
    # grams of one size come in the order of their words; a word of b bytes has b + 3 - n of them, if any
    count = np.stack([np.maximum(size - n + 1, 0) for n in GRAMS])
    gram_at = np.concatenate([[0], np.cumsum(count.sum(0))])
    out = np.empty(gram_at[-1], np.int64)
    for i, (own, row) in enumerate(zip(owner, rows)):
        out[gram_at[own] + count[:i].sum(0)[own] + np.arange(len(own)) - (np.cumsum(count[i]) - count[i])[own]] = row
    return Lexicon((w.hashes[first] % U64(WORD_ROWS)).astype(np.int64), out, gram_at, of_word)


def windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, text) of every window of texts whose words start at ``offsets``: one each
    STRIDE words, the last one moved back to end with the text; a shorter text has one window."""
    counts = np.diff(offsets)
    made = np.where(counts > 0, np.maximum(0, -(-(counts - WINDOW) // STRIDE)) + 1, 0)
    text = np.repeat(np.arange(len(counts)), made)
    k = np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made)
    start = np.minimum(k * STRIDE, np.maximum(counts[text] - WINDOW, 0))
    return offsets[:-1][text] + start, np.minimum(counts[text], WINDOW), text


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters, forward pass and gradients."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        init = lambda *s: (r.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"word": 0.1 * r.normal(size=(WORD_ROWS, WORD_DIM)).astype(np.float32), "char": 0.3 * r.normal(size=(CHAR_ROWS, CHAR_DIM)).astype(np.float32),
                  "in": init(d, 6 * h), "in_b": np.zeros(6 * h, np.float32), "fw": init(h, 3 * h), "bw": init(h, 3 * h),
                  "att": init(2 * h), "out": init(2 * h), "out_b": np.zeros(1, np.float32)}
        self.a, self.b = 1.0, 0.0

    def features(self, lex: Lexicon) -> np.ndarray:
        n = np.diff(lex.gram_at)
        chars = np.stack([np.add.reduceat(column[lex.gram_rows], lex.gram_at[:-1]) for column in np.ascontiguousarray(self.p["char"].T)], 1) / n[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][lex.word_rows], chars], 1)

    def read(self, pre: np.ndarray, mask: np.ndarray | None, u: np.ndarray, backward: bool, keep: bool):
        """States (T, B, H) of a cell over ``pre`` (T, B, 3H), with what its gradient needs if ``keep``."""
        steps, n, _ = pre.shape
        h, out, kept = np.zeros((n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32), []
        for t in range(steps - 1, -1, -1) if backward else range(steps):
            x, g = pre[t], h @ u
            zr = sigmoid(x[:, :2 * HIDDEN] + g[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
            new = c + z * (h - c)
            if mask is not None:
                new = np.where(mask[t][:, None], new, h)
            if keep:
                kept.append((t, h, z, r, c, g[:, 2 * HIDDEN:]))
            h = out[t] = new
        return out, kept

    def forward(self, rows: np.ndarray, mask: np.ndarray | None, feats: np.ndarray, keep: bool = False):
        """Logits of windows; rows (T, B) are places of words in ``feats``, the input projections of distinct words."""
        pre = feats[rows]
        fw, k1 = self.read(pre[:, :, :3 * HIDDEN], mask, self.p["fw"], False, keep)
        bw, k2 = self.read(pre[:, :, 3 * HIDDEN:], mask, self.p["bw"], True, keep)
        states = np.concatenate([fw, bw], 2)
        s = states @ self.p["att"]
        if mask is not None:
            s = np.where(mask, s, np.float32(-1e9))
        e = np.exp(s - s.max(0))
        weight = e / e.sum(0)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        return pooled @ self.p["out"] + self.p["out_b"], (states, weight, pooled, k1, k2)

    def project(self, feats: np.ndarray) -> np.ndarray:
        return feats @ self.p["in"] + self.p["in_b"]

    def logits(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Logit and text of every window of ``w``."""
        first, size, text = windows(w.offsets)
        if not len(first):
            return np.zeros(0, np.float32), text
        lex = lexicon(w)
        feats, out = self.project(self.features(lex)), np.empty(len(first), np.float32)
        for full in (True, False):
            which = np.flatnonzero((size == WINDOW) == full)
            for i in range(0, len(which), CHUNK):
                part = which[i:i + CHUNK]
                rows, mask = window_rows(lex, first[part], size[part])
                out[part] = self.forward(rows, None if full else mask, feats)[0]
        return out, text

    def gradient(self, lex: Lexicon, rows: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray, drop: np.random.Generator | None = None) -> dict[str, np.ndarray]:
        """Gradient of the weighted mean logistic loss of some windows."""
        used, rows = np.unique(rows, return_inverse=True)
        rows = rows.reshape(mask.shape)
        at = lex.gram_at
        n = at[used + 1] - at[used]
        gram_at = np.concatenate([[0], np.cumsum(n)])
        sub = Lexicon(lex.word_rows[used], lex.gram_rows[np.arange(gram_at[-1]) + np.repeat(at[used] - gram_at[:-1], n)], gram_at, rows)
        x = self.features(sub)
        if drop is not None:  # some distinct words are blank in this step
            x *= drop.random((len(x), 1), np.float32) > DROPPED
        logit, (states, attention, pooled, k1, k2) = self.forward(rows, mask, self.project(x), keep=True)
        g = {}
        d = ((sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        g["out"], g["out_b"] = pooled.T @ d, d.sum(keepdims=True)
        dp = d[:, None] * self.p["out"]
        da = np.einsum("bh,tbh->tb", dp, states)
        ds = attention * (da - (attention * da).sum(0))
        g["att"] = np.einsum("tb,tbh->h", ds, states)
        dh = attention[:, :, None] * dp + ds[:, :, None] * self.p["att"]
        dpre = np.zeros((*rows.shape, 6 * HIDDEN), np.float32)
        for name, kept, lo in (("fw", k1, 0), ("bw", k2, 1)):
            u, du = self.p[name], np.zeros_like(self.p[name])
            after = np.zeros((rows.shape[1], HIDDEN), np.float32)
            for t, h, z, r, c, gc in reversed(kept):
                total = dh[t, :, lo * HIDDEN:(lo + 1) * HIDDEN] + after
                m = mask[t][:, None]
                new = total * m
                dc = new * (1 - z) * (1 - c * c)
                dz = new * (h - c) * z * (1 - z)
                dr = dc * gc * r * (1 - r)
                dg = np.concatenate([dz, dr, dc * r], 1)
                dpre[t, :, lo * 3 * HIDDEN:(lo + 1) * 3 * HIDDEN] = np.concatenate([dz, dr, dc], 1)
                du += h.T @ dg
                after = total * ~m + new * z + dg @ u.T
            g[name] = du
        flat = dpre.reshape(-1, 6 * HIDDEN)
        order = np.argsort(rows.ravel(), kind="stable")
        dw = np.add.reduceat(flat[order], np.searchsorted(rows.ravel()[order], np.arange(len(used))))
        g["in"], g["in_b"] = x.T @ dw, dw.sum(0)
        dx = dw @ self.p["in"].T
        g["word"], g["char"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["char"])
        np.add.at(g["word"], sub.word_rows, dx[:, :WORD_DIM])
        np.add.at(g["char"], sub.gram_rows, np.repeat(dx[:, WORD_DIM:] / n[:, None].astype(np.float32), n, axis=0))
        return g


def window_rows(lex: Lexicon, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows' words among the distinct ones (T, B), and which are there."""
    step = np.arange(WINDOW)[:, None]
    mask = step < size
    return lex.of_word[first + np.where(mask, step, 0)], mask


def joined(parts: list[Words]) -> Words:
    """Words of several columns as those of one."""
    parts = parts or [words(pa.array([], pa.string()))]
    byte = np.cumsum([0] + [len(p.data) for p in parts])
    word = np.cumsum([0] + [len(p.hashes) for p in parts])
    cat = lambda name, shift: np.concatenate([getattr(p, name) + s for p, s in zip(parts, shift)])
    return Words(np.concatenate([p.data for p in parts]), np.concatenate([*[p.at[:-1] + s for p, s in zip(parts, byte)], byte[-1:]]),
                 cat("starts", byte), cat("ends", byte), np.concatenate([p.hashes for p in parts]),
                 np.concatenate([*[p.offsets[:-1] + s for p, s in zip(parts, word)], word[-1:]]))


def train(texts: list[str], labels: np.ndarray, passes: int = 6, per_pass: int = 8000, batch: int = 192, seed: int = 5) -> Network:
    """Network fitted to texts and their labels (0 or 1); ``per_pass`` windows at most are read per pass,
    half of them from toxic texts.  Every fourth text of either label is only used to calibrate the score."""
    net, r = Network(), np.random.default_rng(seed)
    w = joined([words(pa.array(texts[i:i + 64], pa.string())) for i in range(0, len(texts), 64)])
    first, size, text = windows(w.offsets)
    y = labels[text].astype(np.float32) if len(text) else np.zeros(0, np.float32)
    held = np.zeros(len(texts), bool)
    for side in (0, 1):
        held[np.flatnonzero(labels == side)[3::4]] = True
    if min(held[labels == 0].sum(), held[labels == 1].sum()) == 0:
        held[:] = False
    if len(np.unique(y)) < 2:  # nothing to tell apart
        net.p["out"][:] = 0
        net.b = 6.0 if len(y) and y[0] else -6.0
        return net
    lex, moment, square, step = lexicon(w), {}, {}, 0
    use = np.ones(len(y), bool)
    for p in range(passes):
        pick = []
        for side in (0, 1):
            some = np.flatnonzero(use & (y == side) & ~held[text])
            n = min(len(some), per_pass // 2)
            hard = some[np.argsort(-logit[some], kind="stable")[:n // 2]] if p >= MINE and side == 0 else some[:0]
            pick += [hard, r.choice(np.setdiff1d(some, hard), n - len(hard), replace=False)]
        pick = r.permutation(np.concatenate(pick))
        share = max(y[pick].mean(), 1e-3)
        weight = np.where(y == 1, 0.5 / share, 0.5 / max(1 - share, 1e-3)).astype(np.float32)
        for i in range(0, len(pick), batch):
            b = pick[i:i + batch]
            rows, mask = window_rows(lex, first[b], size[b])
            rate = RATE * (1 - 0.95 * (p + i / len(pick)) / passes)
            g, step = net.gradient(lex, rows, mask, y[b], weight[b], r), step + 1
            for k, v in g.items():
                moment[k] = 0.9 * moment.get(k, 0) + 0.1 * v
                # one scale for a whole table of embeddings: rows that are seen often then move more than rare ones
                power = np.float32((v * v).sum() / max(np.count_nonzero(v), 1)) if k in ("word", "char") else v * v
                square[k] = 0.99 * square.get(k, 0) + 0.01 * power
                net.p[k] -= (rate * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        logit = net.logits(w)[0]
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, text, logit)
        if p + 1 >= MINE:
            use = (y == 0) | (logit >= np.minimum(0.0, best[text]))
    some = np.isfinite(best) & (held | ~held.any())
    net.a, net.b = calibrate(best[some], labels[some])
    return net


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic unit over the texts' highest logits, slightly shrunk."""
    scale = float(np.std(x)) or 1.0
    m = np.stack([x / scale, np.ones_like(x)], 1)
    weight = np.full(len(y), 1 / max(len(y), 1))
    c = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = sigmoid(m @ c)
        grad = m.T @ (weight * (p - y)) + 1e-5 * c
        c = c - np.linalg.solve((m * (weight * p * (1 - p))[:, None]).T @ m + 1e-5 * np.eye(2), grad)
    return float(c[0] / scale), float(c[1])


def crc_bucket(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int, max_chars: int) -> pd.DataFrame:
    """at most ``per_class`` documents of either label, of ``max_chars`` code points at most, in order of a
    hash of their id; so the driver never holds more than 2 * per_class * max_chars code points."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).filter("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.length("text").between(1, max_chars))
    known = rows.select("id").join(marks, "id")
    part = [known.filter(F.col("y") == v).dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(per_class) for v in (0, 1)]
    chosen = part[0].union(part[1]).toPandas()  # 2 * per_class rows at most
    spark = docs.sparkSession
    if chosen.empty:
        return pd.DataFrame({"id": [], "text": [], "y": []})
    few = F.broadcast(spark.createDataFrame([(int(i),) for i in chosen["id"]], "id long"))
    texts = rows.join(few, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")).toPandas()
    return texts.merge(chosen, on="id").sort_values("id", ignore_index=True)


def with_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                  learn: Column | None = None, per_class: int = 1000, max_chars: int = 4000) -> tuple[DataFrame, str, str]:
    """``docs`` with a score and a prediction, and the names of these two columns.

    Learns from a sample of labelled documents for whose rows ``learn`` holds
    (all if None): at most ``per_class`` of either label, each of ``max_chars``
    code points at most.  Scores read whole texts and nothing else.  Null and
    empty texts, and texts without words, score 0.  Without labels, or with
    one label only, all texts score near that label's side (0 without any).
    A document labelled twice is toxic if either label says so; rows with null
    or repeated ids are scored like any other."""
    pool = docs if learn is None else docs.filter(learn)
    sample = labelled_sample(pool, labels, id_col, text_col, label_col, per_class, max_chars)
    net = train(sample["text"].tolist(), sample["y"].to_numpy(np.int64))
    model = docs.sparkSession.sparkContext.broadcast(net)
    names = free_name(docs, "score"), free_name(docs, "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        for batch in batches:
            for part in pieces(batch, text_col):
                w = words(part.column(text_col))
                logit, text = net.logits(w)
                best = np.full(len(w), -np.inf)
                np.maximum.at(best, text, logit)
                some = np.isfinite(best)
                score = np.where(some, sigmoid(np.clip(net.a * np.where(some, best, 0) + net.b, -30, 30)), 0.0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], names=[*part.schema.names, *names])

    shape = StructType([*docs.schema.fields, StructField(names[0], DoubleType()), StructField(names[1], IntegerType())])
    return in_arrow(docs, run, shape), *names


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, score, predicted) of every row of ``docs``; see ``with_toxicity``."""
    out, score, predicted = with_toxicity(docs.select(id_col, text_col), labels, id_col, text_col, **options)
    return out.select(id_col, F.col(score).alias("score"), F.col(predicted).alias("predicted"))
