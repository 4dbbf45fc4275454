"""Word and shingle hashes of whole Arrow text columns, without a Python loop per word.

A word is a run of bytes other than ASCII white space, with A-Z lower-cased.
Its 64-bit hash is a polynomial over a random byte table, so all words of a
piece of a batch are hashed by a few numpy passes.  A piece holds whole texts
of about ``PIECE_BYTES`` together; one longer text makes a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
U64 = np.uint64
_rng = np.random.default_rng(20240607)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_TABLE = _rng.integers(1, 2**64 - 1, 256, dtype=U64)
_TABLE[65:91] = _TABLE[97:123]
_TABLE[SPACE] = 0
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POSITION = _rng.integers(1, 2**64 - 1, 64, dtype=U64) | U64(1)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value over all of its bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        out = np.full(max(n, PIECE_BYTES * 2), base, U64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if len(have) <= 4 * PIECE_BYTES:  # a rare long text does not stay in memory
            _powers[name] = have
    return have[:n]


@dataclass
class Words:
    """Words of several texts: ``hashes`` in order, those of text t at [offsets[t], offsets[t+1]).
    ``starts`` and ``ends`` are byte positions in ``data``; text t's bytes are [at[t], at[t+1])."""

    data: np.ndarray
    at: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its texts; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return (data[offsets[0]:offsets[-1]], offsets - offsets[0]) if len(column) else (data[:0], np.zeros(1, np.int64))


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts together have about ``limit`` bytes; each has one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths, dtype=np.int64) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(lengths)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def words(column: pa.Array) -> Words:
    """Words of every text of a column."""
    data, at = bytes_of(column)
    n = len(data)
    space = SPACE[data]
    first = np.ones(n, bool)
    if n:
        first[1:] = space[:-1]
        first[at[:-1][at[:-1] < n]] = True
        first &= ~space
    starts = np.flatnonzero(first)
    ends = np.zeros(0, np.int64)
    hashes = np.zeros(0, U64)
    if len(starts):
        last = np.ones(n, bool)
        last[:-1] = space[1:]
        inner = at[1:]
        last[inner[inner > 0] - 1] = True
        ends = np.flatnonzero(last & ~space) + 1
        hashes = mix(np.add.reduceat(_TABLE[data] * _power("up", _BASE, n), starts) * _power("down", _BASE_INV, n)[starts])
    return Words(data, at, starts, ends, hashes, np.searchsorted(starts, at).astype(np.int64))


def shingles(hashes: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k adjacent words of each text, in order, and their offsets by text.
    A text of 1 to k-1 words has one shingle, its whole sequence; one without words has none."""
    counts = np.diff(offsets)
    made = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_at = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(out_at[-1], U64)
    if len(hashes) >= k:
        full = np.zeros(len(hashes) - k + 1, U64)
        for j in range(k):
            full += hashes[j:j + len(full)] * _POSITION[j]
        text = np.repeat(np.arange(len(counts)), np.where(counts >= k, made, 0))
        slot = np.arange(len(text)) - np.repeat(np.cumsum(np.where(counts >= k, made, 0)) - np.where(counts >= k, made, 0), np.where(counts >= k, made, 0))
        out[out_at[text] + slot] = mix(full[offsets[text] + slot] + U64(k))
    for short in range(1, k):
        rows = np.flatnonzero(counts == short)
        if len(rows):
            total = np.zeros(len(rows), U64)
            for j in range(short):
                total += hashes[offsets[rows] + j] * _POSITION[j]
            out[out_at[rows]] = mix(total + U64(short))
    return out, out_at


def distinct(values: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct values of each text."""
    return [np.unique(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def long_lists(parts: list[np.ndarray]) -> pa.ListArray:
    """Arrays of 64-bit values as an Arrow list<int64> column."""
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))
