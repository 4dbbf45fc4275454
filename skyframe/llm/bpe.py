"""Byte-level BPE by a segment tree over the ranks of adjacent pairs.

Leaf i of a word's tree holds (rank, i) of the pair that starts at symbol i,
or nothing if that pair has no merge; every inner node holds the lesser of
its two children.  So the root is the leftmost pair of lowest rank.  A merge
changes three leaves and the paths above them; it ends when the root is
empty.  Words of up to ``LOCKSTEP`` bytes are merged many at a time, one
merge of each per step, on trees that lie side by side in one numpy array;
longer words have a tree of their own.

The vocabulary is a ``tokenizers`` JSON file read by the driver and broadcast
(its size does not depend on the data).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import in_arrow
from .words import pieces

LOCKSTEP = 64
#: Words kept in a worker: two generations of so many, of which the older goes when the newer is full.
CACHED_WORDS = 200_000
NONE = np.int64(1) << np.int64(62)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it
    prints in Latin-1, else the next one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(prints) else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Merges, tokens and special tokens of a byte-level BPE file, and the word pattern."""

    #: Fixed value: the word pattern of byte-level vocabularies of this kind.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, text: str):
        spec = json.loads(text)
        ids = spec["model"]["vocab"]
        symbols = byte_symbols()
        self.size = max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.byte_ids = np.array([ids[c] for c in symbols], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_rank = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.ranks = {int(k): int(r) for k, r in zip(self.keys[::-1], self.key_rank[::-1])}
        back = {c: b for b, c in enumerate(symbols)}
        tokens = [b""] * self.size
        for token, i in ids.items():
            tokens[i] = bytes(back[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            tokens[i] = token.encode()
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_len = np.array([len(t) for t in tokens], np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.split = regex.compile(self.PATTERN).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where it has no merge or a side is absent (-1)."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.key_rank[at], NONE)

    def together(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids (as int32 bytes) of words of at most ``width`` bytes; width is a power of two."""
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        cols = width + 2
        sym = np.full((n, cols), -1, np.int32)
        sym[np.arange(cols) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        after = np.tile(np.arange(1, cols + 1, dtype=np.int64), (n, 1))
        before = np.tile(np.arange(-1, cols - 1, dtype=np.int64), (n, 1))
        tree = np.full((n, 2 * width), NONE, np.int64)
        place = np.arange(width, dtype=np.int64)
        rank = self.rank(sym[:, :width], sym[:, 1:width + 1])
        tree[:, width:] = np.where(rank < NONE, rank * LOCKSTEP + place, NONE)
        node = width // 2
        while node:
            tree[:, node:2 * node] = np.minimum(tree[:, 2 * node:4 * node:2], tree[:, 2 * node + 1:4 * node:2])
            node //= 2
        flat_sym, flat_after, flat_before, flat = sym.ravel(), after.ravel(), before.ravel(), tree.ravel()
        rows = np.arange(n, dtype=np.int64)
        while True:
            root = flat[rows * (2 * width) + 1]
            live = root < NONE
            if not live.any():
                break
            rows, root = rows[live], root[live]
            at, first = root % LOCKSTEP, rows * cols
            made = self.merged[root // LOCKSTEP]
            right = flat_after[first + at]
            following = flat_after[first + right]
            leading = flat_before[first + at]
            flat_sym[first + at] = made
            flat_sym[first + right] = -1
            flat_after[first + at] = following
            flat_before[first + following] = at
            lead_sym = np.where(leading >= 0, flat_sym[first + np.maximum(leading, 0)], -1)
            own = self.rank(made, flat_sym[first + following])
            lead = self.rank(lead_sym, made)
            base = (rows * (2 * width))[:, None]
            leaves = np.stack([np.minimum(right, width - 1), at, np.where(leading >= 0, leading, at)], 1)
            own_key = np.where(own < NONE, own * LOCKSTEP + at, NONE)
            values = np.stack([np.full(len(rows), NONE), own_key, np.where(leading >= 0, np.where(lead < NONE, lead * LOCKSTEP + leading, NONE), own_key)], 1)
            spot = leaves + width
            flat[(base + spot)] = values
            while spot[0, 0] > 1:
                spot >>= 1
                flat[base + spot] = np.minimum(flat[base + 2 * spot], flat[base + 2 * spot + 1])
        keep = sym >= 0
        ends = np.cumsum(keep.sum(1)) * 4
        body = sym[keep].tobytes()
        return [body[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def alone(self, word: bytes) -> bytes:
        """Ids (as int32 bytes) of one word of any length."""
        sym = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(sym)
        width = 1 << max(1, (n - 1).bit_length())
        none = (len(self.merged), 0)
        tree = [none] * (2 * width)

        def leaf(i: int, j: int) -> tuple[int, int]:
            r = self.ranks.get(sym[i] * self.size + sym[j])
            return none if r is None else (r, i)

        tree[width:width + n - 1] = [leaf(i, i + 1) for i in range(n - 1)]
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: tuple[int, int]) -> None:
            node = width + i
            tree[node] = value
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        while tree[1] is not none and tree[1] != none:
            r, i = tree[1]
            j = after[i]
            sym[i], sym[j] = int(self.merged[r]), -1
            after[i] = after[j]
            put(j, none)
            if after[i] < n:
                before[after[i]] = i
                put(i, leaf(i, after[i]))
            else:
                put(i, none)
            if before[i] >= 0:
                put(before[i], leaf(before[i], i))
        return np.array([s for s in sym if s >= 0], np.int32).tobytes()

    def learn(self, words) -> None:
        """Put the ids of words into the cache."""
        by_width: dict[int, list[str]] = {}
        for w in words:
            b = len(w) if w.isascii() else len(w.encode())
            by_width.setdefault(1 << max(1, (b - 1).bit_length()) if b <= LOCKSTEP else 0, []).append(w)
        for width, some in by_width.items():
            raw = [w.encode() for w in some]
            if width:
                for i in range(0, len(raw), 4096):
                    self.cache.update(zip(some[i:i + 4096], self.together(raw[i:i + 4096], width)))
            else:
                self.cache.update(zip(some, map(self.alone, raw)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (as int32 bytes) of whole texts."""
        if len(self.cache) > CACHED_WORDS:
            self.cache, self.older = {}, self.cache
        plans = []
        for t in texts:
            parts = self.specials.split(t) if self.specials and any(s in t for s in self.special) else [t]
            plans.append([self.special[p] if i % 2 else self.split(p) for i, p in enumerate(parts)])
        new = set().union(*(part for plan in plans for part in plan if isinstance(part, list))).difference(self.cache)
        again = new.intersection(self.older)
        self.cache.update((w, self.older[w]) for w in again)
        self.learn(new - again)
        get = self.cache.__getitem__
        return [b"".join([b"".join(map(get, part)) if isinstance(part, list) else np.int32(part).tobytes() for part in plan]) for plan in plans]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """UTF-8 of the text of each list of ids, list i at [at[i], at[i+1]); bytes that form no
        character become U+FFFD, ids outside of the vocabulary nothing."""
        inside = (ids >= 0) & (ids < self.size)
        ids = np.where(inside, ids, 0)
        size = np.where(inside, self.token_len[ids], 0)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        body = self.token_bytes[np.arange(total) + np.repeat(self.token_at[ids] - (ends - size), size)].tobytes()
        edges = np.concatenate([[0], ends])[at].tolist()
        return [body[a:b].decode("utf-8", "replace").encode() for a, b in zip(edges, edges[1:])]


_ready: dict[int, Vocabulary] = {}


def _vocabulary(source) -> Vocabulary:
    """One per Python worker and broadcast."""
    if source.id not in _ready:
        _ready.clear()
        _ready[source.id] = Vocabulary(source.value)
    return _ready[source.id]


class Source:
    """A tokenizer file as broadcast text, with an id by which workers keep what they build from it."""

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            self.text = spark.sparkContext.broadcast(f.read())
        self.id = path

    @property
    def value(self) -> str:
        return self.text.value


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row of ``docs``: its whole text under the vocabulary file ``path``.

    Special tokens' strings in a text become their ids; none are added.  Null
    and empty texts have no ids.  Rows with null or repeated ids are encoded
    like any other; columns other than the two named are not read."""
    source = Source(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(source)
        for batch in batches:
            for part in pieces(batch, "text"):
                found = vocabulary.encode([t or "" for t in part.column("text").to_pylist()])
                at = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("id"), ids], names=["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return in_arrow(rows, run, f"id {kind}, ids array<int>").select(F.col("id").alias(id_col), "ids")


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, text) of every row of ``docs``: its whole text encoded, and its ids decoded, by one
    Python worker per task (so one vocabulary and one word cache are held, not two).
    Cases are those of ``bpe_encode`` and ``bpe_decode``."""
    source = Source(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(source)
        for batch in batches:
            for part in pieces(batch, "text"):
                found = vocabulary.encode([t or "" for t in part.column("text").to_pylist()])
                at = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])])
                flat = np.frombuffer(b"".join(found), np.int32)
                texts = pa.array(vocabulary.decode(flat, at), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat)), texts], names=["id", "ids", "text"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return in_arrow(rows, run, f"id {kind}, ids array<int>, text string").select(F.col("id").alias(id_col), "ids", "text")


def bpe_decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, text) of every row of ``tokens``; null ids decode to the empty text."""
    source = Source(tokens.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(source)
        for batch in batches:
            lists = batch.column("ids")
            counts = np.array([len(x) if x is not None else 0 for x in lists.to_numpy(zero_copy_only=False)], np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            cuts = np.cumsum(counts)
            edges = [0, *(np.flatnonzero(np.diff(cuts // 400_000)) + 1).tolist(), len(counts)]
            cuts = np.concatenate([[0], cuts])
            for a, b in zip(edges, edges[1:]):
                if b > a:
                    texts = vocabulary.decode(ids[cuts[a]:cuts[b]], cuts[a:b + 1] - cuts[a])
                    part = batch.slice(a, b - a)
                    yield pa.RecordBatch.from_arrays([part.column("id"), part.column("ids"), pa.array(texts, pa.binary()).cast(pa.string())], names=["id", "ids", "text"])

    rows = tokens.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return in_arrow(rows, run, f"id {kind}, ids array<int>, text string").select(F.col("id").alias(id_col), "ids", "text")
