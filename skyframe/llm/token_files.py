"""Token-id files: frequency-ranked ids in byte-aligned code with separate control bytes.

Ids are replaced by their rank by frequency over the whole corpus, so common
ids take one byte.  A rank takes 1 to 4 bytes, least byte first; its length
less one takes two bits of a control byte, four ranks to a byte, the first in
the lowest bits.  Control bytes and data bytes lie apart, so both sides work
by numpy table lookup over whole blocks.

Files hold blocks, one after another, each of whole documents:

    "SVB1", u32 partition, u64 ids before the block in its partition,
    u32 documents, u64 ids, u64 data bytes,
    documents x u8 (1: id is null), documents x i64 id, documents x u32 length,
    control bytes, data bytes, "\\n"

Partitions ascend with the document id.  The folder ``ids`` holds the files,
``ranks`` a Parquet table (id, rank).  Spark's text sink writes the blocks, so
any file system that Spark writes to will do.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import Source
from .scratch import discard, in_arrow, landed
from .words import U64, pieces, words

BLOCK_IDS = 1 << 18
BLOCKS_PER_FILE = 64
MAGIC, HEAD = b"SVB1", "<4sIQIQQ"
#: Lengths of the four values that a control byte describes.
LENGTHS = np.array([[(c >> (2 * i) & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = values.astype(np.uint32)
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    four = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    four[:len(v)] = extra
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    at = np.cumsum(extra + np.int64(1)) - extra - 1
    data = np.zeros(int(at[-1] + extra[-1] + 1) if len(v) else 0, np.uint8)
    for j in range(4):
        long = extra >= j
        data[at[long] + j] = (v[long] >> np.uint32(8 * j)) & np.uint32(0xFF)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of control bytes and data bytes (both uint8)."""
    size = LENGTHS[control].ravel()[:n].astype(np.int64)
    at = np.cumsum(size) - size
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    out = padded[at]
    for j in range(1, 4):
        out |= np.where(size > j, padded[at + j] << np.uint32(8 * j), np.uint32(0))
    return out


class HashIndex:
    """Numbers of 64-bit hashes, in arrays with open addressing: whole arrays are looked up at a time.
    The arrays double when they would be more than half full."""

    BITS = 21

    def __init__(self):
        self.count = 0
        self.clear(self.BITS)

    def clear(self, bits: int) -> None:
        self.bits, self.keys, self.numbers = bits, np.zeros(1 << bits, U64), np.zeros(1 << bits, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for those not there."""
        out = np.full(len(hashes), -1, np.int64)
        which, at, wanted = np.arange(len(hashes)), (hashes >> U64(64 - self.bits)).astype(np.int64), np.maximum(hashes, U64(1))
        while len(which):
            there = self.keys[at]
            hit = there == wanted
            out[which[hit]] = self.numbers[at[hit]]
            on = ~hit & (there != 0)
            which, at, wanted = which[on], (at[on] + 1) & ((1 << self.bits) - 1), wanted[on]
        return out

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Number distinct hashes that are not there yet, in order."""
        numbers = self.count + np.arange(len(hashes))
        self.count += len(hashes)
        if 2 * self.count > len(self.keys):
            used = np.flatnonzero(self.keys)
            keys, old = self.keys[used], self.numbers[used]
            self.clear((2 * self.count - 1).bit_length())
            self.put(keys, old)
        self.put(hashes, numbers)
        return numbers

    def put(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        left, at, wanted = numbers, (hashes >> U64(64 - self.bits)).astype(np.int64), np.maximum(hashes, U64(1))
        while len(left):
            free = np.flatnonzero(self.keys[at] == 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.numbers[at[put]] = wanted[put], left[put]
            on = np.ones(len(left), bool)
            on[put] = False
            left, at, wanted = left[on], (at[on] + 1) & ((1 << self.bits) - 1), wanted[on]


class WordEncoder:
    """Ids of texts by the tokenizers library, called once per distinct word that a worker meets.

    Right for tokenizers whose normalizer and word pattern never reach across ASCII white space
    and whose last token of a word is marked as such.  Words are told apart by their 64-bit hash."""

    KEPT, TOGETHER = 800_000, 500
    MARKS = (b".", b",")

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.marks = dict(zip(self.MARKS, self.whole([m.decode() for m in self.MARKS])))
        self.forget()

    def forget(self) -> None:
        self.index, self.at, self.pool = HashIndex(), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def new(self, found: list[bytes]) -> list[list[int]]:
        """Ids of words.  Words of letters alone go many to a call, split again at the tokens that end
        a word; a mark behind a letter is a word of its own to the pattern."""
        cut = [w[-1:] in self.MARKS and w[-2:-1].isalpha() for w in found]
        stems = [(w[:-1] if c else w).decode() for w, c in zip(found, cut)]
        plain = [i for i, w in enumerate(stems) if w.isalpha()]
        out: list[list[int] | None] = [None] * len(stems)
        groups = [plain[i:i + self.TOGETHER] for i in range(0, len(plain), self.TOGETHER)]
        for group, ids in zip(groups, self.whole([" ".join(stems[i] for i in g) for g in groups])):
            ends = (np.flatnonzero(self.last[ids]) + 1).tolist()
            if len(ends) == len(group) and ends[-1] == len(ids):
                for i, a, b in zip(group, [0, *ends], ends):
                    out[i] = ids[a:b]
        rest = [i for i, o in enumerate(out) if o is None]
        for i, ids in zip(rest, self.whole([stems[i] for i in rest])):
            out[i] = ids
        return [o + self.marks[w[-1:]] if c else o for o, w, c in zip(out, found, cut)]

    def encode(self, column: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column and their offsets; ``end`` is put behind each text."""
        if self.index.count > self.KEPT:
            self.forget()
        w = words(column)
        slots = self.index.find(w.hashes)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            fresh, first = np.unique(w.hashes[missing], return_index=True)
            body, first = w.data.tobytes().lower(), missing[first]
            ids = self.new([body[a:b] for a, b in zip(w.starts[first].tolist(), w.ends[first].tolist())])
            self.index.add(fresh)
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum([len(i) for i in ids])])
            self.pool = np.concatenate([self.pool, np.array([x for i in ids for x in i], np.int32)])
            slots[missing] = self.index.find(w.hashes[missing])
        text = np.repeat(np.arange(len(w)), np.diff(w.offsets))
        start = self.at[slots]
        size = self.at[slots + 1] - start
        ends = np.cumsum(size)
        flat = self.pool[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)]
        counts = np.bincount(text, weights=size, minlength=len(w)).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(counts)])
        special = set(np.flatnonzero(pc.fill_null(pc.match_substring(column, "<|"), False).to_numpy(zero_copy_only=False)).tolist())
        parts = []
        for t in range(len(w)):
            parts.append(flat[at[t]:at[t + 1]])
            if t in special:
                parts[-1] = np.array(self.whole([column[t].as_py()])[0], np.int32)
            if end is not None:
                parts[-1] = np.append(parts[-1], np.int32(end))
        return np.concatenate(parts).astype(np.int32) if parts else flat, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


_encoders: dict[str, WordEncoder] = {}


def _encoder(source: Source) -> WordEncoder:
    """One per Python worker and tokenizer."""
    if source.id not in _encoders:
        _encoders[source.id] = WordEncoder(source.value)
    return _encoders[source.id]


def encode_words(docs: DataFrame, path: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", kind: str = "<u2") -> DataFrame:
    """(id, ids binary) of every row: its whole text under a lower-casing word tokenizer, and
    ``end_id`` behind it, packed as numpy type ``kind``.  Null texts count as empty."""
    source = Source(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source)
        for batch in batches:
            for part in pieces(batch, "text"):
                flat, at = encoder.encode(part.column("text"), end_id)
                if len(flat) and flat.max() > np.iinfo(kind).max:
                    raise ValueError(f"id {flat.max()} does not fit {kind}")
                body = flat.astype(kind).tobytes()
                step = np.dtype(kind).itemsize
                ids = pa.array([body[a:b] for a, b in zip((at[:-1] * step).tolist(), (at[1:] * step).tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("id"), ids], names=["id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return in_arrow(rows, run, "id long, ids binary").withColumnRenamed("id", id_col)


def packed(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column without nulls, and the offsets of its rows."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if len(column) and body is not None else np.zeros(0, np.uint8)
    return data.view(kind), ((offsets - offsets[0]) // np.dtype(kind).itemsize if len(column) else np.zeros(1, np.int64))


def write_token_files(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", kind: str = "<u2") -> None:
    """Write ``tokens`` (ids packed as numpy type ``kind``) under ``path`` in ascending order of id (nulls first; rows of one
    id in order of a hash of their ids, then of the ids).  Null ids lists count as empty."""
    spark = tokens.sparkSession
    rows = tokens.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            n = np.bincount(packed(batch.column("ids"), kind)[0])
            total = np.pad(total, (0, max(0, len(n) - len(total))))
            total[:len(n)] += n
        token = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(total[token])], names=["token", "n"])

    counts = in_arrow(rows.select("ids"), count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()  # one row per id of the vocabulary
    counts = counts.sort_values(["n", "token"], ascending=[False, True])
    ids = counts["token"].to_numpy(np.int64)
    spark.createDataFrame([(int(t), r) for r, t in enumerate(ids.tolist())], "id int, rank int").coalesce(1).write.parquet(f"{path}/ranks")
    table = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    table[ids] = np.arange(len(ids), dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            flat, at = packed(batch.column("ids"), kind)
            group = at[1:] // BLOCK_IDS
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(batch)]
            for a, b in zip(edges, edges[1:]):
                if b > a:
                    ids = flat[at[a]:at[b]]
                    control, data = pack(ranks.value[ids])
                    some = batch.column("id").slice(a, b - a)
                    parts = [struct.pack(HEAD, MAGIC, partition, before, b - a, len(ids), len(data)), some.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                             some.fill_null(0).to_numpy().astype("<i8").tobytes(), np.diff(at[a:b + 1]).astype("<u4").tobytes(), control, data]
                    before += len(ids)
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["block"])

    order = ["id", F.xxhash64("ids")]
    blocks = in_arrow(rows.repartitionByRange(*order).sortWithinPartitions(*order, "ids"), run, "block binary")
    blocks.select(F.col("block").cast("string")).write.option("maxRecordsPerFile", BLOCKS_PER_FILE).option("lineSep", "\n").text(f"{path}/ids")


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(id, part, before, n_tokens, ids) of every document in the files: its ids, and how many ids of
    partition ``part`` come before it.  With ``digest`` the column ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers) stands in place of ids."""
    table = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()["id"].to_numpy(np.uint32)  # one row per id of the vocabulary
    ids_of = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                view, at = memoryview(content.as_buffer()), 0
                while at < len(view):
                    magic, part, before, docs, n, size = struct.unpack_from(HEAD, view, at)
                    if magic != MAGIC:
                        raise ValueError("no block where one should start")
                    at += struct.calcsize(HEAD)
                    field = lambda kind, count: np.frombuffer(view, kind, count, at)
                    null = field(np.uint8, docs)
                    at += docs
                    ids = field("<i8", docs)
                    at += 8 * docs
                    length = field("<u4", docs).astype(np.int64)
                    at += 4 * docs
                    control = field(np.uint8, -(-n // 4))
                    at += len(control)
                    tokens = ids_of.value[unpack(control, field(np.uint8, size), n)] if n else np.zeros(0, np.uint32)
                    at += size + 1
                    ends = np.cumsum(length)
                    if digest:
                        raw = memoryview(np.ascontiguousarray(tokens, "<u4")).cast("B")
                        last = pa.array([zlib.crc32(raw[4 * (e - m):4 * e]) for e, m in zip(ends.tolist(), length.tolist())], pa.int64())
                    else:
                        last = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(tokens.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([pa.array(ids, mask=null.astype(bool)), pa.array(np.full(docs, part, np.int64)), pa.array(before + ends - length),
                                                      pa.array(length), last], names=["id", "part", "before", "n_tokens", "ids_crc32" if digest else "ids"])

    files = spark.read.format("binaryFile").load(f"{path}/ids").select("content")
    return in_arrow(files, run, "id long, part long, before long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>"))


def starts(read: DataFrame) -> DataFrame:
    """``read`` with ``start``, the number of ids of all documents before; only partitions' totals meet in one place."""
    totals = read.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(earlier, F.lit(0)).alias("base"))
    return read.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("before"))


def token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode ``docs``, write their files under ``path`` and read them back:
    (id, start, n_tokens, ids_crc32) of every document.

    Null texts are empty and have the end id alone; null ids come first; an
    empty table gives no rows."""
    tokens = landed(encode_words(docs, tokenizer, end_id, id_col, text_col), "tokens")
    write_token_files(tokens, path, id_col)
    discard(tokens)
    read = landed(read_token_files(docs.sparkSession, path, digest=True), "read")
    return starts(read).select(F.col("id").alias(id_col), "start", "n_tokens", "ids_crc32")
