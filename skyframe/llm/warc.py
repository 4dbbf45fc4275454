"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Written archives hold one gzip member per record.  Spark's text sink writes
them, so any file system that Spark writes to will do; each member ends in a
zero byte, which the sink writes as the line separator.

The reader takes files of members, of one member, or without compression, and
files that mix them.  It checks every member and record; where a check fails
it looks for the next place at which a valid member or a version line starts,
goes on from there, and reports the bytes left out as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import in_arrow, landed

LEAST_SHARED = 100
RECORDS_PER_FILE = 20_000
EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
STEP = 1 << 20


# ------------------------------------------------------------------ writing

def resolve(pages: DataFrame, id_col: str = "page_id", body_col: str = "html", url_col: str | None = "url") -> DataFrame:
    """(id, url, body, payload_bytes, payload_digest, refers_to) of every row of ``pages``.

    Of rows with equal bodies of LEAST_SHARED bytes or more, those of the least
    id stand for themselves and the others refer to it; rows with a null id are
    referred to by none.  A null body is empty."""
    url = F.col(url_col) if url_col else F.lit(None)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), url.cast("string").alias("url"), F.coalesce(F.col(body_col), F.lit("")).cast("binary").alias("body"))
    rows = rows.withColumn("payload_bytes", F.octet_length("body").cast("long")).withColumn("payload_digest", F.sha2("body", 256))
    shared = (rows.filter(F.col("payload_bytes") >= LEAST_SHARED).groupBy("payload_digest")
              .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("payload_digest", "least"))
    # landed, so that the join stands right on two exchanges and a digest of very many rows can be split
    out = rows.join(landed(shared, "shared"), "payload_digest", "left")
    return out.withColumn("refers_to", F.when(~F.col("id").eqNullSafe(F.col("least")), F.col("least"))).drop("least")


def record(page_id, url, body: bytes, size: int, digest: str, refers_to) -> bytes:
    """One WARC record: a response, or a revisit without its body."""
    name = "null" if page_id is None else str(page_id)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
             f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}", "Content-Type: text/html; charset=utf-8"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        body = b""
    lines += [f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    """A gzip member of ``raw`` without its last byte, a zero; an empty member behind it brings one where needed."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = squeeze.compress(raw) + squeeze.flush()
    return (out if out[-1] == 0 else out + EMPTY_MEMBER)[:-1]


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", body_col: str = "html", url_col: str | None = "url") -> None:
    """Write a WARC record for every row of ``pages`` to files under ``path``; see ``resolve`` for revisits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 64):
                few = batch.slice(i, 64)
                out = [member(record(*row)) for row in zip(*(few.column(c).to_pylist() for c in ("id", "url", "body", "payload_bytes", "payload_digest", "refers_to")))]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    rows = resolve(pages, id_col, body_col, url_col).select("id", "url", "body", "payload_bytes", "payload_digest", "refers_to")
    out = in_arrow(rows, run, "record binary").select(F.col("record").cast("string"))
    out.write.option("lineSep", "\0").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


# ------------------------------------------------------------------ reading

class Damage(Exception):
    """A record or member that fails its checks."""


def starts(data: memoryview, mark: bytes, at: int) -> bool:
    """Whether ``mark`` stands at ``at``."""
    return bytes(data[at:at + len(mark)]) == mark


def seek(data: memoryview, mark: bytes, at: int) -> int:
    """The first place of ``mark`` from ``at`` on, or -1; looks at a piece at a time, so that nothing large is copied."""
    size = 1 << 12
    while at < len(data):
        place = bytes(data[at:at + size + len(mark) - 1]).find(mark)
        if place >= 0:
            return at + place
        at, size = at + size, min(2 * size, STEP)
    return -1


def parse_head(data: memoryview, at: int) -> tuple[str, dict[str, str], int]:
    """Version, fields (lower-case names) and body place of the record head at ``at``, of any length."""
    end = seek(data, b"\r\n\r\n", at) if starts(data, VERSION, at) else -1
    if end < 0:
        raise Damage("no record head")
    first, *lines = bytes(data[at:end]).decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damage("a head line without a colon")
        fields[name.strip().lower()] = value.strip()
    return first, fields, end + 4


def parse_record(data: memoryview, at: int) -> tuple[dict[str, str], bytes, int]:
    """Fields, body and end of the record at ``at``; raises Damage where a check fails."""
    _, fields, body = parse_head(data, at)
    length = fields.get("content-length", "")
    if "warc-type" not in fields or "warc-record-id" not in fields:
        raise Damage("a field is missing that every record has")
    if not (length.isascii() and length.isdigit()):
        raise Damage("no content length")
    end = body + int(length)
    if not starts(data, b"\r\n\r\n", end):
        raise Damage("the record does not end where it says")
    payload = bytes(data[body:end])
    kind, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if kind.lower() == "sha256" and fields.get("warc-type", "").lower() != "revisit" and hashlib.sha256(payload).hexdigest() != digest.lower():
        raise Damage("the payload has another digest")
    return fields, payload, end + 4


def records_of(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes]]:
    """(start, end, fields, body) of the records in plain bytes; fields is None for a gap."""
    data, at = memoryview(data), 0
    while at < len(data):
        try:
            fields, body, end = parse_record(data, at)
            yield at, end, fields, body
            at = end
        except Damage:
            following = seek(data, b"\r\n" + VERSION, at)
            end = len(data) if following < 0 else following + 2
            yield at, end, None, b""
            at = end


def inflate(data: memoryview, at: int) -> tuple[bytes, int, str | None]:
    """Content and end of the gzip member at ``at``, and None; of one that is not whole the content before
    the broken place, its end in the file, and what is wrong."""
    stream, out, place = zlib.decompressobj(31), [], at
    while not stream.eof:
        if place >= len(data):
            return b"".join(out), len(data), "the member is cut off"
        kept = stream.copy()
        try:
            out.append(stream.decompress(data[place:place + STEP]))
        except zlib.error as e:
            return b"".join([*out, *_before_error(kept, data[place:place + STEP])]), place, str(e)
        place += STEP
    return b"".join(out), min(place, len(data)) - len(stream.unused_data), None


def _before_error(stream, data: memoryview) -> Iterator[bytes]:
    """What the stream makes of ``data`` up to the place where it fails."""
    while len(data) > 1:
        kept, half = stream.copy(), len(data) // 2
        try:
            yield stream.decompress(data[:half])
            data = data[half:]
        except zlib.error:
            stream, data = kept, data[:half]
    try:
        while True:
            some = stream.decompress(data, 1)
            data = stream.unconsumed_tail
            yield some
            if not some and not data:
                return
    except zlib.error:
        return


def deflated(data: memoryview, at: int, size: int) -> int:
    """The place in the file up to which the member at ``at`` must be read for its first ``size`` bytes of content,
    but the last, behind which the decoder may read on at once."""
    stream, place, size = zlib.decompressobj(31), at, size - 1
    while size:
        some = data[place:place + STEP]
        made = stream.decompress(some, size)
        size, place = size - len(made), place + len(some) - len(stream.unconsumed_tail)
    return place


def salvaged(data: memoryview, at: int, content: bytes, wrong: str) -> tuple[list, int]:
    """The records in the content of a member that is not whole, in order, and the end of the last in the file.

    They are the whole records before the broken place.  Where only the member's check fails, the broken
    place is not known, and records must have a digest of their payload that holds."""
    found, last = [], 0
    for _, end, fields, body in records_of(content):
        if fields is not None and wrong.endswith(("incorrect data check", "incorrect length check")):
            kind, _, _ = fields.get("warc-payload-digest", "").partition(":")
            fields = fields if kind.lower() == "sha256" and fields.get("warc-type", "").lower() != "revisit" else None
        found.append((end, fields, body if fields is not None else b""))
        last = end if fields is not None else last
    if not last:
        raise Damage(wrong)
    place = deflated(data, at, last)
    return [(at, place, fields, body) for end, fields, body in found if end <= last], place


def salvage(data: memoryview | bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes]]:
    """(start, end, fields, body) of every record of a file, in order, with places in the file (those of
    its member for a compressed one); fields is None for bytes in quarantine.  Of a member that is not
    whole, records before the broken place are kept."""
    data, at, bad, broken = memoryview(data), 0, None, None
    following = {MAGIC: -1, VERSION: -1}

    def gap(end: int):
        return [(bad, end, None, b"")] if bad is not None and end > bad else []

    while at < len(data):
        if data[at] == 0 and bad is None:  # padding between members
            at += 1
            continue
        try:
            if starts(data, MAGIC, at):
                content, end, wrong = inflate(data, at)
                if wrong is None:
                    found = [(at, end, fields, body) for _, _, fields, body in records_of(content)]
                else:
                    found, end = salvaged(data, at, content, wrong)
                    broken = end
            elif starts(data, VERSION, at):
                fields, body, end = parse_record(data, at)
                found = [(at, end, fields, body)]
            else:
                raise Damage("neither a member nor a record starts here")
        except Damage:
            if bad is None:
                bad = at
            for mark, place in following.items():  # found places serve until they are passed
                if place <= at:
                    found_at = seek(data, mark, at + 1)
                    following[mark] = len(data) if found_at < 0 else found_at
            at = min(following.values())
            continue
        yield from gap(at)
        bad, broken = broken, None
        yield from found
        at = end
    yield from gap(len(data))


def read_archives(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """Every record and every quarantined gap of the files under ``path``.

    (file, start, end, quarantined, record_id, record_type, refers_to, url,
    payload_bytes, payload_digest, body).  ``start`` and ``end`` are places in the
    file.  Rows with ``quarantined`` true are gaps and have nulls else.  Bytes and
    digest are the head's where it has them, else the body's own; ``body`` is null
    unless ``bodies``.  Files are read whole, so an archive may have up to 2 GB."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows, held = [], 0
                for start, end, fields, body in salvage(memoryview(content.as_buffer())):
                    row = {"file": file, "start": start, "end": end, "quarantined": fields is None}
                    if fields is not None:
                        kind, _, digest = fields.get("warc-payload-digest", "").partition(":")
                        size = fields.get("warc-payload-length", "")
                        row |= {"record_id": fields.get("warc-record-id"), "record_type": fields.get("warc-type"), "refers_to": fields.get("warc-refers-to"),
                                "url": fields.get("warc-target-uri"), "payload_bytes": int(size) if size.isdigit() else len(body),
                                "payload_digest": digest if kind.lower() == "sha256" else hashlib.sha256(body).hexdigest(), "body": body if bodies else None}
                    rows.append(row)
                    held += len(body) if bodies else 200
                    if held > STEP:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return in_arrow(files, run, "file string, start long, `end` long, quarantined boolean, record_id string, record_type string, refers_to string, "
                    "url string, payload_bytes long, payload_digest string, body binary")


RECORDS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("quarantined", pa.bool_()), ("record_id", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("body", pa.binary())])


def page_of(name: str):
    """The id in a record name that this module wrote; null for others."""
    return F.regexp_extract(name, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
