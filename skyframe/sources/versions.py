"""Tables that are published whole.

A refresh that deletes and then writes leaves no table when it fails in
between, and shows readers half of one.  Here every refresh writes a data folder
of its own, which is never changed again, and then commits a manifest that
names it:

    base/data/<folder>/...            rows, as Parquet, maybe partitioned
    base/manifest/<version>.json      one small file per version

The manifest is written under another name and renamed to the next version's;
the rename fails if the version exists, so of two writers one takes the next
number.  A version is there with all of its rows or not at all; a reader takes
the folder of one version and keeps it, whatever is published later.  Going
back commits a new version that names an old folder.

The driver reads and writes manifests only; rows are written and counted by
one Spark job.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from .snapshot import _measures, fingerprint, restore


def _hadoop(spark: SparkSession, path: str):
    """(file system, path object) of a path, by Spark's own configuration."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _hadoop(spark, path)
    return fs.exists(place)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it is missing."""
    fs, place = _hadoop(spark, path)
    if not fs.exists(place):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(place))


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _hadoop(spark, path)
    fs.delete(place, True)


def commit_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` in one step; False if it exists already."""
    jvm = spark._jvm
    folder, name = path.rsplit("/", 1)
    fs, draft = _hadoop(spark, f"{folder}/.{name}-{uuid.uuid4().hex[:12]}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else fs.getUri(), conf)
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), spark.sparkContext._gateway.new_array(kind, 0))
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    return True


def read_file(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, place = _hadoop(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions, oldest first."""
    return sorted(int(n[:-5]) for n in list_names(spark, f"{base}/manifest") if n.endswith(".json") and not n.startswith("."))


def manifest(spark: SparkSession, base: str, version: int | None = None) -> dict:
    """What a version holds (the latest by default)."""
    known = versions(spark, base)
    if not known or version is not None and version not in known:
        raise LookupError(f"no version {'' if version is None else version} at {base}")
    return json.loads(read_file(spark, f"{base}/manifest/{known[-1] if version is None else version:020d}.json"))


class Conflict(RuntimeError):
    """Another writer committed the version that this one was to become."""


def commit(spark: SparkSession, base: str, content: dict, expect: int | None = None) -> int:
    """Commit ``content`` as the next version.  With ``expect`` it must follow that version (0: be the first),
    else ``Conflict``; without, it takes the next number that is free."""
    while True:
        known = versions(spark, base)
        last = known[-1] if known else 0
        if expect is not None and last != expect:
            raise Conflict(f"{base} is at version {last}, not {expect}")
        number = last + 1
        text = json.dumps({"version": number, "previous": last, **content}, sort_keys=True)
        if commit_file(spark, f"{base}/manifest/{number:020d}.json", text):
            return number


def write_folder(df: DataFrame, base: str, partition_by=(), sort_within=()) -> dict:
    """Write rows to a data folder of their own; returns what a manifest says of it: folder, rows,
    checksum of the rows (observed while they are written), schema and layout.

    With ``partition_by`` or ``sort_within`` tasks write contiguous ranges of (partition, sort columns), so a large
    partition value is split over tasks."""
    folder = f"data/{uuid.uuid4().hex[:16]}"
    seen = Observation()
    keys = [*partition_by, *sort_within]
    laid = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
    out = laid.observe(seen, *_measures(df)).write.mode("error")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(f"{base}/{folder}")
    return {"folder": folder, "n_rows": seen.get["n_rows"], "checksum": seen.get["checksum"], "schema": df.schema.jsonValue(), "partition_by": list(partition_by)}


def publish(df: DataFrame, base: str, partition_by=(), sort_within=(), expect: int | None = None) -> int:
    """Full refresh: the rows of ``df`` become the next version of the table at ``base``; its number.

    If the write fails, no version is committed and readers go on with the last one; the rows written so
    far stay in a folder that no manifest names, until ``expire``."""
    return commit(df.sparkSession, base, write_folder(df, base, partition_by, sort_within), expect)


def read_version(spark: SparkSession, base: str, version: int | None = None, verify: bool = False) -> DataFrame:
    """The rows of a version (the latest by default).  The frame stays with its version's folder when later
    versions are published.  With ``verify``, rows are counted and hashed against the manifest first."""
    about = manifest(spark, base, version)
    schema = T.StructType.fromJson(about["schema"])
    rows = spark.read.schema(schema).parquet(f"{base}/{about['folder']}").select(*schema.fieldNames())
    if verify:
        got = fingerprint(rows).first()
        if (got["n_rows"], got["checksum"]) != (about["n_rows"], about["checksum"]):
            raise ValueError(f"version {about['version']} at {base} does not match its manifest")
    return rows


def rollback(spark: SparkSession, base: str, version: int) -> int:
    """Publish an old version's rows again, without copying them; the new version's number."""
    about = manifest(spark, base, version)
    return commit(spark, base, {**{k: v for k, v in about.items() if k not in ("version", "previous")}, "rollback_to": version})


def history(spark: SparkSession, base: str) -> DataFrame:
    """(version, previous, rollback_to, n_rows, checksum) of all versions."""
    kept = [manifest(spark, base, v) for v in versions(spark, base)]
    rows = [(m["version"], m["previous"], m.get("rollback_to"), m["n_rows"], m["checksum"]) for m in kept]
    return spark.createDataFrame(rows, "version long, previous long, rollback_to long, n_rows long, checksum string")


def expire(spark: SparkSession, base: str, keep: int = 2, unnamed_after_s: float = 86_400) -> list[str]:
    """Forget all but the ``keep`` latest versions, and delete the data folders that no version left names.

    Folders of forgotten versions go at once: readers pinned to them must be done.  Other folders that no
    manifest names may belong to a write that still runs, so they go only when they have not changed for
    ``unnamed_after_s`` seconds.  Returns the deleted folders."""
    if keep < 1:
        raise ValueError("the latest version stays")
    known = versions(spark, base)
    named = {v: set(folders_of(manifest(spark, base, v))) for v in known}
    left = set().union(*[named[v] for v in known[-keep:]]) if known else set()
    gone = set().union(*named.values()) - left if known else set()
    for v in known[:-keep]:
        delete(spark, f"{base}/manifest/{v:020d}.json")
    deleted = []
    for name in list_names(spark, f"{base}/data"):
        folder = f"data/{name}"
        fs, place = _hadoop(spark, f"{base}/{folder}")
        old = time.time() - fs.getFileStatus(place).getModificationTime() / 1000 >= unnamed_after_s
        if folder not in left and (folder in gone or old):
            fs.delete(place, True)
            deleted.append(folder)
    return deleted


def folders_of(content: dict) -> list[str]:
    """Data folders that a manifest names, wherever it names them."""
    found = [v for k, v in content.items() if k == "folder"]
    for v in content.values():
        parts = v if isinstance(v, list) else [v]
        found += [f for p in parts if isinstance(p, dict) and "folder" in p for f in [p["folder"]]]
    return found


def restore_into(spark: SparkSession, snapshot: str, base: str, partition_by=(), sort_within=()) -> int:
    """A verified snapshot becomes the next version of the table at ``base``."""
    return publish(restore(spark, snapshot, verify=True), base, partition_by, sort_within)
