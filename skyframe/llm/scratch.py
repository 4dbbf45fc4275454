"""What every operator needs of the cluster: shared intermediate tables, and this package on the workers.

A written table cuts lineage: a lost executor re-reads it instead of running
what came before it again.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

#: Shuffle files of a query are deleted when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_shipped: set[str] = set()
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to a fresh shared path and read back; the shuffle files of the write do not stay."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete landed tables whose readers have all run: nothing that is still to run may depend on them."""
    for table in tables:
        jvm, sc = table.sparkSession._jvm, table.sparkSession.sparkContext
        place = jvm.org.apache.hadoop.fs.Path(_paths.pop(table))
        place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that tasks can
    import it wherever the driver was started from."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(prefix="skyframe-code-"), "skyframe_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), top))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def in_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` of a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
