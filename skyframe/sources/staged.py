"""Delimited-text staging (the ODS landing format).

String fields are sanitised (``\\n``, ``\\r``, ``\\x01`` removed) so a record
is one line; the field separator may be several characters (default
``^WEA``).  NULL is staged as ``\\N`` (Hive's null marker), so NULL and the
empty string both survive the round trip; ``null=''`` reproduces a staging
where the two collapse into the empty value (read back as NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import sanitize_text

SEP = "^WEA"
NULL = "\\N"


def sanitize_strings(df: DataFrame) -> DataFrame:
    """Drop line breaks and ``\\x01`` from every string column."""
    cols = {f.name: sanitize_text(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(cols) if cols else df


def _opts(sep: str, null: str) -> dict:
    return {"sep": sep, "nullValue": null, "quote": '"', "escape": '"', "header": "false",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _marked(df: DataFrame, null: str, undo: bool = False, only: list[str] | None = None) -> DataFrame:
    """Texts (of the columns ``only``) that begin with the null marker get one more before
    them, so that only NULL itself is staged as the bare marker; ``undo`` takes it off."""
    if not null:
        return df
    cols = {f.name: F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (only is None or f.name in only)}
    if undo:
        cols = {n: F.when(c.startswith(null + null), F.substring(c, F.lit(len(null) + 1), F.length(c))).otherwise(c) for n, c in cols.items()}
    else:
        cols = {n: F.when(c.startswith(null), F.concat(F.lit(null), c)).otherwise(c) for n, c in cols.items()}
    return df.withColumns(cols) if cols else df


def stage_text(df: DataFrame, path: str, sep: str = SEP, null: str = NULL, mode: str = "overwrite") -> str:
    """Write sanitised rows as delimited text.  A lone column is quoted, as
    readers take a blank line for no row."""
    out = _marked(sanitize_strings(df), null).write.mode(mode).options(**_opts(sep, null))
    out.option("quoteAll", str(len(df.columns) == 1).lower()).csv(path)
    return path


def read_staged(spark: SparkSession, path: str, schema: T.StructType, sep: str = SEP, null: str = NULL) -> DataFrame:
    """Read staged text back with a declared schema (no inference)."""
    return _marked(spark.read.schema(schema).options(**_opts(sep, null)).option("mode", "FAILFAST").csv(path), null, undo=True)
