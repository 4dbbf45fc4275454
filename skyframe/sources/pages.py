"""Landed raw pages -> table rows -> comma-joined records.

Pages are read as a table (``url``, ``html``) — fetching is not part of the
engine.  Extraction is regex work on Spark's own string functions, one page
per row, so it spreads over all tasks with no Python in the loop:

1. ``decode_escaped`` undoes the JSON-style escapes of the payload
   (``\\uXXXX`` and ``<\\/td>``) by reading the text as a JSON string.
2. ``extract_rows`` cuts the table rows out (``regexp_extract_all``) and
   numbers them (``posexplode``); the header row is skipped.
3. ``row_record`` strips tags from each cell, splits cell text on blanks
   (a date cell holds date and weekday, an AQI cell value and class) and
   comma-joins the tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PAGES

ROW_RE = r"(?s)<tr[^>]*>(.*?)</tr>"
CELL_RE = r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed pages.  ``fmt='text'`` reads one page per file
    (``wholetext``), the file path standing in for the URL.  Spark reports
    paths URL-encoded, so they are decoded once."""
    if fmt == "text":
        name = F.input_file_name()
        return (spark.read.text(path, wholetext=True)
                .select(F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name).alias("url"), F.col("value").alias("html")))
    return spark.read.schema(PAGES).parquet(path) if fmt == "parquet-strict" else spark.read.parquet(path)


def decode_escaped(c: Column | str, field: str = "data") -> Column:
    """Undo the payload's JSON escapes (``\\uXXXX``, ``\\/``, ``\\"``).

    A JSON object is unwrapped to its ``field``; a bare escaped text is read
    as a JSON string; anything else (plain markup) is returned unchanged.
    """
    col = F.col(c) if isinstance(c, str) else c
    from_object = F.get_json_object(col, f"$.{field}")
    from_string = F.get_json_object(F.concat(F.lit('{"v":"'), col, F.lit('"}')), "$.v")
    return F.coalesce(from_object, from_string, col)


def extract_rows(pages: DataFrame, keys=("url",), html: str = "html", row_re: str = ROW_RE,
                 skip_header: bool = True, decode: bool = True) -> DataFrame:
    """S3: one output row per matched table row: keys, ``row_no`` (1-based
    among data rows), ``row_html``.  A page without rows yields nothing."""
    text = decode_escaped(html) if decode else F.col(html)
    rows = pages.select(*keys, F.posexplode(F.regexp_extract_all(text, F.lit(row_re), 1)).alias("pos", "row_html"))
    first = 1 if skip_header else 0
    return (rows.filter(F.col("pos") >= first)
                .select(*keys, (F.col("pos") - first + 1).cast("int").alias("row_no"), "row_html"))


def row_tokens(c: Column | str, cell_re: str = CELL_RE) -> Column:
    """Cell texts of a row, tags removed, split on blanks, blanks dropped."""
    col = F.col(c) if isinstance(c, str) else c
    cells = F.regexp_extract_all(col, F.lit(cell_re), 1)
    words = F.flatten(F.transform(cells, lambda x: F.split(
        F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", " "), r"\s+", " ")), " ")))
    return F.filter(words, lambda w: w != "")


def row_record(c: Column | str, cell_re: str = CELL_RE, sep: str = ",") -> Column:
    """The record string of a row: its tokens comma-joined."""
    return F.array_join(row_tokens(c, cell_re), sep)


def page_records(pages: DataFrame, keys=("url",), html: str = "html") -> DataFrame:
    """S1+S3: pages -> (keys, row_no, record)."""
    rows = extract_rows(pages, keys, html)
    return rows.select(*keys, "row_no", row_record("row_html").alias("record"))
