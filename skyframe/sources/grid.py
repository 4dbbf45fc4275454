"""The collection-target grid, areas x years x months, with the URL of
each target.  Built with generators (``explode(sequence)``) on the area
rows, not with a cross join; the URL is a ``concat`` of literal pieces and
columns, so no format string is involved."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed

_PH = re.compile(r"\{(\w+)\}")


def template_concat(template: str, values: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders of a template with column values."""
    parts, pos = [], 0
    for m in _PH.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(values[m.group(1)].cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def target_grid(areas: DataFrame, area_col: str = "area_id", first_year: int = fixed.FIRST_YEAR,
                last_year: int = fixed.LAST_YEAR, base: str = "http://weather.example/history",
                template: str = fixed.URL_TEMPLATE, months=fixed.MONTHS) -> DataFrame:
    """(area, year, month, url) for every area row, year in
    [first_year, last_year] and month in [months[0], months[1]]; the month is
    not zero padded in the URL."""
    g = (areas.select(F.col(area_col), F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("year"))
              .select(area_col, "year", F.explode(F.sequence(F.lit(months[0]), F.lit(months[1]))).alias("month")))
    url = template_concat(template, {"base": F.lit(base), "area": F.col(area_col),
                                     "year": F.col("year"), "month": F.col("month")})
    return g.withColumn("url", url)
