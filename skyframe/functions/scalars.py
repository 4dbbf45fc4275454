"""Column-level building blocks.  Every function returns a Column built from
Spark's own expressions, so it stays inside whole-stage codegen and can be
pushed down where Catalyst allows."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed

ColumnOrName = Column | str

_PERIOD = re.compile(r"[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?")
_DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_unit(c: ColumnOrName, unit: str = fixed.DEGREE) -> Column:
    """Remove every occurrence of ``unit`` from a text column."""
    return F.replace(_c(c), F.lit(unit), F.lit(""))


def strict_int(c: ColumnOrName, unit: str = fixed.DEGREE, on_null: str = "fail",
               name: str = "value") -> Column:
    """Unit strip + integer cast that fails the job on malformed text.

    Independent of the session's ANSI flag: ``try_cast`` gives NULL for
    bad text, which is turned into an error.  ``on_null='keep'`` lets a
    NULL input through as NULL; ``'fail'`` (the default) rejects it too.
    """
    raw = strip_unit(c, unit)
    cast = raw.try_cast("int")
    bad_text = raw.isNotNull() & cast.isNull()
    msg = F.concat(F.lit(f"strict_int: cannot cast {name} '"), F.coalesce(raw, F.lit("NULL")), F.lit("' to INT"))
    cond = bad_text | raw.isNull() if on_null == "fail" else bad_text
    return F.when(cond, F.raise_error(msg).cast("int")).otherwise(cast)


def lenient_double(c: ColumnOrName) -> Column:
    """Plain decimal text to double (blanks around it allowed); any other text
    ('-', '', '42d', '0x1p3') and NaN become NULL."""
    text = _c(c).cast("string")
    return F.when(text.rlike(_DECIMAL), F.trim(F.regexp_replace(text, r"\s", "")).try_cast("double"))


def month_day(c: ColumnOrName = "year_mon_day") -> Column:
    """Calendar-day key 'MM-DD' of an ISO date text."""
    return F.substring(_c(c), 6, 5)


def mean_temp(max_t: ColumnOrName = "max_t", min_t: ColumnOrName = "min_t") -> Column:
    """Row mean temperature (max + min) / 2 as double."""
    return (_c(max_t).cast("double") + _c(min_t).cast("double")) / F.lit(2.0)


def band(c: ColumnOrName, bounds=fixed.AQI_BOUNDS, labels=fixed.AQI_CLASSES) -> Column:
    """Label by inclusive upper bounds; above the last bound the last label;
    NULL stays NULL.  ``len(labels) == len(bounds) + 1``."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("band: need one label more than bounds")
    v = _c(c)
    expr = F.when(v.isNull(), F.lit(None).cast("string"))
    for b, lab in zip(bounds, labels):
        expr = expr.when(v <= F.lit(b), F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def pieces(c: ColumnOrName, spec=fixed.MAP_PIECES) -> Column:
    """Label of the first closed interval [lo, hi] holding the value; NULL
    when none does (gaps between pieces stay unlabelled)."""
    v = _c(c)
    expr = None
    for lo, hi, lab in spec:
        cond = v.between(F.lit(lo), F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(None).cast("string"))


def domain_ordinal(c: ColumnOrName, domain) -> Column:
    """1-based position of the value in a fixed domain (first occurrence);
    NULL when unknown."""
    arr = F.array(*[F.lit(x) for x in domain])
    pos = F.array_position(arr, _c(c))
    return F.when(pos > 0, pos.cast("int"))


def leading_token(c: ColumnOrName, domain=None) -> Column:
    """Leading word of a text.

    With a domain: the longest domain entry the text starts with, falling
    back to the leading run of non-space, non-digit characters.  Without a
    domain: the leading run of non-space characters.
    """
    v = _c(c)
    generic = F.regexp_extract(v, r"^\s*([^\s]+)", 1)
    if not domain:
        return F.when(v.isNotNull(), generic)
    alts = "|".join(re.escape(d) for d in sorted(set(domain), key=lambda s: (-len(s), s)))
    hit = F.regexp_extract(v, f"^\\s*({alts})", 1)
    fallback = F.regexp_extract(v, r"^\s*([^\s\d]+)", 1)
    return F.when(v.isNotNull(), F.when(hit != "", hit).otherwise(fallback))


def url_param(c: ColumnOrName, name: str, width: int | None = None) -> Column:
    """Value of a query-string parameter (NULL when absent).  With
    ``width``, exactly that many characters after ``name=`` are taken."""
    pat = (f"[?&]{re.escape(name)}=(.{{{width}}})" if width
           else f"[?&]{re.escape(name)}=([^&#]*)")
    v = F.regexp_extract(_c(c), pat, 1)
    return F.when(v != "", v)


def place_name(place: str, suffix: str = fixed.PLACE_SUFFIX) -> str:
    """Stored district of a display place name ('朝阳区' -> '朝阳')."""
    return place.replace(suffix, "") if suffix else place


def check_period(period: str | None) -> str:
    """Validate a period text: '', 'YYYY', 'YYYY-MM' or 'YYYY-MM-DD'."""
    p = period or ""
    if p and not _PERIOD.fullmatch(p):
        raise ValueError(f"period must be '', YYYY, YYYY-MM or YYYY-MM-DD, got {period!r}")
    return p


def period_grain(period: str | None) -> str:
    """'all', 'year', 'month' or 'day' for a valid period text."""
    p = check_period(period)
    return {0: "all", 4: "year", 7: "month", 10: "day"}[len(p)]


def period_predicate(period: str | None, c: ColumnOrName = "year_mon_day") -> Column:
    """Prefix predicate on the ISO date text.  ``startswith`` is pushed to the
    Parquet reader as ``StringStartsWith``; an empty period keeps all rows."""
    p = check_period(period)
    if not p:
        return F.lit(True)
    return _c(c).startswith(p)


def sanitize_text(c: ColumnOrName, chars: str = "\n\r\x01") -> Column:
    """Drop the characters that would break delimited-text staging."""
    cls = "".join({"\n": "\\n", "\r": "\\r", "\x01": "\\x01"}.get(ch, re.escape(ch)) for ch in chars)
    return F.regexp_replace(_c(c), f"[{cls}]", "")
