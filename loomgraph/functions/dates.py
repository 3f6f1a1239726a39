"""Partial dates (YYYY, YYYY-MM, YYYY-MM-DD) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions.text import MONTHS

SHAPE = r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$"


def is_partial_date(c: Column) -> Column:
    return c.rlike(SHAPE)


def year(c: Column) -> Column:
    return F.when(is_partial_date(c), F.substring(c, 1, 4).cast("int"))


def periods_conflict(a_from: Column, a_until: Column, b_from: Column, b_until: Column) -> Column:
    """Disjoint by years; a period with one end only is that year on, and open ends never conflict."""
    lo = lambda start, end: F.coalesce(year(start), year(end))
    apart = lambda end, start: F.coalesce(year(end) < start, F.lit(False))
    return apart(a_until, lo(b_from, b_until)) | apart(b_until, lo(a_from, a_until))


def partial_date(y: Column, m: Column | None = None, d: Column | None = None) -> Column:
    """YYYY, YYYY-MM or YYYY-MM-DD from numbers in text; null parts end it."""
    pad = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    out = F.nullif(y, F.lit(""))
    month, day = F.nullif(m, F.lit("")) if m is not None else F.lit(None), F.nullif(d, F.lit("")) if d is not None else F.lit(None)
    return F.when(month.isNull(), out).when(day.isNull(), F.concat(out, F.lit("-"), pad(month))).otherwise(F.concat(out, F.lit("-"), pad(month), F.lit("-"), pad(day)))


_NUMERIC = r"(\d{4})(?:\.\s?(\d{1,2}))?(?:\.\s?(\d{1,2}))?\.?"
_SPAN = rf"{_NUMERIC}\s*[-–—]\s*(?:{_NUMERIC})?"
_NAMED = r"(\d{4})\.?\s+(" + "|".join(sorted(MONTHS, key=len, reverse=True)) + r")[a-záéíóöőúüű.]*(?:\s+(\d{1,2})\.?)?"
_NAMED_SPAN = rf"(?iu){_NAMED}\s*[-–—]\s*(?:{_NAMED})?"


def parse_period(c: Column) -> Column:
    """struct(from, until) of a stated period: numbers first, then month names; null ends where nothing is stated.

    Nothing is guessed: a text without a span gives two nulls."""
    g = lambda rule, k: F.nullif(F.regexp_extract(c, rule, k), F.lit(""))
    months = F.create_map(*[x for k, v in MONTHS.items() for x in (F.lit(k), F.lit(str(v)))])
    named = lambda k: F.try_element_at(months, F.lower(g(_NAMED_SPAN, k)))
    numeric, worded = c.rlike(_SPAN), c.rlike(_NAMED_SPAN)
    start = F.when(numeric, partial_date(g(_SPAN, 1), g(_SPAN, 2), g(_SPAN, 3))).when(worded, partial_date(g(_NAMED_SPAN, 1), named(2), g(_NAMED_SPAN, 3)))
    end = F.when(numeric, partial_date(g(_SPAN, 4), g(_SPAN, 5), g(_SPAN, 6))).when(worded, partial_date(g(_NAMED_SPAN, 4), named(5), g(_NAMED_SPAN, 6)))
    return F.struct(start.alias("from"), end.alias("until"))
