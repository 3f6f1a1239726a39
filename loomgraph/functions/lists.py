"""Canonical forms of lists of strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def list_form(titles: Column | str) -> Column:
    """A string that two lists share iff they are equal apart from order,
    repetition, letter case, outer spaces and the number of inner spaces.

    Null equals the empty list; null members are left out. Members are joined by
    U+0001 behind their own lengths, so no two different lists share a form.
    """
    col = F.col(titles) if isinstance(titles, str) else titles
    norm = F.transform(F.filter(col, lambda x: x.isNotNull()), lambda x: F.trim(F.regexp_replace(F.lower(x), " +", " ")))
    tagged = F.transform(F.array_sort(F.array_distinct(norm)), lambda x: F.concat(F.length(x).cast("string"), F.lit(":"), x))
    return F.coalesce(F.array_join(tagged, "\u0001"), F.lit(""))
