"""Consolidating pairwise matches into groups.

Minimum labels spread across the confirmed pairs, accelerated by pointer
jumping, each round cut, until no label changes (``operators/components.py``).
References are numbered in their own order first, so the least number is the
smallest reference. No step gathers a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.components import labelled
from loomgraph.operators.skew import ROWS_LIMIT
from loomgraph.session import cut

CONFIRMED = "confirmed_match"


def confirmed_pairs(matches: DataFrame, left: str = "left", right: str = "right", status: str = "status") -> DataFrame:
    """(a, b), a smaller, distinct: the pairs that some row confirms.

    Case and outer spaces of the status are ignored. A pair with a null end or
    of a record with itself links nothing; contradicting rows do not unlink.
    """
    l, r = F.col(f"`{left}`"), F.col(f"`{right}`")
    return (
        matches.filter(F.lower(F.trim(F.col(status))) == CONFIRMED)
        .filter(l.isNotNull() & r.isNotNull() & (l != r))
        .select(F.least(l, r).alias("a"), F.greatest(l, r).alias("b"))
        .distinct()
    )


def all_references(matches: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """(ref): the distinct references of both ends, nulls left out."""
    return (
        matches.select(F.explode(F.array(F.col(f"`{left}`"), F.col(f"`{right}`"))).alias("ref"))
        .filter("ref IS NOT NULL")
        .distinct()
    )


def match_groups(matches: DataFrame, rows_limit: int = ROWS_LIMIT) -> DataFrame:
    """(record_ref, group_ref): each reference with the smallest reference of its group.

    Every reference that occurs, not null, in either end has one row; one
    without confirmed links is its own group. Only the ends and the status are
    read, so other columns may hold anything. An empty table gives no rows.
    """
    grouped = labelled(cut(confirmed_pairs(matches)), rows_limit)
    grouped = grouped.select("ref", F.col("label").alias("group_ref"))
    return all_references(matches).join(grouped, "ref", "left").select(
        F.col("ref").alias("record_ref"), F.coalesce("group_ref", "ref").alias("group_ref")
    )
