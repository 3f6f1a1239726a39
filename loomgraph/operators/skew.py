"""Joins that survive a key holding a third of all rows.

A key is hot if it has more than ``rows_limit`` rows on the fact side. There are
at most ``rows / rows_limit`` hot keys, so their list is small by construction
(10**12 rows and the default give 500,000 keys) and is broadcast only within
that bound. Rows of a hot key are spread over ``fan`` salts by a hash of the
whole row, which is the same whenever a task is run again; the dimension's rows
of hot keys are repeated once for each salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_LIMIT = 2_000_000
NULL_FAN = 4096


def hot_keys(facts: DataFrame, key: str, rows_limit: int = ROWS_LIMIT) -> DataFrame:
    """(key, _fan) of each hot key; partial aggregation before the shuffle."""
    return (
        facts.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_limit)
        .select(key, F.ceil(F.col("_n") / rows_limit).cast("int").alias("_fan"))
    )


def salted_join(
    facts: DataFrame, dim: DataFrame, key: str, how: str = "left", rows_limit: int = ROWS_LIMIT
) -> DataFrame:
    """``facts.join(dim, key, how)`` for how in inner, left, left_semi, left_anti.

    ``dim`` must hold a key at most a bounded number of times. Null keys match
    nothing, as in SQL; in a left or anti join their rows are kept and spread by
    the hash and the input partition over NULL_FAN salts, which no row of ``dim`` bears.
    """
    assert how in ("inner", "left", "left_semi", "left_anti")
    hot = F.broadcast(hot_keys(facts, key, rows_limit))
    rest = [F.col(f"`{c}`") for c in facts.columns if c != key and _hashable(facts, c)]
    salt = (
        F.when(F.col("_fan").isNotNull(), F.pmod(F.xxhash64(*rest, F.lit(7)), F.col("_fan")))
        .when(F.col(f"`{key}`").isNull(), -1 - F.pmod(F.xxhash64(*rest, F.spark_partition_id()), F.lit(NULL_FAN)))
        .otherwise(F.lit(0))
    )
    left = facts.join(hot, key, "left").withColumn("_salt", salt.cast("int")).drop("_fan")
    right = (
        dim.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_fan"), F.lit(1)) - 1)))
        .drop("_fan")
    )
    return left.join(right, [key, "_salt"], how).drop("_salt")


def _hashable(df: DataFrame, column: str) -> bool:
    return "map<" not in dict(df.dtypes)[column]
