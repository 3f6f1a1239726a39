"""Row choice and ranking operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.session import cut


def best_row(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row for each key: the first in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def running_before(df: DataFrame, order: Column, amount: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``amount`` over the rows ahead in ``order``, 0 for the first.

    Without a window over all rows: ranges of rows are summed on their own, and
    only the ranges' totals, one row each, are added up in one place.
    """
    parts = df.sparkSession.sparkContext.defaultParallelism * 2
    placed = cut(df.repartitionByRange(parts, order).withColumn("_range", F.spark_partition_id()))
    ahead = lambda w: F.coalesce(F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = placed.groupBy("_range").agg(F.sum(amount).alias(amount))
    bases = totals.select("_range", ahead(Window.orderBy("_range")).alias("_base"))
    within = placed.withColumn("_within", ahead(Window.partitionBy("_range").orderBy(order)))
    return within.join(F.broadcast(bases), "_range").withColumn(out, F.col("_base") + F.col("_within")).drop("_range", "_base", "_within")


def average_rank(df: DataFrame, value: str, out: str = "avg_rank") -> DataFrame:
    """Ascending rank of ``value`` with the mean rank for ties.

    Counts per distinct value come first, so only distinct values are ranked in order.
    """
    sizes = running_before(df.groupBy(value).agg(F.count(F.lit(1)).alias("_n")), F.col(value).asc(), "_n", "_before")
    ranks = sizes.select(value, (F.col("_before") + (F.col("_n") + 1) / 2).alias(out))
    return df.join(ranks, value)


def top_share(df: DataFrame, value: str, percent: int) -> DataFrame:
    """Rows that reach the value of the last place within the top percent; ties stay, zeros go."""
    sizes = running_before(df.groupBy(value).agg(F.count(F.lit(1)).alias("_n")), F.col(value).desc(), "_n", "_ahead")
    total = F.broadcast(df.agg(F.count(F.lit(1)).alias("_all")))  # one row
    kept = sizes.crossJoin(total).filter(F.col("_ahead") < F.ceil(F.col("_all") * percent / 100)).filter(F.col(value) > 0).select(value)
    return df.join(kept, value, "left_semi")
