"""History of changing attributes by tree-reduction coalescing.

A snapshot row is a unit interval of its entity's history: it starts at its time
and holds until the next one. Neighbouring runs of equal payload are merged
pairwise, block by block, over logarithmically many rounds: in round ``k`` the
blocks ``2j`` and ``2j+1`` of ``2**k`` positions join, and the right block loses
its first run if that continues the left block's last one.

An entity may hold a third of all rows. No step gathers an entity: positions
come from counts per (entity, day) and ranks within a day, rounds stay within
chunks of ``2**CHUNK_BITS`` positions (one shuffle for all rounds, arrays of at
most so many runs), and the seams between chunks are closed by an equi-join of
neighbouring chunks, which have one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.session import cut

CHUNK_BITS = 10


def unit_intervals(rows: DataFrame, entity: str, time: str, recency: str, payload: Column) -> DataFrame:
    """(entity, t, p): one row for each entity and time, the latest ``recency`` counting.

    Equal recency: the greater payload counts; null recency is the oldest. Rows
    without entity or time are left out.
    """
    return (
        rows.select(F.col(entity).alias("entity"), F.col(time).alias("t"), F.struct(F.col(recency).alias("r"), payload.alias("p")).alias("v"))
        .filter("entity IS NOT NULL AND t IS NOT NULL")
        .groupBy("entity", "t")
        .agg(F.max("v").alias("v"))
        .select("entity", "t", F.col("v.p").alias("p"))
    )


def positions(units: DataFrame) -> DataFrame:
    """Adds pos = 0, 1, ... in order of t within the entity, without gathering an entity."""
    dated = units.withColumn("day", F.to_date("t"))
    ahead = Window.partitionBy("entity").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    bases = dated.groupBy("entity", "day").agg(F.count(F.lit(1)).alias("n")).select(
        "entity", "day", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base")
    )
    rank = F.row_number().over(Window.partitionBy("entity", "day").orderBy("t")) - 1
    return dated.withColumn("k", rank).join(bases, ["entity", "day"]).select("entity", "t", "p", (F.col("base") + F.col("k")).alias("pos"))


def _merge_pair(blocks: Column) -> Column:
    """Two neighbouring blocks (or one) -> one block; equal runs at the seam coalesce."""
    left, right = blocks[0]["runs"], blocks[1]["runs"]
    seam = F.element_at(left, -1)["p"].eqNullSafe(right[0]["p"])
    return F.when(F.size(blocks) == 1, left).when(seam, F.concat(left, F.slice(right, F.lit(2), F.size(right)))).otherwise(F.concat(left, right))


def coalesce_versions(units: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """(entity, p, t, next_t): a row for each maximal run of equal payload.

    ``t`` is the run's first time, ``next_t`` the next run's first time or null.
    """
    placed = cut(positions(units))
    longest = placed.agg(F.max("pos")).first()[0]
    if longest is None:
        return placed.select("entity", "p", "t", F.col("t").alias("next_t"))
    blocks = placed.select(
        "entity", F.shiftright("pos", chunk_bits).alias("chunk"), F.col("pos").alias("block"), F.array(F.struct("t", "p")).alias("runs")
    ).repartition("entity", "chunk")
    for _ in range(min(chunk_bits, int(longest).bit_length())):
        pair = F.array_sort(F.collect_list(F.struct("block", "runs")))
        blocks = (
            blocks.groupBy("entity", "chunk", F.shiftright("block", 1).alias("up")).agg(pair.alias("pair"))
            .select("entity", "chunk", F.col("up").alias("block"), _merge_pair(F.col("pair")).alias("runs"))
        )
    if longest >> chunk_bits:
        blocks = cut(blocks)
        before = blocks.select("entity", (F.col("chunk") + 1).alias("chunk"), F.element_at("runs", -1)["p"].alias("last_p"), F.lit(True).alias("b"))
        continues = F.col("b").isNotNull() & F.col("last_p").eqNullSafe(F.col("runs")[0]["p"])
        blocks = blocks.join(before, ["entity", "chunk"], "left").select(
            "entity", "chunk", F.when(continues, F.slice("runs", F.lit(2), F.size("runs"))).otherwise(F.col("runs")).alias("runs")
        ).filter(F.size("runs") > 0)
        after = F.lead(F.col("runs")[0]["t"]).over(Window.partitionBy("entity").orderBy("chunk"))
        blocks = blocks.withColumn("after", after)
    else:
        blocks = blocks.withColumn("after", F.lit(None).cast(units.schema["t"].dataType))
    # the next start joins each run inside the list, so no list is copied beside its members
    ended = F.transform("runs", lambda x, i: F.struct(x["p"].alias("p"), x["t"].alias("t"), F.coalesce(F.try_element_at("runs", i + 2)["t"], F.col("after")).alias("next_t")))
    return blocks.select("entity", F.explode(ended).alias("run")).select("entity", "run.p", "run.t", "run.next_t")


def attribute_versions(
    rows: DataFrame, entity: str, payload: Column, verified: str, snapshot: str, recency: str, first_observed: str
) -> DataFrame:
    """(canonical_id, valid_from, valid_until) of each version, days as yyyy-MM-dd.

    Time of a row: ``verified`` or, where null, midnight of ``snapshot``; a row
    with neither says nothing. The first version starts on the day of the least
    ``first_observed`` if that is earlier. The last one is ``open``.
    """
    at = F.coalesce(F.col(verified), F.col(snapshot).cast("timestamp"))
    units = unit_intervals(rows.withColumn("_at", at), entity, "_at", recency, payload)
    runs = coalesce_versions(units)
    begun = rows.filter(F.col(entity).isNotNull()).groupBy(F.col(entity).alias("entity")).agg(F.min(first_observed).alias("f"))
    first = units.groupBy("entity").agg(F.min("t").alias("first_t")).join(begun, "entity")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    start = F.when(F.col("t") == F.col("first_t"), F.least(day(F.col("t")), day(F.col("f")))).otherwise(day(F.col("t")))
    return runs.join(first, "entity").select(
        F.col("entity").alias(entity), start.alias("valid_from"), F.coalesce(day(F.col("next_t")), F.lit("open")).alias("valid_until")
    )
