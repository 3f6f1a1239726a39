"""What changed between full snapshots, by bitmaps over persistent ordinals.

Keys get ordinals once, in key order; a later call keeps known ordinals and
appends new keys behind them. For each snapshot and container of 32,768
ordinals a compressed bitmap tells which keys are there: a list of positions
while it has few members, 4,096 bytes of bits beyond; containers without a
member do not exist. Current AND NOT previous gives the additions, previous AND
NOT current the removals, and for the common members two vectors of payload
codes, both in ordinal order, show the changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.session import cut, cut_measured
from loomgraph.sources.files import exists

CONTAINER = 32_768
#: A container with fewer members is a list of positions.
SPARSE = 2_048


def assign_ordinals(keys: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(key, ordinal) for the distinct, not-null keys; ``known`` ones stay as they are.

    A range sort spreads the keys, the id grows with the sort order; gaps between
    partitions only leave containers out. Cut, so that a re-run sees the same ids.
    """
    new = keys.filter("key IS NOT NULL").distinct()
    if known is None:
        return cut(new.orderBy("key").select("key", F.monotonically_increasing_id().alias("ordinal")))
    top = known.agg(F.max("ordinal")).first()[0]
    base = 0 if top is None else (top // CONTAINER + 1) * CONTAINER
    fresh = new.join(known, "key", "left_anti").orderBy("key").select("key", (F.monotonically_increasing_id() + F.lit(base)).alias("ordinal"))
    return cut(known.select("key", "ordinal").unionByName(fresh))


def persistent_ordinals(keys: DataFrame, path: str) -> DataFrame:
    """``assign_ordinals`` against the table at ``path``, which is made or grows by the new
    keys: a key keeps its ordinal from delivery to delivery. keys (key)."""
    spark = keys.sparkSession
    known = spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], f"key {keys.schema['key'].dataType.simpleString()}, ordinal bigint")
    everything = assign_ordinals(keys, known)
    everything.join(known.select("key"), "key", "left_anti").write.mode("append").parquet(path)
    return everything


def latest_per_snapshot(rows: DataFrame, key: str, date: str, recency: str, payload: Column) -> DataFrame:
    """(key, date, p): of several rows of a key and date the latest ``recency`` counts
    (equal: the greater payload; null is the oldest). Rows without key or date are left out."""
    return (
        rows.select(F.col(key).alias("key"), F.col(date).alias("date"), F.struct(F.col(recency).alias("r"), payload.alias("p")).alias("v"))
        .filter("key IS NOT NULL AND date IS NOT NULL")
        .groupBy("key", "date").agg(F.max("v").alias("v")).select("key", "date", F.col("v.p").alias("p"))
    )


def _members(bits: pa.Scalar, positions: pa.Scalar) -> np.ndarray:
    """Sorted members of a container in either form; none if it is absent."""
    if bits.is_valid:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8), bitorder="little"))
    return positions.values.to_numpy(zero_copy_only=False) if positions.is_valid else np.empty(0, np.int64)


def _and_not(x: tuple[pa.Scalar, np.ndarray], y: tuple[pa.Scalar, np.ndarray]) -> np.ndarray:
    """Members of x that y lacks: on the bits where both are bitmaps, else on the lists."""
    (xb, xm), (yb, ym) = x, y
    if xb.is_valid and yb.is_valid:
        return np.flatnonzero(np.unpackbits(np.frombuffer(xb.as_buffer(), np.uint8) & ~np.frombuffer(yb.as_buffer(), np.uint8), bitorder="little"))
    return np.setdiff1d(xm, ym, assume_unique=True)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers of two neighbouring dates -> (bucket, date, position, change); vectors are read from the Arrow buffers."""
    kinds = ["added", "removed", "changed"]
    for batch in batches:
        c = dict(zip(batch.schema.names, batch.columns))
        rows, bits, changes = [], [], []
        for i in range(batch.num_rows):
            now, old = _members(c["cur"][i], c["cur_pos"][i]), _members(c["prev"][i], c["prev_pos"][i])
            hits = [_and_not((c["cur"][i], now), (c["prev"][i], old)), _and_not((c["prev"][i], old), (c["cur"][i], now))]
            if len(now) and len(old):
                both, at, was = np.intersect1d(now, old, assume_unique=True, return_indices=True)
                vector = lambda name: c[name][i].values.to_numpy(zero_copy_only=False)
                hits.append(both[(vector("cur_a")[at] != vector("prev_a")[was]) | (vector("cur_b")[at] != vector("prev_b")[was])])
            for kind, found in zip(kinds, hits):
                rows.append(np.full(len(found), i))
                bits.append(found.astype(np.int64))
                changes += [kind] * len(found)
        take = pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64), pa.int64())
        flat = pa.array(np.concatenate(bits) if bits else np.empty(0, np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([c["bucket"].take(take), c["date"].take(take), flat, pa.array(changes, pa.string())], names=["bucket", "date", "bit", "change_type"])


def snapshot_changes(rows: DataFrame, key: str, date: str, recency: str, payload: Column, ordinals: DataFrame | None = None) -> DataFrame:
    """(key, snapshot_date, change_type) against the table's previous date.

    The first date has no rows. An absent key is ``removed`` once and ``added``
    when it returns. Payload codes are two 64-bit hashes of the payload with
    different seeds. An empty table gives no rows.
    """
    states = cut(latest_per_snapshot(rows, key, date, recency, payload))
    ordinals = assign_ordinals(states.select("key")) if ordinals is None else ordinals
    dates = sorted(r[0] for r in states.select("date").distinct().collect())  # one value a delivery
    spark = rows.sparkSession
    follows = spark.createDataFrame(list(zip(dates, dates[1:])), "date date, next date")
    placed = states.join(ordinals, "key").select(
        "date",
        F.floor(F.col("ordinal") / CONTAINER).alias("bucket"),
        F.pmod("ordinal", F.lit(CONTAINER)).alias("bit"),
        F.xxhash64("p", F.lit(11)).alias("a"),
        F.xxhash64("p", F.lit(23)).alias("b"),
    )
    vectors = placed.groupBy("bucket", "date").agg(
        F.bitmap_construct_agg("bit").alias("map"), F.array_sort(F.collect_list(F.struct("bit", "a", "b"))).alias("v")
    )
    dense = F.size("v") >= SPARSE
    vectors = vectors.select("bucket", "date", F.when(dense, F.col("map")).alias("map"), F.when(~dense, F.col("v.bit")).alias("pos"), F.col("v.a").alias("va"), F.col("v.b").alias("vb"))
    vectors, size = cut_measured(vectors, n=F.count(F.lit(1)))
    later = F.broadcast(follows)  # one row a delivery
    shape = "struct<map:binary,pos:array<bigint>,va:array<bigint>,vb:array<bigint>>"
    current = vectors.join(F.broadcast(follows.select(F.col("next").alias("date"))), "date").select(
        "bucket", "date", F.struct("map", "pos", "va", "vb").alias("cur"), F.lit(None).cast(shape).alias("prev")
    )
    previous = vectors.join(later, "date").select(
        "bucket", F.col("next").alias("date"), F.lit(None).cast(shape).alias("cur"), F.struct("map", "pos", "va", "vb").alias("prev")
    )
    pairs = current.unionByName(previous).groupBy("bucket", "date").agg(
        F.first("cur", ignorenulls=True).alias("c"), F.first("prev", ignorenulls=True).alias("p")
    ).select("bucket", "date", F.col("c.map").alias("cur"), F.col("p.map").alias("prev"), F.col("c.pos").alias("cur_pos"), F.col("p.pos").alias("prev_pos"), F.col("c.va").alias("cur_a"), F.col("c.vb").alias("cur_b"), F.col("p.va").alias("prev_a"), F.col("p.vb").alias("prev_b"))
    # a container's vectors take up to a megabyte: few of them to a partition, so that Arrow batches stay small
    pairs = pairs.repartition(size["n"] // 64 + 1, "bucket", "date")
    found = pairs.mapInArrow(_compare, "bucket bigint, date date, bit bigint, change_type string")
    return found.select((F.col("bucket") * CONTAINER + F.col("bit")).alias("ordinal"), "date", "change_type").join(ordinals, "ordinal").select(
        F.col("key").alias(key), F.date_format("date", "yyyy-MM-dd").alias("snapshot_date"), "change_type"
    )
