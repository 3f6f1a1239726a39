"""Streams of observations: first and last sight, deduplication, idempotent upserts."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.sources.files import _hadoop, exists, merge


def first_last(stream: DataFrame, keys: list[str], time: str, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """First and last observation of each key and window; rows later than ``late`` are dropped."""
    w = F.window(time, width)
    return stream.withWatermark(time, late).groupBy(w.alias("w"), *keys).agg(F.min(time).alias("first_at"), F.max(time).alias("last_at"), F.count(F.lit(1)).alias("n"))


def deduplicated(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark, which bounds the state."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def upsert_sink(path: str, keys: list[str], order: list[str] | None = None, buckets: int = 64):
    """A foreachBatch function that merges each batch into a keyed table at ``path``.

    The table lies in ``buckets`` folders by a hash of the key; a batch rewrites
    only the buckets it touches, each into a new folder named by the batch. A
    marker, written last by a rename, names the folder of every bucket: a batch
    run again after a failure reads the marker of the batch before and gives the
    same table, and a batch already in the marker changes nothing. A marker that
    is missing while folders exist raises instead of starting anew.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = read_marker(spark, path)
        if state["batch"] >= batch_id:
            return
        rows = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        try:
            touched = [r[0] for r in rows.select("_bucket").distinct().collect()]  # at most ``buckets`` values
            if touched:
                before = [f"{path}/{state['buckets'][str(b)]}/_bucket={b}" for b in touched if str(b) in state["buckets"]]
                fresh = merge(rows.limit(0), rows, keys, order)
                if before:
                    old = spark.read.option("basePath", path).schema(batch.schema).parquet(*before)
                    old = old.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
                    fresh = merge(old.select(*rows.columns), rows, keys, order)
                fresh.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/batch-{batch_id}")
            state["buckets"].update({str(b): f"batch-{batch_id}" for b in touched})
            write_marker(spark, path, {"batch": batch_id, "buckets": state["buckets"]})
        finally:
            rows.unpersist()

    return write


def read_upserted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table that ``upsert_sink`` keeps at ``path``."""
    state = read_marker(spark, path)
    parts = [f"{path}/{folder}/_bucket={b}" for b, folder in sorted(state["buckets"].items())]
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def read_marker(spark: SparkSession, path: str) -> dict:
    """The state that the marker names; a marker whose rename was cut short counts."""
    for name in ("current.json", "next.json"):
        if exists(spark, f"{path}/{name}"):
            return json.loads("".join(r[0] for r in spark.read.text(f"{path}/{name}").collect()))
    fs, p = _hadoop(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    if any(n.startswith("batch-") and n != "batch-0" for n in names):
        raise RuntimeError(f"{path} holds batches but no marker")
    return {"batch": -1, "buckets": {}}


def write_marker(spark: SparkSession, path: str, state: dict) -> None:
    fs, new = _hadoop(spark, f"{path}/next.json")
    _, current = _hadoop(spark, f"{path}/current.json")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
    out.close()
    if fs.exists(current):
        fs.delete(current, False)
    fs.rename(new, current)


def polite(requests: DataFrame, host: str, at: str, delay: float, budget: int) -> DataFrame:
    """Adds place, not_before and within_budget: a host's requests in order, ``delay`` seconds
    apart from its first one, at most ``budget`` of them."""
    w = Window.partitionBy(host).orderBy(at, *[c for c in requests.columns if c not in (host, at)][:1])
    place = F.row_number().over(w)
    begun = F.min(at).over(Window.partitionBy(host))
    due = (begun.cast("double") + (F.col("place") - 1) * delay).cast("timestamp")
    return requests.withColumn("place", place).withColumn("not_before", F.greatest(F.col(at), due)).withColumn("within_budget", F.col("place") <= budget)


def retry_delays(delay: float, retries: int = 2) -> list[float]:
    """Seconds to wait before each further attempt, doubling from twice the delay."""
    return [delay * 2 ** (n + 1) for n in range(retries)]
