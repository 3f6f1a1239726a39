"""Session helpers: checkpoint folder, lineage cuts, small scalar reads."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests, a laptop) and the master is local, a temporary folder is taken.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loomgraph-ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it back.

    A lost executor costs nothing that was cut, and the plan starts anew: a
    checkpoint keeps the constraints of the plan it ends, and in loops that
    rename columns these grow until planning takes minutes. The tables go when
    the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/loomgraph-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def cut_measured(df: DataFrame, **figures: Column) -> tuple[DataFrame, dict]:
    """``cut`` that also returns aggregates of the rows, observed while they are written,
    so that no second job reads them; read back from the cut if the figures did not arrive."""
    watch = Observation()
    out = cut(df.observe(watch, *[c.alias(k) for k, c in figures.items()]))
    for _ in range(20):
        seen = watch._jo.getOrEmpty()
        if seen.size() == len(figures):
            return out, {k: seen.get(k).get() for k in figures}
        time.sleep(0.05)
    return out, out.agg(*[c.alias(k) for k, c in figures.items()]).first().asDict()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan enough partitions for Python work.

    A large table already has many splits and is left alone (no shuffle); a
    table of a few row groups is hashed by ``keys`` (unique or nearly so).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 < cores:
        return df.repartition(cores * 2, *keys)
    return df
