"""Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Scan ``folder/name.parquet``, restricted to ``columns`` if any are named.

    All times are UTC, so the session's zone is set to it.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*[f"`{c}`" for c in columns]) if columns else df
