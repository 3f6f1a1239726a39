"""Line-delimited JSON, entity folders, keyed tables and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.operators.windows import best_row


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """JSON lines with a fixed schema; a missing file is an empty table.

    strict: malformed lines fail the read; otherwise they become null rows.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)


def read_entities(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """One file for each entity type; the file's stem becomes ``entity_type``."""
    df = spark.read.schema(schema).json(f"{folder}/*.jsonl")
    return df.withColumn("entity_type", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.jsonl$", 1))


def latest_documents(documents: DataFrame, key: str = "canonical_url", time: str = "retrieved_at") -> DataFrame:
    """The last retrieval of each address; ties go to the greater content hash."""
    value = F.struct(*[F.col(c) for c in [time, *[c for c in documents.columns if c not in (time, key)]]])
    best = documents.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias("v"))
    return best.select(key, "v.*").select(*documents.columns)


def write_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """Sorted JSON lines, the same for every run over the same rows."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def merge(old: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Keyed upsert: rows of ``new`` replace those of ``old`` with the same key, and
    running it twice changes nothing. Of several new rows of a key the one with the
    greatest ``order`` columns stands (then the greatest hash of the row, so a re-run picks the same)."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in new.columns])))
    fresh = best_row(new, keys, *[F.desc_nulls_last(c) for c in order or []], row.desc())
    return old.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh.select(*old.columns))


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def data_dictionary(schemas: dict[str, T.StructType]) -> str:
    """Markdown list of tables, columns and types."""
    lines = []
    for name in sorted(schemas):
        lines += [f"## {name}", "", "| column | type | null |", "|---|---|---|"]
        lines += [f"| {f.name} | {f.dataType.simpleString()} | {'yes' if f.nullable else 'no'} |" for f in schemas[name].fields] + [""]
    return "\n".join(lines)
