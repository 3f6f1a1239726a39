"""Staged folders, raw content, releases, review queues, identity maps, configuration and reports."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.functions import urls
from loomgraph.operators.windows import best_row
from loomgraph.sources.files import _hadoop, exists, merge, read_jsonl
from loomgraph.sources.schemas import DDL, KEYS, STRICT, schema


# documents from retrieved bodies
def make_documents(pages: DataFrame, aliases: Column | None = None) -> DataFrame:
    """Rows of ``documents`` from retrieved pages (source_id, url, final_url, retrieved_at, http_status, content_type, body).

    The id follows from the canonical address and the hash of the body, so the
    same content at one address is one document, whenever it came. body: string
    or binary; null has no hash and no id.
    """
    sha = F.sha2(F.col("body").cast("binary"), 256)
    address = urls.canonical_url(F.coalesce("final_url", "url"), aliases)
    title = F.trim(F.regexp_replace(F.regexp_extract(F.col("body").cast("string"), r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))
    rows = pages.withColumns({"content_sha256": sha, "canonical_url": address, "page_title": F.nullif(title, F.lit(""))})
    key = F.concat(F.lit('["'), "canonical_url", F.lit('", "'), "content_sha256", F.lit('"]'))
    return rows.withColumn("document_id", F.concat(F.lit("doc_"), F.substring(F.sha2(key, 256), 1, 16)))


def file_documents(spark: SparkSession, glob: str, source_id: str) -> DataFrame:
    """Curated files as documents: address ``repo://`` and path, hash of the bytes."""
    files = spark.read.format("binaryFile").load(glob)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return files.select(F.lit(source_id).alias("source_id"), F.concat(F.lit("repo://"), name).alias("url"), F.sha2("content", 256).alias("content_sha256"), F.col("modificationTime").alias("retrieved_at"), F.col("length").alias("n_bytes")).withColumn(
        "document_id", F.concat(F.lit("doc_"), F.substring(F.sha2(F.concat(F.lit('["'), "url", F.lit('", "'), "content_sha256", F.lit('"]')), 256), 1, 16)))


def write_raw(pages: DataFrame, root: str) -> None:
    """Bodies by the hash of their content, each once, in folders of the first two digits."""
    bodies = pages.filter("body IS NOT NULL").select(F.sha2(F.col("body").cast("binary"), 256).alias("sha"), F.col("body").cast("binary").alias("body"))
    spark = pages.sparkSession
    fresh = bodies.dropDuplicates(["sha"])  # equal hashes are equal bodies
    if exists(spark, root):
        fresh = fresh.join(read_raw(spark, root).select("sha"), "sha", "left_anti")
    fresh.withColumn("prefix", F.substring("sha", 1, 2)).write.mode("append").partitionBy("prefix").parquet(root)


def read_raw(spark: SparkSession, root: str, shas: list[str] | None = None) -> DataFrame:
    """(sha, body); named hashes prune the folders before anything is read."""
    df = spark.read.parquet(root)
    if shas is None:
        return df.select("sha", "body")
    return df.filter(F.col("prefix").isin(*sorted({s[:2] for s in shas})) & F.col("sha").isin(*shas)).select("sha", "body")


def replay(documents: DataFrame) -> DataFrame:
    """What a replayed crawl serves: the last good retrieval of each canonical address."""
    good = documents.filter("canonical_url IS NOT NULL AND http_status < 400")
    return best_row(good, ["canonical_url"], F.desc_nulls_last("retrieved_at"), F.asc("document_id"))


def fixture_pages(spark: SparkSession, glob: str, manifest: DataFrame) -> DataFrame:
    """Whole files joined with their manifest (file, url, source_id, observed)."""
    files = spark.read.option("wholetext", True).text(glob).select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1).alias("file"), F.col("value").alias("body"))
    return manifest.join(files, "file", "left")


# staged folders
def write_staged(tables: dict[str, DataFrame], folder: str, source_id: str) -> dict[str, int]:
    """The files of one source. Of rows delivered again the last stands (column ``ordinal`` if
    there is one, else any equal row); frontier and diagnostics are sorted. Returns the counts."""
    counts = {}
    for name, df in tables.items():
        out = df
        if name in KEYS:
            out = best_row(df, KEYS[name], F.desc("ordinal")) if "ordinal" in df.columns else df.dropDuplicates(KEYS[name])
        out = out.select(*[c for c in schema(name).names if c in out.columns])
        path = f"{folder}/source_id={source_id}/{name}.jsonl"
        order = {"frontier": ["url"], "diagnostics": ["page_type", "url", "document_id"]}.get(name)
        (out.orderBy(*order) if order else out).write.mode("overwrite").json(path)
        counts[name] = df.sparkSession.read.schema(schema(name)).json(path).count()
    return counts


def read_staged(spark: SparkSession, folder: str, source_id: str) -> dict[str, DataFrame]:
    """All files of one source, typed: records, claims and documents strictly, the rest leniently; a missing file is empty."""
    return {name: read_jsonl(spark, f"{folder}/source_id={source_id}/{name}.jsonl", schema(name), name in STRICT) for name in ("records", "claims", "documents", "errors", "frontier", "diagnostics")}


def staged_sources(spark: SparkSession, folder: str, wanted: Iterable[str] | None = None) -> list[str]:
    """Sources of a staged folder that have claims; the others are skipped."""
    fs, path = _hadoop(spark, folder)
    names = [s.getPath().getName()[10:] for s in fs.listStatus(path) if s.getPath().getName().startswith("source_id=")] if fs.exists(path) else []
    return sorted(n for n in names if (wanted is None or n in wanted) and exists(spark, f"{folder}/source_id={n}/claims.jsonl"))


def union_staged(spark: SparkSession, folder: str, name: str, wanted: Iterable[str] | None = None) -> DataFrame:
    """One kind of file over all sources that have claims, with the source as a column."""
    out = spark.createDataFrame([], T.StructType([*schema(name).fields, T.StructField("staged_source", T.StringType())]))
    for s in staged_sources(spark, folder, wanted):
        out = out.unionByName(read_jsonl(spark, f"{folder}/source_id={s}/{name}.jsonl", schema(name), name in STRICT).withColumn("staged_source", F.lit(s)))
    return out


# releases
def checksum(df: DataFrame) -> int:
    """A sum over row hashes, the same for any order and partitioning of the rows."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)])))
    return int(df.agg(F.coalesce(F.sum(F.pmod(row, F.lit(1 << 40))), F.lit(0)).alias("s")).first()["s"])


def write_release(tables: dict[str, DataFrame], folder: str, keys: dict[str, list[str]], reports: dict[str, str] | None = None) -> dict:
    """A release: each table sorted by its key, reports beside them, tables of an older release that
    are no longer part removed, and last the manifest with counts and checksums."""
    spark = next(iter(tables.values())).sparkSession
    manifest: dict = {"tables": {}, "reports": sorted(reports or {})}
    for name, df in tables.items():
        df.repartitionByRange(*keys[name]).sortWithinPartitions(*keys[name]).write.mode("overwrite").parquet(f"{folder}/{name}")
        written = spark.read.parquet(f"{folder}/{name}")
        manifest["tables"][name] = {"rows": written.count(), "checksum": checksum(written)}
    fs, path = _hadoop(spark, folder)
    for entry in fs.listStatus(path):
        name = entry.getPath().getName()
        if entry.isDirectory() and name not in tables:
            fs.delete(entry.getPath(), True)
    for name, text in (reports or {}).items():
        write_text(spark, f"{folder}/{name}", text)
    write_text(spark, f"{folder}/manifest.json", json.dumps(manifest, sort_keys=True))
    return manifest


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _hadoop(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def load_release(spark: SparkSession, folder: str, views: bool = False) -> dict[str, DataFrame]:
    """The tables of a release by its manifest, as temporary views too if wanted."""
    manifest = json.loads(read_text(spark, f"{folder}/manifest.json"))
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in manifest["tables"]}
    if views:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
    return tables


def verify_release(spark: SparkSession, folder: str) -> list[str]:
    """Tables that are missing or whose count or checksum differs from the manifest."""
    manifest = json.loads(read_text(spark, f"{folder}/manifest.json"))
    bad = []
    for name, want in manifest["tables"].items():
        if not exists(spark, f"{folder}/{name}"):
            bad.append(name)
            continue
        df = spark.read.parquet(f"{folder}/{name}")
        if df.count() != want["rows"] or checksum(df) != want["checksum"]:
            bad.append(name)
    return bad


def load_graph(old: DataFrame | None, new: DataFrame, keys: list[str], prune: bool = False, order: list[str] | None = None) -> DataFrame:
    """Idempotent load of nodes or edges by key: new rows replace old ones; ``prune`` drops what the new ones lack."""
    if old is None or prune:
        return merge(new.limit(0), new, keys, order)
    return merge(old, new, keys, order)


def in_batches(df: DataFrame, key: str, size: int = 500) -> DataFrame:
    """Adds ``batch``: groups of at most about ``size`` rows, made by hash, for a sink that takes batches."""
    n = max(1, -(-df.count() // size))
    return df.withColumn("batch", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))


def export_graph(nodes: DataFrame, edges: DataFrame, observed_only: bool = False, types: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges of a property graph; edges may be limited to observed ones and to types, and have both ends."""
    e = edges.filter("epistemic_status = 'OBSERVED'") if observed_only else edges
    e = e.filter(F.col("type").isin(*types)) if types else e
    ids = nodes.select("canonical_id").distinct()
    e = e.join(ids.withColumnRenamed("canonical_id", "source_id"), "source_id", "left_semi").join(ids.withColumnRenamed("canonical_id", "target_id"), "target_id", "left_semi")
    return nodes, e


def save_identity_map(rows: DataFrame, path: str) -> None:
    """The map of references to ids, sorted, one row for each reference."""
    rows.orderBy("source_ref").write.mode("overwrite").json(path)


def write_review_queue(pairs: DataFrame, path: str, only: DataFrame | None = None) -> None:
    """Possible matches for review as sorted JSON lines; ``only`` (ref) keeps pairs of anchored records."""
    if only is not None:
        of = lambda c: only.select(F.col("ref").alias(c))
        pairs = pairs.join(of("left"), "left", "left_semi").join(of("right"), "right", "left_semi")
    pairs.orderBy(F.desc("score"), "left", "right").write.mode("overwrite").json(path)


# configuration and reports
def read_config(path: str) -> dict:
    """A small configuration file (JSON, or YAML where a YAML reader is installed); missing is empty."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML configuration needs a YAML reader") from e
    return yaml.safe_load(text) or {}


def config_table(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """Entries of a configuration list as a small table, fields that are not named left out."""
    names = T.StructType.fromDDL(ddl).names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)


def render_table(df: DataFrame, title: str, limit: int = 1000) -> str:
    """A small table as Markdown; reports are aggregates, a longer one is cut and says so."""
    rows = df.limit(limit + 1).collect()
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows[:limit]]
    return "\n".join([*lines, *(["", f"(the first {limit} rows)"] if len(rows) > limit else [])])


def flatten_props(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Scalars and lists of scalars stay; structs, maps and lists of structs become JSON text."""
    def prop(f: T.StructField) -> Column:
        nested = isinstance(f.dataType, (T.StructType, T.MapType)) or (isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.StructType, T.MapType, T.ArrayType)))
        return F.to_json(F.col(f"`{f.name}`")).alias(f.name) if nested and f.name not in keep else F.col(f"`{f.name}`")

    return df.select(*[prop(f) for f in df.schema.fields])


# adapters: what a new kind of site brings
class Adapter:
    """Parses the pages of one kind of site: ``parse(pages) -> {file: DataFrame}``, files as in ``schemas.DDL``."""

    name, version = "base", "0"

    def parse(self, pages: DataFrame) -> dict[str, DataFrame]:
        raise NotImplementedError


ADAPTERS: dict[str, type[Adapter]] = {}


def adapter(name: str) -> Callable[[type[Adapter]], type[Adapter]]:
    """Registers an adapter under a name."""

    def add(cls: type[Adapter]) -> type[Adapter]:
        cls.name = name
        ADAPTERS[name] = cls
        return cls

    return add


def ingest(spark: SparkSession, pages: DataFrame, name: str, folder: str, source_id: str) -> dict[str, int]:
    """Pages through a registered adapter into a staged folder; returns the counts of each file."""
    return write_staged(ADAPTERS[name]().parse(pages), folder, source_id)


assert set(STRICT) <= set(DDL)
