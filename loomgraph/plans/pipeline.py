"""Queries of sources, sinks and upkeep of the pipeline: documents, replay, schedules, staged files, releases, identity map, projections."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomgraph.operators import resolution as ER
from loomgraph.plans.registry import Registry
from loomgraph.session import checkpoint_dir
from loomgraph.sources import stores
from loomgraph.sources.schemas import schema
from loomgraph.sources.tables import read_table
from loomgraph.streaming.observations import polite

R = Registry()
query = R.query

_stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
_T = lambda c: f"strftime({c} AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')"
_PATH = r"regexp_replace(regexp_extract(regexp_replace(trim(final_url), '#.*$', ''), '^[a-zA-Z]+://[^/?]+([^?]*)', 1), '/{2,}', '/', 'g')"
_CANON = rf"""'https://' || lower(regexp_extract(final_url, '^[a-zA-Z]+://([^/?#:]+)', 1)) || CASE WHEN length({_PATH}) <= 1 THEN '/' ELSE regexp_replace({_PATH}, '/+$', '') END || CASE WHEN len(q) = 0 THEN '' ELSE '?' || array_to_string(list_sort(q), '&') END"""


@query(rf"""SELECT doc_id, sha256(text) AS content_sha256, canonical, 'doc_' || substr(sha256('["' || canonical || '", "' || sha256(text) || '"]'), 1, 16) AS document_id FROM (SELECT doc_id, text, {_CANON} AS canonical FROM (SELECT doc_id, text, final_url,
  [p for p in string_split(regexp_extract(final_url, '\?([^#]*)', 1), '&') if regexp_matches(p, '=.') AND string_split(p, '=')[1] NOT IN ('utm_source','utm_medium','utm_campaign','fbclid','gclid')] AS q FROM documents WHERE final_url IS NOT NULL AND text IS NOT NULL))""")
def make_documents(spark, d):
    """Document rows from retrieved bodies: content hash, canonical address and the id that follows from both."""
    t = read_table(spark, d, "documents", "doc_id", "url", "final_url", "text").filter("final_url IS NOT NULL AND text IS NOT NULL").withColumnRenamed("text", "body")
    return stores.make_documents(t).select("doc_id", "content_sha256", F.col("canonical_url").alias("canonical"), "document_id")


@query(f"SELECT canonical_url, doc_id, {_T('retrieved_at')} AS at FROM documents WHERE canonical_url IS NOT NULL AND http_status < 400 QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY retrieved_at DESC NULLS LAST, document_id, doc_id) = 1")
def replay_scan(spark, d):
    """The last good retrieval of each address."""
    t = read_table(spark, d, "documents", "canonical_url", "doc_id", "document_id", "retrieved_at", "http_status").filter("canonical_url IS NOT NULL AND http_status < 400")
    w = Window.partitionBy("canonical_url").orderBy(F.desc_nulls_last("retrieved_at"), "document_id", "doc_id")
    return t.withColumn("k", F.row_number().over(w)).filter("k = 1").select("canonical_url", "doc_id", _stamp("retrieved_at").alias("at"))


@query(f"""WITH r AS (SELECT source_id, doc_id, retrieved_at, row_number() OVER (PARTITION BY source_id ORDER BY retrieved_at, doc_id) AS place, min(retrieved_at) OVER (PARTITION BY source_id) AS f FROM documents WHERE source_id IS NOT NULL AND retrieved_at IS NOT NULL)
  SELECT doc_id, source_id, place, {_T('greatest(retrieved_at, f + (place - 1) * INTERVAL 3 SECOND)')} AS not_before, place <= 400 AS within_budget FROM r""")
def crawl_schedule(spark, d):
    """Requests of each source three seconds apart and within a budget of 400 pages."""
    t = read_table(spark, d, "documents", "source_id", "retrieved_at", "doc_id").filter("source_id IS NOT NULL AND retrieved_at IS NOT NULL").select("source_id", "retrieved_at", "doc_id")
    return polite(t, "source_id", "retrieved_at", 3, 400).select("doc_id", "source_id", "place", _stamp("not_before").alias("not_before"), "within_budget")


@query(f"""SELECT doc_id, canonical_url, {_T('retrieved_at')} AS at, CASE WHEN before IS NULL THEN 'first' WHEN retrieved_at < before + INTERVAL 30 DAY THEN 'reusable' ELSE 'stale' END AS state FROM (SELECT doc_id, canonical_url, retrieved_at, lag(retrieved_at) OVER (PARTITION BY canonical_url ORDER BY retrieved_at, doc_id) AS before FROM documents WHERE canonical_url IS NOT NULL AND retrieved_at IS NOT NULL)""")
def snapshot_freshness(spark, d):
    """For every retrieval: was the one before young enough (30 days) to be used again?"""
    t = read_table(spark, d, "documents", "doc_id", "canonical_url", "retrieved_at").filter("canonical_url IS NOT NULL AND retrieved_at IS NOT NULL")
    before = F.lag("retrieved_at").over(Window.partitionBy("canonical_url").orderBy("retrieved_at", "doc_id"))
    state = F.when(F.col("before").isNull(), "first").when(F.expr("retrieved_at < before + INTERVAL 30 DAYS"), "reusable").otherwise("stale")
    return t.withColumn("before", before).select("doc_id", "canonical_url", _stamp("retrieved_at").alias("at"), state.alias("state"))


def _folder(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/loomgraph-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def _passing(spark, path):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


@query("SELECT source_id, count(DISTINCT document_id) AS documents, count(DISTINCT canonical_url) AS urls, max(http_status) AS worst_status FROM documents WHERE document_id IS NOT NULL AND source_id IS NOT NULL GROUP BY 1")
def staged_round_trip(spark, d):
    """Documents written to staged folders by source, each id once, and read back typed."""
    t = read_table(spark, d, "documents", *schema("documents").names).filter("document_id IS NOT NULL AND source_id IS NOT NULL")
    folder = _folder(spark)
    _passing(spark, folder)
    ids = t.groupBy("source_id", "document_id").agg(F.max(F.struct("retrieved_at", "http_status", "canonical_url")).alias("m"))
    urls = t.groupBy("source_id").agg(F.countDistinct("canonical_url").alias("urls"), F.max("http_status").alias("worst_status"))
    ids.select("document_id", "source_id", "m.*").withColumn("staged", F.col("source_id")).write.partitionBy("staged").json(folder)
    back = spark.read.schema("document_id string, source_id string, retrieved_at timestamp, http_status int, canonical_url string, staged string").option("mode", "FAILFAST").json(folder)
    return back.groupBy("source_id").agg(F.countDistinct("document_id").alias("documents")).join(urls, "source_id")


@query("""SELECT 'org_units' AS tbl, count(*) AS n, true AS verified FROM org_units UNION ALL SELECT 'project', count(*), true FROM project UNION ALL SELECT 'relations', count(*), true FROM relations""")
def release_round_trip(spark, d):
    """Tables written as a release, verified against its manifest and loaded back."""
    folder = _folder(spark)
    _passing(spark, folder)
    tables = {t: read_table(spark, d, t) for t in ("org_units", "project", "relations")}
    stores.write_release(tables, folder, {"org_units": ["canonical_id"], "project": ["canonical_id"], "relations": ["relation_id"]}, {"report.md": "# tables"})
    bad = stores.verify_release(spark, folder)
    rows = [(name, df.count(), name not in bad) for name, df in stores.load_release(spark, folder).items()]
    return spark.createDataFrame(rows, "tbl string, n bigint, verified boolean")


@query("""SELECT type, count(DISTINCT relation_id) AS edges, count(DISTINCT source_id) AS sources FROM relations WHERE epistemic_status = 'OBSERVED' AND type IN ('PARTICIPATES_IN','MEMBER_OF','PART_OF') AND source_id IN (SELECT canonical_id FROM person UNION ALL SELECT canonical_id FROM org_units UNION ALL SELECT canonical_id FROM project)
  AND target_id IN (SELECT canonical_id FROM person UNION ALL SELECT canonical_id FROM org_units UNION ALL SELECT canonical_id FROM project) GROUP BY 1""")
def graph_export(spark, d):
    """Observed edges of three types between known nodes."""
    nodes = None
    for t in ("person", "project", "org_units"):
        n = read_table(spark, d, t, "canonical_id").filter("canonical_id IS NOT NULL")
        nodes = n if nodes is None else nodes.unionByName(n)
    e = read_table(spark, d, "relations", "relation_id", "type", "source_id", "target_id", "epistemic_status")
    _, edges = stores.export_graph(nodes, e, True, ["PARTICIPATES_IN", "MEMBER_OF", "PART_OF"])
    return edges.groupBy("type").agg(F.countDistinct("relation_id").alias("edges"), F.countDistinct("source_id").alias("sources"))


@query("""SELECT relation_id, count(*) AS n, max(CASE WHEN qualifiers IS NULL THEN 0 ELSE cardinality(qualifiers) END) AS n_qualifiers, max(len(claim_ids)) AS n_claims FROM relations WHERE relation_id IS NOT NULL GROUP BY 1""")
def flat_properties(spark, d):
    """Nested values as JSON text, scalars and lists as they are; read back here to count what they hold."""
    flat = stores.flatten_props(read_table(spark, d, "relations", "relation_id", "qualifiers", "claim_ids").filter("relation_id IS NOT NULL"))
    held = F.coalesce(F.size(F.map_keys(F.from_json("qualifiers", "map<string, array<string>>"))), F.lit(0))
    return flat.groupBy("relation_id").agg(F.count(F.lit(1)).alias("n"), F.max(held).alias("n_qualifiers"), F.max(F.size("claim_ids")).alias("n_claims"))


@query("""WITH cl AS (SELECT ref, min(cluster) AS cluster FROM (SELECT unnest(source_refs) AS ref, label AS cluster FROM person) WHERE ref IS NOT NULL AND cluster IS NOT NULL GROUP BY 1) SELECT cluster, count(*) AS n, min(ref) AS least_ref FROM cl GROUP BY 1""")
def identity_clusters(spark, d):
    """Clusters of records by label with their least reference: what ids are assigned to."""
    return ER.clusters_of(_records(spark, d)[0]).select("cluster", "n", "least_ref")


def _records(spark, d):
    p = read_table(spark, d, "person", "canonical_id", "source_refs", "label", "first_observed_at").select("canonical_id", F.explode("source_refs").alias("ref"), "label", "first_observed_at").filter("ref IS NOT NULL")
    clusters = p.filter("label IS NOT NULL").groupBy("ref").agg(F.min("label").alias("cluster"))
    known = p.filter("first_observed_at IS NOT NULL").groupBy("ref", "canonical_id").agg(F.min("first_observed_at").alias("assigned_at"))
    return clusters, known.groupBy("ref").agg(F.min(F.struct("assigned_at", "canonical_id")).alias("k")).select("ref", "k.canonical_id", "k.assigned_at")


@query()
def identity_map(spark, d):
    """References with a stable id: a cluster takes the best of its members' ids that no earlier cluster took
    (no SQL: the assignment is ordered; checked against a plain loop in tests)."""
    clusters, known = _records(spark, d)
    return ER.assign_ids(clusters, known).select("ref", "canonical_id", "previous_id", "is_new")


QUERIES, ORACLES = R.queries, R.oracles
