"""Queries of discovery and coverage: registry, routing of links, retrieval, source set, gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import urls
from loomgraph.operators import discovery as D
from loomgraph.operators import graph as G
from loomgraph.operators.skew import salted_join
from loomgraph.operators.windows import best_row
from loomgraph.plans.graphs import _MEM, membership
from loomgraph.plans.registry import Registry
from loomgraph.plans.texts import _HOST
from loomgraph.session import cut
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query

_REG = """reg AS (SELECT source_id, split_part(source_id, '_', 2) || '.' || split_part(source_id, '_', 1) || '-kutato.example' AS host, ['m.' || split_part(source_id, '_', 2) || '.' || split_part(source_id, '_', 1) || '-kutato.example'] AS verified,
  ['archivum.' || split_part(source_id, '_', 2) || '.' || split_part(source_id, '_', 1) || '-kutato.example'] AS inferred, source_id <> 'vt_kultura' AS enabled, NOT source_id LIKE 'vt_%' AS in_run, split_part(source_id, '_', 1) || '-kutato.example' AS suffix FROM (SELECT DISTINCT source_id FROM documents WHERE source_id IS NOT NULL)),
  al AS (SELECT h AS host, arg_min(canonical, s) AS canonical, ['canonical','verified','inferred'][min(s) + 1] AS status FROM (SELECT host AS h, host AS canonical, 0 AS s FROM reg UNION ALL SELECT unnest(verified), host, 1 FROM reg UNION ALL SELECT unnest(inferred), host, 2 FROM reg) GROUP BY 1)"""


def registry(spark, d):
    """One row for each source of the documents; its hosts follow from its key."""
    s = read_table(spark, d, "documents", "source_id").filter("source_id IS NOT NULL").distinct()
    site = F.concat(F.split_part("source_id", F.lit("_"), F.lit(2)), F.lit("."), F.split_part("source_id", F.lit("_"), F.lit(1)), F.lit("-kutato.example"))
    return s.select("source_id", site.alias("host"), F.array(F.concat(F.lit("m."), site)).alias("verified"), F.array(F.concat(F.lit("archivum."), site)).alias("inferred"), (F.col("source_id") != "vt_kultura").alias("enabled"), (~F.startswith("source_id", F.lit("vt_"))).alias("in_run"), F.concat(F.split_part("source_id", F.lit("_"), F.lit(1)), F.lit("-kutato.example")).alias("suffix"))


@query(f"WITH {_REG} SELECT * FROM al")
def host_aliases(spark, d):
    """Every host of the registry with its canonical host and how certain that is."""
    return D.alias_table(registry(spark, d))


@query(f"""WITH {_REG}, h AS (SELECT DISTINCT {_HOST.format('u')} AS host FROM (SELECT final_url AS u FROM documents UNION ALL SELECT website FROM project UNION ALL SELECT website FROM org_units)) SELECT h.host, CASE WHEN r.host IS NOT NULL AND enabled THEN 'in_scope' WHEN r.host IS NOT NULL OR EXISTS (SELECT 1 FROM reg x WHERE h.host = x.suffix OR h.host LIKE '%.' || x.suffix) THEN 'other_unit_site' ELSE 'external' END AS scope, r.source_id AS owner,
  CASE WHEN r.host IS NOT NULL AND enabled THEN NULL WHEN r.host IS NOT NULL THEN 'source_not_enabled' WHEN EXISTS (SELECT 1 FROM reg x WHERE h.host = x.suffix OR h.host LIKE '%.' || x.suffix) THEN 'site_not_registered' ELSE 'external_host' END AS reason FROM h LEFT JOIN reg r ON r.host = h.host WHERE h.host IS NOT NULL""")
def host_scope(spark, d):
    """Scope of each host: own host of a source, else a suffix of an institution, else external."""
    u = read_table(spark, d, "documents", "final_url").select(F.col("final_url").alias("u")).unionByName(read_table(spark, d, "project", "website").select(F.col("website").alias("u"))).unionByName(read_table(spark, d, "org_units", "website").select(F.col("website").alias("u")))
    return D.host_scopes(u.select(urls.host(F.col("u")).alias("host")), registry(spark, d))


_LINKS = """li AS (SELECT DISTINCT canonical_url AS url, url AS stated, source_id AS via FROM documents WHERE canonical_url IS NOT NULL AND url IS NOT NULL UNION SELECT website, website, split_part(source_refs[1], '|', 1) FROM project WHERE website IS NOT NULL UNION SELECT DISTINCT final_url, final_url, source_id FROM documents WHERE final_url IS NOT NULL)"""
_FR = f"""{_REG}, {_LINKS}, st AS (SELECT url, stated, via, coalesce(al.status, 'unknown') AS status FROM (SELECT *, {_HOST.format('stated')} AS sh FROM li) LEFT JOIN al ON al.host = sh),
  pu AS (SELECT url, CASE WHEN bool_or(status = 'inferred') THEN 'inferred' WHEN bool_or(status = 'unknown') THEN 'unknown' WHEN bool_or(status = 'verified') THEN 'verified' ELSE 'canonical' END AS host_status, bool_or(status IN ('canonical','verified')) AS trusted, count(DISTINCT stated) AS n_stated, count(DISTINCT via) AS n_via, any_value({_HOST.format('url')}) AS host FROM st GROUP BY url),
  sc AS (SELECT pu.*, CASE WHEN r.host IS NOT NULL AND enabled THEN 'in_scope' WHEN r.host IS NOT NULL OR EXISTS (SELECT 1 FROM reg x WHERE pu.host = x.suffix OR pu.host LIKE '%.' || x.suffix) THEN 'other_unit_site' ELSE 'external' END AS scope, r.source_id AS owner, r.enabled AS en, r.in_run FROM pu LEFT JOIN reg r ON r.host = pu.host),
  ok AS (SELECT DISTINCT canonical_url AS url FROM documents WHERE http_status < 400 AND canonical_url IS NOT NULL),
  why AS (SELECT sc.*, ok.url IS NOT NULL AS there, CASE WHEN NOT regexp_matches(sc.url, '^https?://') THEN 'not_http' WHEN scope <> 'in_scope' THEN CASE WHEN owner IS NOT NULL THEN 'source_not_enabled' WHEN scope = 'other_unit_site' THEN 'site_not_registered' ELSE 'external_host' END
     WHEN host_status = 'inferred' AND NOT trusted THEN 'alias_unverified' WHEN NOT coalesce(in_run, false) THEN 'owner_not_in_run' WHEN NOT regexp_matches(sc.url, '^https?://[^/]+/(projekt/)?[^/]+$') THEN 'not_project_path' END AS reason FROM sc LEFT JOIN ok USING (url)),
  fr AS (SELECT url, host, scope, owner, host_status, CASE WHEN reason IS NOT NULL THEN 'skipped' WHEN there THEN 'already_fetched' ELSE 'enqueued' END AS decision, reason, n_stated, n_via FROM why)"""


def frontier(spark, d):
    t = read_table(spark, d, "documents", "canonical_url", "url", "final_url", "source_id", "http_status")
    p = read_table(spark, d, "project", "website", "source_refs").filter("website IS NOT NULL").select(F.col("website").alias("url"), F.col("website").alias("stated"), F.split_part(F.try_element_at("source_refs", F.lit(1)), F.lit("|"), F.lit(1)).alias("via"))
    links = t.filter("canonical_url IS NOT NULL AND url IS NOT NULL").select(F.col("canonical_url").alias("url"), F.col("url").alias("stated"), F.col("source_id").alias("via")).unionByName(p)
    links = links.unionByName(t.filter("final_url IS NOT NULL").select(F.col("final_url").alias("url"), F.col("final_url").alias("stated"), F.col("source_id").alias("via"))).distinct()
    ok = t.filter("http_status < 400 AND canonical_url IS NOT NULL").select(F.col("canonical_url").alias("url"))
    return D.route(links, registry(spark, d), ok, F.col("url").rlike("^https?://[^/]+/(projekt/)?[^/]+$"))


@query(f"WITH {_FR} SELECT * FROM fr")
def frontier_routing(spark, d):
    """What becomes of every linked address and why."""
    return frontier(spark, d)


@query(f"WITH {_FR} SELECT decision || CASE WHEN reason IS NULL THEN '' ELSE ':' || reason END AS outcome, scope, count(*) AS n FROM fr GROUP BY 1, 2")
def frontier_counts(spark, d):
    return frontier(spark, d).groupBy(F.concat("decision", F.when(F.col("reason").isNull(), "").otherwise(F.concat(F.lit(":"), "reason"))).alias("outcome"), "scope").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_FR}, pr AS (SELECT DISTINCT canonical_id, website AS url FROM project), fin AS (SELECT DISTINCT url, final_url FROM documents WHERE url <> final_url) SELECT pr.canonical_id, pr.url, CASE WHEN pr.url IS NULL THEN 'title_only_no_page_link' WHEN ok.url IS NOT NULL THEN 'fetched' WHEN fr.url IS NULL THEN 'no_discovery_record' WHEN decision = 'skipped' THEN CASE scope WHEN 'external' THEN 'external_site' WHEN 'other_unit_site' THEN 'other_unit_site' ELSE 'not_followed:' || reason END ELSE 'not_fetched' END AS status
  FROM pr LEFT JOIN ok USING (url) LEFT JOIN fr ON fr.url = pr.url""")
def link_status(spark, d):
    """What became of the page each project names: fetched, followed or not and why, or no link at all."""
    f = frontier(spark, d).select("url", "decision", "reason", "scope")
    ok = read_table(spark, d, "documents", "canonical_url", "http_status").filter("http_status < 400 AND canonical_url IS NOT NULL").select(F.col("canonical_url").alias("url"), F.lit(True).alias("ok")).distinct()
    p = read_table(spark, d, "project", "canonical_id", "website").select("canonical_id", F.col("website").alias("url")).distinct()
    j = p.join(ok, "url", "left").join(f, "url", "left")
    skipped = F.when(F.col("scope") == "external", "external_site").when(F.col("scope") == "other_unit_site", "other_unit_site").otherwise(F.concat(F.lit("not_followed:"), "reason"))
    status = F.when(F.col("url").isNull(), "title_only_no_page_link").when(F.col("ok"), "fetched").when(F.col("decision").isNull(), "no_discovery_record").when(F.col("decision") == "skipped", skipped).otherwise("not_fetched")
    return j.select("canonical_id", "url", status.alias("status"))


@query("""WITH l AS (SELECT * FROM documents WHERE source_id IS NOT NULL AND canonical_url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_id, canonical_url ORDER BY retrieved_at DESC NULLS LAST, doc_id) = 1)
  SELECT coalesce(source_id, 'all') AS source, coalesce(source_type, 'all') AS page_type, count(*) AS urls, count(*) FILTER (http_status < 400) AS ok, count(*) FILTER (http_status >= 400) AS failed, count(*) FILTER (http_status < 400 AND url <> canonical_url) AS redirected FROM l GROUP BY GROUPING SETS ((source_id, source_type), ())""")
def fetch_coverage(spark, d):
    """Latest retrieval of each address by source and kind of page, with the total."""
    t = read_table(spark, d, "documents", "source_id", "canonical_url", "retrieved_at", "doc_id", "source_type", "http_status", "url").filter("source_id IS NOT NULL AND canonical_url IS NOT NULL")
    latest = best_row(t, ["source_id", "canonical_url"], F.desc_nulls_last("retrieved_at"), F.asc("doc_id"))
    g = latest.groupingSets([[F.col("source_id"), F.col("source_type")], []], "source_id", "source_type").agg(F.count(F.lit(1)).alias("urls"), F.count_if(F.col("http_status") < 400).alias("ok"), F.count_if(F.col("http_status") >= 400).alias("failed"), F.count_if((F.col("http_status") < 400) & (F.col("url") != F.col("canonical_url"))).alias("redirected"))
    return g.select(F.coalesce("source_id", F.lit("all")).alias("source"), F.coalesce("source_type", F.lit("all")).alias("page_type"), "urls", "ok", "failed", "redirected")


@query("""SELECT count(*) AS documents, count(DISTINCT document_id) AS distinct_documents, strftime(min(retrieved_at) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(retrieved_at) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS last_at, count(DISTINCT source_id) AS sources FROM documents""")
def source_set(spark, d):
    """The universe of documents a release is built from; its digest is ``source_set_digest``."""
    t = read_table(spark, d, "documents", "document_id", "retrieved_at", "source_id")
    s = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return t.agg(F.count(F.lit(1)).alias("documents"), F.countDistinct("document_id").alias("distinct_documents"), s(F.min("retrieved_at")).alias("first_at"), s(F.max("retrieved_at")).alias("last_at"), F.countDistinct("source_id").alias("sources"))


@query(f"""WITH {_MEM}, u AS (SELECT DISTINCT canonical_id AS p, split_part(r, '|', 1) AS site FROM (SELECT canonical_id, unnest(source_refs) AS r FROM person)), e AS (SELECT DISTINCT person FROM m) SELECT coalesce(site, 'all') AS site, count(*) AS people, count(*) FILTER (e.person IS NULL) AS without_project, CAST(round(1000 * count(*) FILTER (e.person IS NULL) / count(*)) AS BIGINT) AS per_mille FROM u LEFT JOIN e ON e.person = u.p GROUP BY GROUPING SETS ((site), ())""")
def network_gaps(spark, d):
    """People without a project edge by site: gaps of the network that coverage makes."""
    u = read_table(spark, d, "person", "canonical_id", "source_refs").select(F.col("canonical_id").alias("person"), F.explode("source_refs").alias("r")).select("person", F.split_part("r", F.lit("|"), F.lit(1)).alias("site")).distinct()
    e = membership(spark, d).select("person").distinct().withColumn("has", F.lit(True))
    j = u.join(e, "person", "left")
    g = j.groupingSets([[F.col("site")], []], "site").agg(F.count(F.lit(1)).alias("people"), F.count_if(F.col("has").isNull()).alias("without_project"))
    return g.select(F.coalesce("site", F.lit("all")).alias("site"), "people", "without_project", F.round(1000 * F.col("without_project") / F.col("people")).cast("bigint").alias("per_mille"))


@query(f"""WITH {_MEM}, t AS (SELECT DISTINCT a.person AS a, b.person AS b FROM m a JOIN m b ON a.project = b.project AND a.person < b.person), c AS (SELECT DISTINCT subject.canonical_id AS p, document_id AS k FROM claims WHERE subject.entity_type = 'Person' AND predicate = 'profile_url' AND document_id NOT IN (SELECT document_id FROM documents WHERE document_id IS NOT NULL) AND subject.canonical_id IS NOT NULL),
  x AS (SELECT DISTINCT l.p AS a, r.p AS b FROM c l JOIN c r ON l.k = r.k AND l.p < r.p) SELECT count(*) AS pairs, count(*) FILTER ((a, b) NOT IN (SELECT (a, b) FROM t)) AS not_realised FROM x""")
def potential_ties(spark, d):
    """Pairs of people stated on one page that was never retrieved, and those that no project ties: an upper bound on missing ties."""
    docs = read_table(spark, d, "documents", "document_id").filter("document_id IS NOT NULL").distinct()
    c = read_table(spark, d, "claims", "subject", "predicate", "document_id").filter("subject.entity_type = 'Person' AND predicate = 'profile_url' AND subject.canonical_id IS NOT NULL AND document_id IS NOT NULL").select(F.col("subject.canonical_id").alias("p"), F.col("document_id")).distinct()
    c = cut(c.join(docs, "document_id", "left_anti"))
    x = c.alias("l").join(c.alias("r"), (F.col("l.document_id") == F.col("r.document_id")) & (F.col("l.p") < F.col("r.p"))).select(F.col("l.p").alias("a"), F.col("r.p").alias("b")).distinct()
    t = G.ties(membership(spark, d)).select("a", "b", F.lit(True).alias("tied"))
    return x.join(t, ["a", "b"], "left").agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("tied").isNull()).alias("not_realised"))


@query(f"""WITH {_REG} SELECT 'source without host' AS problem, count(*) FILTER (host IS NULL) AS n FROM reg UNION ALL SELECT 'host of two sources', count(*) FROM (SELECT host FROM reg GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'unit without known institution', count(*) FROM org_units u WHERE entity_type = 'OrganisationalUnit' AND NOT EXISTS (SELECT 1 FROM (SELECT unnest(source_refs) AS r, canonical_id FROM org_units) x JOIN reg ON reg.source_id = split_part(x.r, '|', 1) WHERE x.canonical_id = u.canonical_id)
  UNION ALL SELECT 'duplicate unit id', count(*) FROM (SELECT canonical_id FROM org_units WHERE canonical_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""")
def registry_checks(spark, d):
    """Unique hosts and ids, known sources of every unit."""
    reg = cut(registry(spark, d))
    u = read_table(spark, d, "org_units", "canonical_id", "entity_type", "source_refs")
    known = u.select("canonical_id", F.explode("source_refs").alias("r")).withColumn("source_id", F.split_part("r", F.lit("|"), F.lit(1))).join(reg.select("source_id"), "source_id", "left_semi").select("canonical_id").distinct()
    n = lambda name, df: df.agg(F.lit(name).alias("problem"), F.count(F.lit(1)).alias("n"))
    many = lambda df, c: df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    parts = [n("source without host", reg.filter("host IS NULL")), n("host of two sources", many(reg, "host")), n("unit without known institution", u.filter("entity_type = 'OrganisationalUnit'").join(known, "canonical_id", "left_anti")), n("duplicate unit id", many(u, "canonical_id"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES, ORACLES = R.queries, R.oracles
