"""Centrality and communities of the co-participation network, mentions and anchors."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.operators import centrality
from loomgraph.operators import graph as G
from loomgraph.plans.graphs import membership
from loomgraph.plans.registry import Registry
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query


def _ties(spark, d):
    return G.ties(membership(spark, d)).select(F.col("a").alias("src"), F.col("b").alias("dst"))


@query()
def betweenness(spark, d):
    return centrality.betweenness(_ties(spark, d))


@query("""SELECT c.subject.source_ref AS source_ref, d.url AS page_url, count(*) AS n_claims, min(c.observed_at IS NULL)::INT AS undated, string_agg(DISTINCT c.predicate, ',' ORDER BY c.predicate) AS predicates
  FROM (SELECT DISTINCT claim_id, subject, predicate, document_id, observed_at FROM claims) c JOIN (SELECT document_id, min(url) AS url FROM documents GROUP BY 1) d ON d.document_id = c.document_id
  WHERE c.subject.source_ref IS NOT NULL AND d.url IS NOT NULL AND split_part(c.subject.source_ref, '|', 2) <> d.url GROUP BY 1, 2""")
def mention_observations(spark, d):
    """References seen on pages other than their own: claims by (reference, page)."""
    c = read_table(spark, d, "claims", "claim_id", "subject", "predicate", "document_id", "observed_at").select("claim_id", F.col("subject.source_ref").alias("source_ref"), F.col("subject.canonical_id").alias("sid"), "predicate", "document_id", "observed_at", "subject").distinct()
    docs = read_table(spark, d, "documents", "document_id", "url").groupBy("document_id").agg(F.min("url").alias("page_url"))
    j = c.join(docs, "document_id").filter("source_ref IS NOT NULL AND page_url IS NOT NULL").filter(F.split_part("source_ref", F.lit("|"), F.lit(2)) != F.col("page_url"))
    return j.groupBy("source_ref", "page_url").agg(F.count(F.lit(1)).alias("n_claims"), F.min(F.col("observed_at").isNull().cast("int")).alias("undated"), F.array_join(F.array_sort(F.collect_set("predicate")), ",").alias("predicates"))


@query("""WITH a AS (SELECT canonical_id, 'profile_url' AS anchor FROM (SELECT canonical_id, unnest(profile_urls) AS u FROM person) WHERE u IS NOT NULL UNION SELECT canonical_id, 'orcid' FROM person WHERE orcid IS NOT NULL
  UNION SELECT canonical_id, 'mtmt_id' FROM person WHERE mtmt_id IS NOT NULL UNION SELECT canonical_id, e FROM (SELECT canonical_id, unnest(identity_evidence) AS e FROM person) WHERE e IS NOT NULL)
  SELECT canonical_id, string_agg(anchor, ',' ORDER BY anchor) AS anchors FROM a GROUP BY 1""")
def identity_anchors(spark, d):
    """What makes each person record an identity: one scan, a set of kinds."""
    p = read_table(spark, d, "person", "canonical_id", "profile_urls", "orcid", "mtmt_id", "identity_evidence")
    kinds = F.array(
        F.when(F.size(F.filter("profile_urls", lambda u: u.isNotNull())) > 0, "profile_url"), F.when(F.col("orcid").isNotNull(), "orcid"), F.when(F.col("mtmt_id").isNotNull(), "mtmt_id")
    )
    rows = p.select("canonical_id", F.explode(F.concat(kinds, F.coalesce("identity_evidence", F.array().cast("array<string>")))).alias("k")).filter("k IS NOT NULL")
    return rows.groupBy("canonical_id").agg(F.array_join(F.array_sort(F.collect_set("k")), ",").alias("anchors"))


@query("""WITH m AS (SELECT DISTINCT target_id AS project, source_id AS person FROM relations WHERE type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF') AND source_id IS NOT NULL AND target_id IS NOT NULL),
  z AS (SELECT project, count(*) AS n FROM m GROUP BY 1) SELECT n AS size, count(*) AS projects FROM z GROUP BY 1""")
def degree_frequencies(spark, d):
    z = membership(spark, d).groupBy("project").agg(F.count(F.lit(1)).alias("size"))
    return z.groupBy("size").agg(F.count(F.lit(1)).alias("projects"))


@query("""WITH c AS (SELECT DISTINCT claim_id, derived_from, confidence, epistemic_status FROM claims) SELECT 'derived_without_source' AS finding, count(*) AS n FROM c WHERE epistemic_status <> 'OBSERVED' AND coalesce(len(derived_from), 0) = 0
  UNION ALL SELECT 'observed_with_source', count(*) FROM c WHERE epistemic_status = 'OBSERVED' AND len(derived_from) > 0 UNION ALL SELECT 'no_confidence', count(*) FROM c WHERE confidence IS NULL""")
def provenance_checks(spark, d):
    c = read_table(spark, d, "claims", "claim_id", "derived_from", "confidence", "epistemic_status").distinct()
    n = F.coalesce(F.size("derived_from"), F.lit(0))
    n = F.when(F.col("derived_from").isNull(), 0).otherwise(n)
    found = F.array_compact(F.array(
        F.when((F.col("epistemic_status") != "OBSERVED") & (n == 0), "derived_without_source"), F.when((F.col("epistemic_status") == "OBSERVED") & (n > 0), "observed_with_source"), F.when(F.col("confidence").isNull(), "no_confidence")))
    names = F.array(*map(F.lit, ["derived_without_source", "observed_with_source", "no_confidence"]))
    flat = c.select(found.alias("f")).agg(*[F.count_if(F.array_contains("f", x)).alias(x) for x in ["derived_without_source", "observed_with_source", "no_confidence"]])
    return flat.select(F.explode(F.arrays_zip(names.alias("finding"), F.array("derived_without_source", "observed_with_source", "no_confidence").alias("n"))).alias("z")).select("z.finding", "z.n")


QUERIES, ORACLES = R.queries, R.oracles
