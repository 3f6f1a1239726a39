"""Queries of smaller reports: nodes with provenance, ranked candidates, reasons, outcomes, page maps, participants, duplicates, edge evidence."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomgraph.functions import text, urls
from loomgraph.operators import canonical as K
from loomgraph.operators import mentions as M
from loomgraph.operators.skew import salted_join
from loomgraph.plans.canon import _C, _FIELDS, resolved
from loomgraph.plans.graphs import _SITE, sites
from loomgraph.plans.identity import _FREE, _PDEC, _PEOPLE, _person_signals, key_sql, people, person_decisions
from loomgraph.plans.registry import Registry
from loomgraph.plans.structure import _REL, _TOP, relations, unit_tops
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query


@query(f"""WITH {_C}, {_FIELDS} SELECT sid AS canonical_id, t AS entity_type, string_agg(f || '=' || ids, ';' ORDER BY f) AS provenance, coalesce(string_agg(f || '=' || conflicts, ';' ORDER BY f) FILTER (conflicts IS NOT NULL), '') AS conflicts, count(conflicts) > 0 AS has_conflicts,
  coalesce(lower(strip_accents(string_agg(value, ' ' ORDER BY f) FILTER (f IN ('canonical_name','alternate_names','title','alternate_titles')))), '') AS search_text FROM ef GROUP BY 1, 2""")
def entity_nodes(spark, d):
    """Node properties of entities: which claims stand behind each field, what disagrees, and a folded search text."""
    f = K.entity_fields(resolved(spark, d))
    joined = lambda when, value: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("field", value.alias("v"))))), lambda x: F.concat(x["field"], F.lit("="), x["v"])), ";")
    named = F.col("field").isin("canonical_name", "alternate_names", "title", "alternate_titles")
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(named, F.struct("field", "value")))), lambda x: x["value"]), " ")
    return f.groupBy(F.col("subject_id").alias("canonical_id"), "entity_type").agg(
        joined(F.lit(True), F.array_join("claim_ids", ",")).alias("provenance"), joined(F.col("conflicts").isNotNull(), F.col("conflicts")).alias("conflicts"), (F.count("conflicts") > 0).alias("has_conflicts"), F.lower(text.strip_accents(words)).alias("search_text"))


_STRONG = M.FULL_NAME + M.SLUG_SIGNALS + ["OWN_PROFILE_LISTS_PROJECT", "SOURCE_UNIT_MEMBER", "SAME_INSTITUTE", "UNIQUE_NAME_IN_FAMILY"]
_Q = lambda xs: ",".join(f"'{x}'" for x in xs)


@query(f"{_PDEC} SELECT mention, person_id, CAST(row_number() OVER (PARTITION BY mention ORDER BY rejected, NOT viable, len(list_intersect(sg, [{_Q(_STRONG)}])) DESC, len(sg) DESC, person_id) AS INT) AS place FROM v")
def ranked_candidates(spark, d):
    """Candidates of each mention in order: not rejected, viable, most strong signals, most signals, id."""
    _, _, s = _person_signals(spark, d)
    strong = F.size(F.array_intersect("signals", F.array(*map(F.lit, _STRONG))))
    w = Window.partitionBy("mention").orderBy("rejected", (~M.person_viable()).cast("int"), strong.desc(), F.size("signals").desc(), "person_id")
    return s.select("mention", "person_id", F.row_number().over(w).alias("place"))


@query(f"""{_PDEC} SELECT CASE WHEN reason IS NULL THEN 'decided' WHEN starts_with(reason, 'blocked') THEN 'blocked' WHEN contains(reason, 'viable candidates') THEN 'several candidates' WHEN starts_with(reason, 'only weak') THEN 'weak evidence' WHEN starts_with(reason, 'no rule') THEN 'no rule' WHEN starts_with(reason, 'every') THEN 'rejected' ELSE 'no candidate' END AS reason_class,
  CASE WHEN status IN ('MANUAL_CONFIRMED','DETERMINISTIC') THEN 'certain' WHEN status = 'HIGH_CONFIDENCE_AUTO' THEN 'resolved' ELSE 'outside' END AS standing, count(*) AS n FROM dec GROUP BY 1, 2""")
def reason_classes(spark, d):
    """Why mentions are not resolved, in classes, beside their standing (certain, resolved, outside the graph)."""
    r = F.col("reason")
    kind = F.when(r.isNull(), "decided").when(F.startswith(r, F.lit("blocked")), "blocked").when(F.contains(r, F.lit("viable candidates")), "several candidates").when(F.startswith(r, F.lit("only weak")), "weak evidence").when(F.startswith(r, F.lit("no rule")), "no rule").when(F.startswith(r, F.lit("every")), "rejected").otherwise("no candidate")
    standing = F.when(F.col("status").isin("MANUAL_CONFIRMED", "DETERMINISTIC"), "certain").when(F.col("status") == "HIGH_CONFIDENCE_AUTO", "resolved").otherwise("outside")
    return person_decisions(spark, d)[1].groupBy(kind.alias("reason_class"), standing.alias("standing")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, CASE WHEN http_status IS NULL THEN 'not fetched' WHEN http_status >= 400 THEN 'HTTP ' || http_status END AS error, coalesce(final_url <> url, false) AS redirected, CASE source_type WHEN 'institutional_profile' THEN 'person' WHEN 'project_page' THEN 'project' WHEN 'unit_page' THEN 'unit' WHEN 'institutional_listing' THEN 'listing' ELSE coalesce(source_type, 'unknown') END AS page_type FROM documents""")
def fetch_outcomes(spark, d):
    """Outcome and kind of page of every retrieval."""
    t = read_table(spark, d, "documents", "doc_id", "http_status", "final_url", "url", "source_type")
    kinds = F.create_map(*[F.lit(x) for kv in {"institutional_profile": "person", "project_page": "project", "unit_page": "unit", "institutional_listing": "listing"}.items() for x in kv])
    error = F.when(F.col("http_status").isNull(), "not fetched").when(F.col("http_status") >= 400, F.concat(F.lit("HTTP "), F.col("http_status").cast("string")))
    return t.select("doc_id", error.alias("error"), F.coalesce(F.col("final_url") != F.col("url"), F.lit(False)).alias("redirected"), F.coalesce(F.try_element_at(kinds, F.col("source_type")), "source_type", F.lit("unknown")).alias("page_type"))


@query("""SELECT page, count(DISTINCT canonical_id) AS projects, min(canonical_id) AS project FROM (SELECT canonical_id, split_part(r, '|', 2) AS page FROM (SELECT canonical_id, unnest(source_refs) AS r FROM project)) WHERE regexp_matches(page, '^https?://') GROUP BY 1""")
def project_pages(spark, d):
    """Page address to project, with how many projects claim a page."""
    p = read_table(spark, d, "project", "canonical_id", "source_refs").select("canonical_id", F.explode("source_refs").alias("r")).select("canonical_id", urls.ref_url(F.col("r")).alias("page"))
    return p.filter("page IS NOT NULL").groupBy("page").agg(F.countDistinct("canonical_id").alias("projects"), F.min("canonical_id").alias("project"))


@query("""WITH c AS (SELECT object.canonical_id AS project, coalesce(subject.source_ref, 'id:' || subject.canonical_id) AS subj, subject.canonical_id AS sid, min(CASE WHEN subject.source_ref IN (SELECT unnest(source_refs) FROM person) THEN 0 WHEN extraction_method = 'manual_entry' THEN 1 ELSE 2 END) AS strength FROM claims
    WHERE predicate = 'PARTICIPATES_IN' AND object.canonical_id IS NOT NULL AND (subject.source_ref IS NOT NULL OR subject.canonical_id IS NOT NULL) GROUP BY 1, 2, 3) SELECT CASE strength WHEN 0 THEN 'anchored' WHEN 1 THEN 'curated' ELSE 'named only' END AS identified, count(*) AS statements, count(DISTINCT project) AS projects FROM c GROUP BY 1""")
def participant_subjects(spark, d):
    """Statements of taking part by how the subject was identified; one stated in several documents counts once, with its strongest identification."""
    refs = read_table(spark, d, "person", "source_refs").select(F.explode("source_refs").alias("ref")).filter("ref IS NOT NULL").distinct().withColumn("anchored", F.lit(True))
    c = read_table(spark, d, "claims", "predicate", "subject", "object", "extraction_method").filter("predicate = 'PARTICIPATES_IN' AND object.canonical_id IS NOT NULL AND (subject.source_ref IS NOT NULL OR subject.canonical_id IS NOT NULL)")
    c = c.select(F.col("object.canonical_id").alias("project"), F.col("subject.source_ref").alias("ref"), F.col("subject.canonical_id").alias("sid"), "extraction_method")
    j = salted_join(c, refs, "ref")
    strength = F.when(F.col("anchored"), 0).when(F.col("extraction_method") == "manual_entry", 1).otherwise(2)
    per = j.groupBy("project", F.coalesce("ref", F.concat(F.lit("id:"), "sid")).alias("subj"), "sid").agg(F.min(strength).alias("s"))
    return per.groupBy(F.when(F.col("s") == 0, "anchored").when(F.col("s") == 1, "curated").otherwise("named only").alias("identified")).agg(F.count(F.lit(1)).alias("statements"), F.countDistinct("project").alias("projects"))


@query(f"""WITH {_PEOPLE}, a AS (SELECT 'person name' AS kind, {_FREE.format(key_sql('label'))} AS key, canonical_id FROM people WHERE label IS NOT NULL UNION SELECT 'orcid', orcid, canonical_id FROM person WHERE orcid IS NOT NULL UNION SELECT 'mtmt', mtmt_id, canonical_id FROM person WHERE mtmt_id IS NOT NULL UNION SELECT 'project title', trim(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', ' ', 'g')), canonical_id FROM project WHERE title IS NOT NULL
  UNION SELECT 'grant', nullif(regexp_extract(regexp_replace(grant_id, '[\\s.]', '', 'g'), '(\\d{{4,}})', 1), ''), canonical_id FROM project) SELECT kind, key, count(*) AS ids, min(canonical_id) AS first_id FROM a WHERE key IS NOT NULL AND key <> '' GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_report(spark, d):
    """Keys that several entities share: names, hard ids, titles, grants."""
    free = F.array_join(F.array_sort(F.split(text.name_key(F.col("label")), " ")), " ")
    row = lambda kind, df, key: df.select(F.lit(kind).alias("kind"), key.alias("key"), "canonical_id")
    per, pro = read_table(spark, d, "person", "canonical_id", "orcid", "mtmt_id"), read_table(spark, d, "project", "canonical_id", "title", "grant_id")
    number = F.regexp_extract(F.regexp_replace("grant_id", r"[\s.]", ""), r"(\d{4,})", 1)
    parts = [row("person name", people(spark, d, "label"), free), row("orcid", per, F.col("orcid")), row("mtmt", per, F.col("mtmt_id")), row("project title", pro, text.title_fold(F.col("title"))), row("grant", pro, number)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("key IS NOT NULL AND key <> ''").distinct().groupBy("kind", "key").agg(F.count(F.lit(1)).alias("ids"), F.min("canonical_id").alias("first_id")).filter("ids > 1")


@query("""WITH k AS (SELECT claim_id, min(document_id) AS doc, min(epistemic_status) AS st FROM claims WHERE claim_id IS NOT NULL GROUP BY 1), e AS (SELECT DISTINCT relation_id, type, unnest(claim_ids) AS c FROM relations WHERE relation_id IS NOT NULL), g AS (SELECT relation_id, type, count(*) AS claims, count(k.claim_id) AS held, count(DISTINCT doc) AS docs, count(*) FILTER (st = 'OBSERVED') AS observed FROM e LEFT JOIN k ON k.claim_id = c GROUP BY 1, 2)
  SELECT type, count(*) AS edges, count(*) FILTER (held < claims) AS with_missing_claims, count(*) FILTER (docs >= 2) AS by_several_documents, count(*) FILTER (observed = 0) AS derived_only, CAST(sum(claims) AS BIGINT) AS claims FROM g GROUP BY 1""")
def edge_provenance(spark, d):
    """How well edges are supported: claims that exist, several documents, anything observed."""
    k = read_table(spark, d, "claims", "claim_id", "document_id", "epistemic_status").filter("claim_id IS NOT NULL").groupBy("claim_id").agg(F.min("document_id").alias("doc"), F.min("epistemic_status").alias("st"), F.lit(True).alias("held"))
    e = read_table(spark, d, "relations", "relation_id", "type", "claim_ids").filter("relation_id IS NOT NULL").select("relation_id", "type", F.explode("claim_ids").alias("claim_id")).distinct()
    g = e.join(k, "claim_id", "left").groupBy("relation_id", "type").agg(F.count(F.lit(1)).alias("claims"), F.count("held").alias("held"), F.countDistinct("doc").alias("docs"), F.count_if(F.col("st") == "OBSERVED").alias("observed"))
    return g.groupBy("type").agg(F.count(F.lit(1)).alias("edges"), F.count_if(F.col("held") < F.col("claims")).alias("with_missing_claims"), F.count_if(F.col("docs") >= 2).alias("by_several_documents"), F.count_if(F.col("observed") == 0).alias("derived_only"), F.sum("claims").alias("claims"))


@query(f"""WITH RECURSIVE {_REL}, {_TOP}, {_SITE}, g AS (SELECT person, min(site) AS site, count(DISTINCT site) AS n FROM s GROUP BY 1), u AS (SELECT source_id AS person, min(top) AS top FROM r JOIN tops ON node = target_id WHERE type IN ('AFFILIATED_WITH','MEMBER_OF') GROUP BY 1), p AS (SELECT DISTINCT canonical_id AS person FROM person)
  SELECT p.person, CASE WHEN n > 1 THEN 'multi' ELSE coalesce(site, 'other') END AS site_group, coalesce(top, 'none') AS top_unit FROM p LEFT JOIN g USING (person) LEFT JOIN u USING (person)""")
def node_groups(spark, d):
    """The group of every person for display: its site (``multi`` for several) and the top unit it belongs to."""
    p = read_table(spark, d, "person", "canonical_id").select(F.col("canonical_id").alias("person")).distinct()
    g = sites(spark, d).groupBy("person").agg(F.min("site").alias("site"), F.countDistinct("site").alias("n"))
    u = relations(spark, d, "AFFILIATED_WITH", "MEMBER_OF").select(F.col("source_id").alias("person"), F.col("target_id").alias("node")).join(unit_tops(spark, d), "node").groupBy("person").agg(F.min("top").alias("top"))
    j = p.join(g, "person", "left").join(u, "person", "left")
    return j.select("person", F.when(F.col("n") > 1, "multi").otherwise(F.coalesce("site", F.lit("other"))).alias("site_group"), F.coalesce("top", F.lit("none")).alias("top_unit"))


QUERIES, ORACLES = R.queries, R.oracles
