"""Queries of the canonical build: sides, relations, fields, entities, issues, contexts, derived and curated claims."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import text
from loomgraph.operators import canonical as K
from loomgraph.plans.registry import Registry
from loomgraph.session import cut
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query

_COLUMNS = ["claim_id", "subject", "predicate", "value", "object", "qualifiers", "valid_from", "valid_until", "temporal_basis", "observed_at", "document_id", "locator", "epistemic_status", "assertion_type", "derivation_method", "confidence"]
_stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
_T = lambda c: f"strftime({c} AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')"

_C = """c0 AS (SELECT * FROM claims WHERE claim_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY observed_at DESC NULLS LAST, confidence DESC NULLS LAST, document_id NULLS LAST) = 1),
  rf AS (SELECT ref, min(canonical_id) AS id FROM (SELECT unnest(source_refs) AS ref, canonical_id FROM person UNION ALL SELECT unnest(source_refs), canonical_id FROM project UNION ALL SELECT unnest(source_refs), canonical_id FROM org_units) WHERE ref IS NOT NULL GROUP BY 1),
  c AS (SELECT c0.*, coalesce(c0.subject.canonical_id, a.id) AS sid, coalesce(c0.object.canonical_id, b.id) AS oid, CASE WHEN c0.subject.canonical_id IS NOT NULL THEN 'explicit' WHEN a.id IS NOT NULL THEN 'mapped' ELSE 'open' END AS basis FROM c0 LEFT JOIN rf a ON a.ref = c0.subject.source_ref LEFT JOIN rf b ON b.ref = c0.object.source_ref)"""


def ref_ids(spark, d):
    """(ref, canonical_id) of every source record, the least id where several claim one."""
    refs = None
    for t in ("person", "project", "org_units"):
        r = read_table(spark, d, t, "source_refs", "canonical_id").select(F.explode("source_refs").alias("ref"), "canonical_id")
        refs = r if refs is None else refs.unionByName(r)
    return refs.filter("ref IS NOT NULL").groupBy("ref").agg(F.min("canonical_id").alias("canonical_id"))


def resolved(spark, d):
    return cut(K.resolve_sides(K.latest_claims(read_table(spark, d, "claims", *_COLUMNS)), ref_ids(spark, d)))


@query(f"WITH {_C} SELECT claim_id, sid AS subject_id, oid AS object_id, basis AS subject_basis FROM c")
def claim_sides(spark, d):
    """Both ends of every claim: an explicit id wins over what the reference maps to."""
    return K.resolve_sides(K.latest_claims(read_table(spark, d, "claims", *_COLUMNS)), ref_ids(spark, d)).select("claim_id", "subject_id", "object_id", "subject_basis")


_ST = "CASE {0} WHEN 'OBSERVED' THEN 0 WHEN 'DERIVED' THEN 1 WHEN 'INFERRED' THEN 2 WHEN 'INTERPRETIVE' THEN 3 ELSE 4 END"
_RELS = f"""rl AS (SELECT 'rel_' || substr(sha256('["' || predicate || '", "' || sid || '", "' || oid || '"]'), 1, 16) AS relation_id, predicate, sid, oid, min(valid_from) FILTER (temporal_basis = 'EXPLICIT') AS valid_from,
    CASE WHEN count(*) FILTER (temporal_basis = 'EXPLICIT') = count(valid_until) FILTER (temporal_basis = 'EXPLICIT') THEN max(valid_until) FILTER (temporal_basis = 'EXPLICIT') END AS valid_until,
    CASE WHEN bool_or(temporal_basis = 'EXPLICIT') THEN 'EXPLICIT' WHEN bool_or(temporal_basis = 'OBSERVED_AT') THEN 'OBSERVED_AT' ELSE 'UNKNOWN' END AS temporal_basis, {_T('min(observed_at)')} AS first_at, {_T('max(observed_at)')} AS last_at,
    arg_min(epistemic_status, {_ST.format('epistemic_status')}) AS epistemic_status, max(confidence) AS confidence, coalesce(string_agg(DISTINCT assertion_type, ',' ORDER BY assertion_type), '') AS assertion_types, coalesce(string_agg(DISTINCT derivation_method, '; ' ORDER BY derivation_method), '') AS derivation_method,
    string_agg(DISTINCT claim_id, ',' ORDER BY claim_id) AS claim_ids, coalesce(string_agg(DISTINCT document_id, ',' ORDER BY document_id), '') AS document_ids FROM c WHERE object IS NOT NULL AND sid IS NOT NULL AND oid IS NOT NULL AND sid <> oid GROUP BY predicate, sid, oid)"""


@query(f"""WITH {_C}, {_RELS}, q AS (SELECT predicate, sid, oid, qualifiers['role'] AS role, min((observed_at IS NULL, observed_at, claim_id)) AS o FROM c WHERE object IS NOT NULL AND qualifiers['role'] IS NOT NULL AND sid <> oid GROUP BY ALL),
  ro AS (SELECT predicate, sid, oid, string_agg(role, '|' ORDER BY o) AS roles FROM q GROUP BY ALL) SELECT rl.* EXCLUDE (sid, oid), rl.sid AS source_id, rl.oid AS target_id, coalesce(roles, '') AS roles FROM rl LEFT JOIN ro USING (predicate, sid, oid)""")
def canonical_relations(spark, d):
    """Relations with ids, intervals, roles in order of observation, derivations, and the claims and documents behind them."""
    r = K.build_relations(resolved(spark, d))
    join = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return r.select("relation_id", "predicate", F.col("subject_id").alias("source_id"), F.col("object_id").alias("target_id"), "valid_from", "valid_until", "temporal_basis", _stamp("first_observed_at").alias("first_at"), _stamp("last_observed_at").alias("last_at"), "epistemic_status", "confidence",
                    join("assertion_types").alias("assertion_types"), "derivation_method", join("claim_ids").alias("claim_ids"), join("document_ids").alias("document_ids"), F.coalesce(F.array_join("roles", "|"), F.lit("")).alias("roles"))


_FMAP = ", ".join(f"('{t}', '{p}', '{f}', {str(m).lower()})" for t, preds in K.FIELDS.items() for p, (f, m) in preds.items())
_FIELDS = f"""fm(t, p, f, multi) AS (VALUES {_FMAP}), fc AS (SELECT sid, t, f, multi, value, claim_id, document_id, confidence, observed_at, locator FROM c JOIN fm ON t = c.subject.entity_type AND p = predicate WHERE object IS NULL AND value IS NOT NULL AND sid IS NOT NULL),
  dv AS (SELECT DISTINCT sid, t, f, value AS v FROM fc WHERE f IN ('start','end')), fin AS (SELECT a.sid, a.t, a.f, a.v, max(b.v) AS m FROM dv a JOIN dv b ON a.sid = b.sid AND a.t = b.t AND a.f = b.f AND starts_with(b.v, a.v || '-') GROUP BY ALL HAVING count(*) = 1),
  s1 AS (SELECT fc.* REPLACE (coalesce(m, value) AS value) FROM fc LEFT JOIN fin ON fin.sid = fc.sid AND fin.t = fc.t AND fin.f = fc.f AND fin.v = fc.value WHERE NOT multi),
  pv AS (SELECT sid, t, f, value, count(DISTINCT document_id) AS nd, row_number() OVER (PARTITION BY sid, t, f ORDER BY max(CASE WHEN locator IN ('profile.h1','unit.h1','project.h1') THEN 3 ELSE 0 END) DESC, count(DISTINCT document_id) DESC, max(confidence) DESC NULLS LAST, max(observed_at) DESC NULLS LAST, min(observed_at) NULLS LAST, min(claim_id)) AS place,
    list_sort(list_distinct(list(claim_id))) AS ids FROM s1 GROUP BY sid, t, f, value),
  o1 AS (SELECT sid, t, f, max(value) FILTER (place = 1) AS value, coalesce(string_agg(value, '|' ORDER BY place) FILTER (place > 1), '') AS rest, array_to_string(list_sort(list_distinct(flatten(list(ids)))), ',') AS ids FROM pv GROUP BY ALL),
  m1 AS (SELECT sid, t, f, value, min(observed_at) AS o, list(DISTINCT claim_id) AS ids FROM fc WHERE multi GROUP BY ALL),
  ef AS (SELECT sid, t, f, value, CASE WHEN f NOT IN ('canonical_name','title') THEN nullif(rest, '') END AS conflicts, ids FROM o1 UNION ALL SELECT sid, t, CASE f WHEN 'title' THEN 'alternate_titles' ELSE 'alternate_names' END, rest, NULL, ids FROM o1 WHERE f IN ('canonical_name','title') AND rest <> ''
    UNION ALL SELECT sid, t, f, string_agg(value, '|' ORDER BY o NULLS LAST, value), NULL, array_to_string(list_sort(list_distinct(flatten(list(ids)))), ',') FROM m1 GROUP BY sid, t, f)"""


@query(f"WITH {_C}, {_FIELDS} SELECT sid AS subject_id, t AS entity_type, f AS field, value, conflicts, ids AS claim_ids FROM ef")
def entity_fields(spark, d):
    """Each field of each entity: the chosen value, the values that disagree with it, and the claims behind all of them."""
    return K.entity_fields(resolved(spark, d)).withColumn("claim_ids", F.array_join("claim_ids", ","))


@query(f"WITH {_C}, {_FIELDS} SELECT sid AS subject_id, t AS entity_type, f AS field, value, place, count(*) OVER (PARTITION BY sid, t, f) AS n_values, nd AS n_documents FROM pv")
def ranked_conflicts(spark, d):
    """All values of single-valued fields with their place among the conflicting ones."""
    return K.ranked_values(K.field_claims(resolved(spark, d))).drop("claim_ids")


_ENT = f"""{_FIELDS}, e0 AS (SELECT sid, t, max(value) FILTER (f = CASE t WHEN 'Person' THEN 'canonical_name' ELSE 'title' END) AS label, count(*) AS n_fields, count(conflicts) AS n_conflicts FROM ef GROUP BY ALL),
  e1 AS (SELECT * FROM e0 WHERE label IS NOT NULL QUALIFY count(*) OVER (PARTITION BY sid) = 1), web AS (SELECT DISTINCT document_id FROM documents WHERE document_id IS NOT NULL AND url IS NOT NULL AND url NOT LIKE 'repo://%'),
  tm AS (SELECT sid, c.subject.entity_type AS t, min(observed_at) AS f0, max(observed_at) AS f1 FROM c JOIN web USING (document_id) WHERE object IS NULL AND sid IS NOT NULL GROUP BY ALL), nr AS (SELECT sid, count(DISTINCT c.subject.source_ref) AS n FROM c WHERE sid IS NOT NULL GROUP BY 1),
  ents AS (SELECT e1.sid AS canonical_id, e1.t AS entity_type, label, n_fields, n_conflicts, {_T('f0')} AS first_at, {_T('f1')} AS last_at, coalesce(n, 0) AS n_refs FROM e1 LEFT JOIN tm ON tm.sid = e1.sid AND tm.t = e1.t LEFT JOIN nr ON nr.sid = e1.sid)"""


@query(f"WITH {_C}, {_ENT} SELECT * FROM ents")
def canonical_entities(spark, d):
    """Entities with a label, their field and conflict counts and the span in which pages show them."""
    e = K.build_entities(resolved(spark, d), read_table(spark, d, "documents", "document_id", "url"))
    return e.select("canonical_id", "entity_type", "label", "n_fields", "n_conflicts", _stamp("first_observed_at").alias("first_at"), _stamp("last_verified_at").alias("last_at"), "n_refs")


_PREDICATES = ",".join(f"'{p}'" for preds in K.FIELDS.values() for p in preds)


@query(f"""WITH {_C}, {_RELS}, {_ENT}, ids AS (SELECT canonical_id AS id FROM ents UNION SELECT canonical_id FROM org_units WHERE canonical_id IS NOT NULL)
  SELECT 'unresolved_subject' AS "check", claim_id AS key FROM c WHERE sid IS NULL UNION SELECT 'unresolved_object', claim_id FROM c WHERE object IS NOT NULL AND sid IS NOT NULL AND oid IS NULL UNION SELECT 'self_loop_after_resolution', claim_id FROM c WHERE object IS NOT NULL AND sid = oid
  UNION SELECT 'unmapped_predicate', claim_id FROM c WHERE object IS NULL AND value IS NOT NULL AND predicate NOT IN ({_PREDICATES}) UNION SELECT 'entity_without_label', sid FROM c WHERE object IS NULL AND sid IS NOT NULL AND sid NOT IN (SELECT canonical_id FROM ents)
  UNION SELECT 'dangling_relation', relation_id FROM rl WHERE sid NOT IN (SELECT id FROM ids) OR oid NOT IN (SELECT id FROM ids)""")
def build_issues(spark, d):
    """What the build leaves out and why."""
    c = resolved(spark, d)
    units = read_table(spark, d, "org_units", "canonical_id").filter("canonical_id IS NOT NULL").select(F.col("canonical_id").alias("id"))
    return K.build_issues(c, cut(K.build_entities(c, read_table(spark, d, "documents", "document_id", "url"))), cut(K.build_relations(c)), units)


@query("""SELECT subject.source_ref AS source_ref, predicate AS relation, object.canonical_id AS target_id, coalesce(string_agg(DISTINCT qualifiers['role'], '|' ORDER BY qualifiers['role']), '') AS roles, min(valid_from) AS valid_from, max(valid_until) AS valid_until,
  arg_min(snippet, (observed_at IS NULL, observed_at, claim_id)) FILTER (snippet IS NOT NULL) AS snippet, count(*) AS n_claims FROM claims WHERE subject.source_ref IS NOT NULL AND object.canonical_id IS NOT NULL GROUP BY ALL""")
def mention_contexts(spark, d):
    """What pages say of each source record: relation, target, roles, span and the first snippet."""
    return K.contexts(read_table(spark, d, "claims", "claim_id", "subject", "predicate", "object", "qualifiers", "valid_from", "valid_until", "snippet", "observed_at"))


_FOLDED = "trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""WITH t AS (SELECT DISTINCT {_FOLDED.format('value')} AS term FROM claims WHERE predicate = 'research_area' AND value IS NOT NULL), c AS (SELECT DISTINCT claim_id, subject.canonical_id AS subject_id, predicate, confidence, ' ' || {_FOLDED.format('value')} || ' ' AS f FROM claims WHERE predicate IN ('title','position_title') AND value IS NOT NULL)
  SELECT subject_id, term, claim_id AS derived_from, 'DERIVED' AS epistemic_status, least(CASE predicate WHEN 'position_title' THEN 0.75 ELSE 0.6 END, confidence) AS confidence FROM c JOIN t ON contains(f, ' ' || term || ' ') WHERE term <> ''""")
def derived_topics(spark, d):
    """Stated research areas found in titles of projects and positions as derived claims, with a bounded confidence.

    By equi-join on runs of as many words as the term has, not by comparing every text with every term."""
    c = read_table(spark, d, "claims", "claim_id", "subject", "predicate", "value", "confidence").filter("value IS NOT NULL")
    terms = c.filter("predicate = 'research_area'").select(text.title_fold(F.col("value")).alias("term")).filter("term <> ''").distinct()
    longest = terms.agg(F.max(F.size(F.split("term", " ")))).first()[0] or 0
    rows = c.filter("predicate IN ('title', 'position_title')").select("claim_id", F.col("subject.canonical_id").alias("subject_id"), "predicate", "confidence", F.split(text.title_fold(F.col("value")), " ").alias("w")).distinct()
    n = F.size("w")
    runs = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), F.least(n - i + 1, F.lit(max(longest, 1)))), lambda k: F.array_join(F.slice("w", i, k), " ")))))
    found = rows.withColumn("term", F.explode(runs)).join(terms, "term")
    base = F.when(F.col("predicate") == "position_title", 0.75).otherwise(0.6)
    return found.select("subject_id", "term", F.col("claim_id").alias("derived_from"), F.lit("DERIVED").alias("epistemic_status"), F.least(base, F.col("confidence")).alias("confidence"))


@query("""SELECT subject_id, predicate, val, 'curated' AS extraction_method, 0.9 AS confidence FROM (SELECT canonical_id AS subject_id, 'name' AS predicate, canonical_name AS val FROM org_units UNION SELECT canonical_id, 'unit_type', unit_type FROM org_units UNION SELECT canonical_id, 'website', website FROM org_units UNION SELECT canonical_id, 'alternate_name', unnest(alternate_names) FROM org_units) WHERE val IS NOT NULL""")
def registry_claims(spark, d):
    """The rows of the unit registry as claims, one for each stated field."""
    u = read_table(spark, d, "org_units", "canonical_id", "canonical_name", "unit_type", "website", "alternate_names")
    fields = F.concat(
        F.array(*[F.struct(F.lit(p).alias("predicate"), F.col(c).alias("val")) for p, c in (("name", "canonical_name"), ("unit_type", "unit_type"), ("website", "website"))]),
        F.transform(F.coalesce("alternate_names", F.array().cast("array<string>")), lambda a: F.struct(F.lit("alternate_name").alias("predicate"), a.alias("val"))),
    )
    return u.select(F.col("canonical_id").alias("subject_id"), F.explode(fields).alias("f")).select("subject_id", "f.*", F.lit("curated").alias("extraction_method"), F.lit(0.9).alias("confidence")).filter("val IS NOT NULL").distinct()


@query("""WITH rf AS (SELECT DISTINCT unnest(source_refs) AS ref FROM person), me AS (SELECT DISTINCT r FROM (SELECT "left" AS r, entity_type FROM matches UNION ALL SELECT "right", entity_type FROM matches) WHERE entity_type = 'Person' AND r IS NOT NULL)
  SELECT (SELECT count(DISTINCT subject.source_ref) FROM claims WHERE subject.entity_type = 'Person') AS person_records, (SELECT count(DISTINCT canonical_id) FROM person) AS persons, (SELECT count(*) FROM me WHERE r NOT IN (SELECT ref FROM rf WHERE ref IS NOT NULL)) AS person_mentions, (SELECT count(DISTINCT value) FROM claims WHERE predicate = 'name') AS stated_names,
  (SELECT count(DISTINCT subject.source_ref) FROM claims WHERE subject.entity_type = 'Project') AS project_records, (SELECT count(DISTINCT canonical_id) FROM project) AS projects, (SELECT count(DISTINCT value) FROM claims WHERE predicate = 'title') AS stated_titles""")
def raw_and_canonical_counts(spark, d):
    """Source records and stated names beside canonical entities, for people and projects."""
    c = read_table(spark, d, "claims", "subject", "predicate", "value")
    of = lambda t: F.countDistinct(F.when(F.col("subject.entity_type") == t, F.col("subject.source_ref")))
    stated = lambda p: F.countDistinct(F.when(F.col("predicate") == p, F.col("value")))
    one = c.agg(of("Person").alias("person_records"), stated("name").alias("stated_names"), of("Project").alias("project_records"), stated("title").alias("stated_titles"))
    refs = read_table(spark, d, "person", "source_refs").select(F.explode("source_refs").alias("r")).filter("r IS NOT NULL").distinct()
    m = read_table(spark, d, "matches", "left", "right", "entity_type").filter("entity_type = 'Person'").select(F.explode(F.array("left", "right")).alias("r")).filter("r IS NOT NULL").distinct()
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    ids = lambda t: read_table(spark, d, t, "canonical_id").dropna().distinct()
    # single rows
    return one.crossJoin(count(ids("person"), "persons")).crossJoin(count(m.join(refs, "r", "left_anti"), "person_mentions")).crossJoin(count(ids("project"), "projects"))


QUERIES, ORACLES = R.queries, R.oracles
