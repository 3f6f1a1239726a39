"""Queries of quality reports: findings with severity, mention and project checks, seeds, readiness indicators, duplicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from loomgraph.functions import text, urls
from loomgraph.operators import graph as G
from loomgraph.operators import mentions as M
from loomgraph.operators.skew import salted_join
from loomgraph.plans.graphs import _MEM, _SIZE, membership
from loomgraph.plans.identity import _JDEC, _PDEC, _PEOPLE, _person_signals, _project_signals, key_sql, people, person_decisions
from loomgraph.plans.identity import _FREE, _NO_PROJECT, _WEAK_TITLE
from loomgraph.plans.registry import Registry
from loomgraph.plans.structure import part_of, relations
from loomgraph.session import cut
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query


def _union(parts):
    return reduce(lambda a, b: a.unionByName(b), parts)


_CORE = r"lower(trim(regexp_replace(regexp_replace(trim(t), '^(?i)kutató,\s*', ''), '\s*\([^)]+\)\s*$', '')))"
_FIND = f"""WITH RECURSIVE {_PEOPLE}, po AS (SELECT DISTINCT source_id AS s, target_id AS t FROM relations WHERE type = 'PART_OF' AND source_id IS NOT NULL AND target_id IS NOT NULL), up(s, t) AS (SELECT s, t FROM po UNION SELECT up.s, po.t FROM up JOIN po ON po.s = up.t),
  url AS (SELECT canonical_id, unnest(list_concat(profile_urls, [])) AS u FROM people UNION SELECT canonical_id, website FROM project UNION SELECT canonical_id, website FROM org_units),
  hid AS (SELECT canonical_id FROM person GROUP BY 1 HAVING count(DISTINCT orcid) > 1 OR count(DISTINCT mtmt_id) > 1),
  nm AS (SELECT canonical_id, {_FREE.format(key_sql('n'))} AS k FROM (SELECT canonical_id, label AS n FROM people UNION ALL SELECT canonical_id, unnest(alternate_names) FROM people) WHERE n IS NOT NULL),
  pj AS (SELECT DISTINCT canonical_id, title, "start" AS s, "end" AS e, website FROM project),
  f AS (SELECT 'provenance.missing_document' AS "check", 'error' AS severity, claim_id AS subject FROM claims WHERE document_id IS NOT NULL AND document_id NOT IN (SELECT document_id FROM documents WHERE document_id IS NOT NULL)
  UNION SELECT 'provenance.relation_without_claim', 'error', relation_id FROM relations WHERE coalesce(len(claim_ids), 0) = 0 UNION SELECT 'provenance.inferred_without_method', 'error', relation_id FROM relations WHERE epistemic_status <> 'OBSERVED' AND derivation_method IS NULL
  UNION SELECT 'provenance.synthetic_document', 'warning', document_id FROM documents WHERE synthetic UNION SELECT 'temporal.impossible_interval', 'error', relation_id FROM relations WHERE substr(valid_from, 1, 4) > substr(valid_until, 1, 4)
  UNION SELECT 'temporal.project_interval', 'error', canonical_id FROM pj WHERE s > e UNION SELECT 'url.malformed', 'warning', canonical_id FROM url WHERE u IS NOT NULL AND NOT starts_with(u, 'repo://') AND NOT regexp_matches(u, '^https?://[^/?#\\s]+\\.[^/?#\\s]+([/?#]\\S*)?$')
  UNION SELECT 'structure.cyclic_hierarchy', 'error', s FROM up WHERE s = t UNION SELECT 'structure.orphan_person', 'warning', canonical_id FROM people WHERE canonical_id NOT IN (SELECT source_id FROM relations WHERE type IN ('AFFILIATED_WITH','MEMBER_OF') AND source_id IS NOT NULL)
  UNION SELECT 'structure.orphan_unit', 'warning', canonical_id FROM org_units WHERE entity_type = 'OrganisationalUnit' AND canonical_id NOT IN (SELECT s FROM po)
  UNION SELECT 'identity.conflicting_hard_ids', 'error', canonical_id FROM hid UNION SELECT 'identity.same_name_distinct_ids', 'info', {_FREE.format(key_sql('label'))} FROM people WHERE label IS NOT NULL GROUP BY 3 HAVING count(*) > 1
  UNION SELECT 'identity.name_variants', 'info', canonical_id FROM nm GROUP BY 3 HAVING count(DISTINCT k) > 1 UNION SELECT 'identity.multi_record_person', 'info', canonical_id FROM people WHERE len(list_distinct(source_refs)) > 1
  UNION SELECT 'identity.without_evidence', 'error', canonical_id FROM people WHERE coalesce(len(identity_evidence), 0) = 0
  UNION SELECT 'conflict.positions', 'warning', canonical_id FROM (SELECT canonical_id, {_CORE} AS c FROM (SELECT canonical_id, unnest(position_titles) AS t FROM people)) GROUP BY 3 HAVING count(DISTINCT c) > 1
  UNION SELECT 'project.multiple_urls', 'warning', canonical_id FROM pj WHERE website IS NOT NULL GROUP BY 3 HAVING count(DISTINCT website) > 1 UNION SELECT 'review.project_label_suspicious', 'warning', canonical_id FROM pj WHERE regexp_matches(title, '(?i)(journal|folyóirat|editor|főszerkesztő)'))"""


def findings(spark, d):
    """(check, severity, subject) of every finding."""
    r = read_table(spark, d, "relations", "relation_id", "type", "source_id", "target_id", "claim_ids", "epistemic_status", "derivation_method", "valid_from", "valid_until")
    p = cut(people(spark, d, "label", "alternate_names", "profile_urls", "source_refs", "identity_evidence", "position_titles"))
    docs = read_table(spark, d, "documents", "document_id", "synthetic")
    pj = read_table(spark, d, "project", "canonical_id", "title", "start", "end", "website").distinct()
    units = read_table(spark, d, "org_units", "canonical_id", "entity_type", "website")
    of = lambda check, severity, df, subject: df.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.col(subject).alias("subject"))
    claims = read_table(spark, d, "claims", "claim_id", "document_id").filter("document_id IS NOT NULL")
    held = docs.select("document_id").filter("document_id IS NOT NULL").distinct()
    e = part_of(spark, d)
    up = G.closure(e)
    cyclic = e.join(up.select(F.col("ancestor").alias("src"), F.col("node").alias("dst")), ["src", "dst"], "left_semi").select("src").unionByName(e.filter("src = dst").select("src"))
    url = _union([p.select("canonical_id", F.explode("profile_urls").alias("u")), pj.select("canonical_id", F.col("website").alias("u")), units.select("canonical_id", F.col("website").alias("u"))]).filter("u IS NOT NULL AND NOT startswith(u, 'repo://')")
    ids = read_table(spark, d, "person", "canonical_id", "orcid", "mtmt_id").groupBy("canonical_id").agg(F.countDistinct("orcid").alias("o"), F.countDistinct("mtmt_id").alias("m")).filter("o > 1 OR m > 1")
    free = lambda c: F.array_join(F.array_sort(F.split(text.name_key(c), " ")), " ")
    names = p.select("canonical_id", F.explode(F.concat(F.array("label"), F.coalesce("alternate_names", F.array().cast("array<string>")))).alias("n")).filter("n IS NOT NULL").select("canonical_id", free(F.col("n")).alias("k"))
    several = lambda df, key, value: df.groupBy(key).agg(F.countDistinct(value).alias("v")).filter("v > 1")
    core = F.lower(F.trim(F.regexp_replace(F.regexp_replace(F.trim("t"), r"(?iu)^kutató,\s*", ""), r"\s*\([^)]+\)\s*$", "")))
    positions = p.select("canonical_id", F.explode("position_titles").alias("t")).select("canonical_id", core.alias("c"))
    placed = r.filter("type IN ('AFFILIATED_WITH', 'MEMBER_OF') AND source_id IS NOT NULL").select(F.col("source_id").alias("canonical_id")).distinct()
    size = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0))
    parts = [
        of("provenance.missing_document", "error", salted_join(claims, held, "document_id", "left_anti"), "claim_id"), of("provenance.relation_without_claim", "error", r.filter(size("claim_ids") == 0), "relation_id"),
        of("provenance.inferred_without_method", "error", r.filter("epistemic_status <> 'OBSERVED' AND derivation_method IS NULL"), "relation_id"), of("provenance.synthetic_document", "warning", docs.filter("synthetic"), "document_id"),
        of("temporal.impossible_interval", "error", r.filter("substring(valid_from, 1, 4) > substring(valid_until, 1, 4)"), "relation_id"), of("temporal.project_interval", "error", pj.filter("start > end"), "canonical_id"),
        of("url.malformed", "warning", url.filter(~urls.well_formed(F.col("u"))), "canonical_id"), of("structure.cyclic_hierarchy", "error", cyclic, "src"), of("structure.orphan_person", "warning", p.join(placed, "canonical_id", "left_anti"), "canonical_id"),
        of("structure.orphan_unit", "warning", units.filter("entity_type = 'OrganisationalUnit'").join(e.select(F.col("src").alias("canonical_id")), "canonical_id", "left_anti"), "canonical_id"), of("identity.conflicting_hard_ids", "error", ids, "canonical_id"),
        of("identity.same_name_distinct_ids", "info", p.filter("label IS NOT NULL").select(free(F.col("label")).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "k"), of("identity.name_variants", "info", several(names, "canonical_id", "k"), "canonical_id"),
        of("identity.multi_record_person", "info", p.filter(F.size(F.array_distinct("source_refs")) > 1), "canonical_id"), of("identity.without_evidence", "error", p.filter(size("identity_evidence") == 0), "canonical_id"), of("conflict.positions", "warning", several(positions, "canonical_id", "c"), "canonical_id"),
        of("project.multiple_urls", "warning", several(pj.filter("website IS NOT NULL"), "canonical_id", "website"), "canonical_id"), of("review.project_label_suspicious", "warning", pj.filter(F.col("title").rlike("(?iu)(journal|folyóirat|editor|főszerkesztő)")), "canonical_id"),
    ]
    return _union(parts).distinct()


@query(f'{_FIND} SELECT "check", severity, subject FROM f')
def quality_findings(spark, d):
    """Every finding of the checks on provenance, time, addresses, structure, identity and conflicts, one row for each subject."""
    return findings(spark, d)


@query(f'{_FIND} SELECT severity, count(DISTINCT "check") AS checks, count(*) AS findings FROM f GROUP BY 1')
def findings_by_severity(spark, d):
    return findings(spark, d).groupBy("severity").agg(F.countDistinct("check").alias("checks"), F.count(F.lit(1)).alias("findings"))


_BLOCKING = ",".join(f"'{x}'" for x in M.PERSON_BLOCKING)


@query(f"""{_PDEC}, own AS (SELECT DISTINCT canonical_id, u FROM (SELECT canonical_id, unnest(profile_urls) AS u FROM people)), auto AS (SELECT dec.mention, dec.person_id, method FROM dec WHERE status = 'HIGH_CONFIDENCE_AUTO'), asig AS (SELECT a.*, sg, ng FROM auto a JOIN sig USING (mention, person_id)),
  rate AS (SELECT split_part(mention, '|', 1) AS site, count(*) AS n, count(person_id) / count(*) AS r FROM dec GROUP BY 1 HAVING count(*) >= 20)
  SELECT 'mention_target_missing' AS "check", count(*) AS n FROM dec WHERE person_id IS NOT NULL AND person_id NOT IN (SELECT canonical_id FROM people) UNION ALL SELECT 'unresolved_linked_profile', count(*) FROM dec JOIN men USING (mention) WHERE status = 'UNRESOLVED' AND url IN (SELECT u FROM own)
  UNION ALL SELECT 'auto_unexplained', count(*) FROM asig WHERE method IS NULL OR len(sg) < 2 UNION ALL SELECT 'auto_despite_contradiction', count(*) FROM asig WHERE list_has_any(ng, [{_BLOCKING}]) UNION ALL SELECT 'unresolved_mentions', count(*) FROM dec WHERE person_id IS NULL
  UNION ALL SELECT 'unresolved_sharing_a_name', count(*) FROM (SELECT DISTINCT dec.mention FROM dec JOIN m USING (mention) JOIN pn USING (k) WHERE dec.person_id IS NULL) UNION ALL SELECT 'resolution_uneven_by_site', CAST(coalesce(max(r) - min(r) > 0.2, false) AS BIGINT) FROM rate
  UNION ALL SELECT 'rejected_candidates', count(*) FROM sig WHERE rejected UNION ALL SELECT 'several_candidates', count(*) FROM (SELECT mention FROM sig GROUP BY 1 HAVING count(*) > 1)""")
def mention_checks(spark, d):
    """Checks on mentions: targets that exist, linked profiles left open, automatic decisions without or against evidence, uneven rates."""
    mentions, manual, s = _person_signals(spark, d)
    dec = cut(M.decide(mentions, s, "person_id", M.person_viable(), M.person_rule(), M.PERSON_BLOCKING, manual, "", ""))
    p = people(spark, d, "label", "alternate_names", "profile_urls")
    names = M.person_names(p).select("key").distinct()
    own = p.select(F.explode("profile_urls").alias("url")).filter("url IS NOT NULL").distinct()
    auto = dec.filter("status = 'HIGH_CONFIDENCE_AUTO'").select("mention", "person_id", "method").join(s, ["mention", "person_id"])
    open_ = dec.filter("person_id IS NULL")
    keyed = mentions.select("mention", "url", text.name_key(F.col("name")).alias("key"))
    n = lambda name, df: df.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("n"))
    rates = dec.groupBy(F.substring_index("mention", "|", 1).alias("site")).agg(F.count(F.lit(1)).alias("n"), (F.count("person_id") / F.count(F.lit(1))).alias("r")).filter("n >= 20")
    return _union([
        n("mention_target_missing", dec.filter("person_id IS NOT NULL").join(p.select(F.col("canonical_id").alias("person_id")), "person_id", "left_anti")), n("unresolved_linked_profile", dec.filter("status = 'UNRESOLVED'").join(keyed, "mention").join(own, "url", "left_semi")),
        n("auto_unexplained", auto.filter((F.col("method").isNull()) | (F.size("signals") < 2))), n("auto_despite_contradiction", auto.filter(M.among(F.col("negatives"), M.PERSON_BLOCKING))), n("unresolved_mentions", open_),
        n("unresolved_sharing_a_name", open_.join(keyed, "mention").join(names, "key", "left_semi")), rates.agg(F.lit("resolution_uneven_by_site").alias("check"), F.coalesce((F.max("r") - F.min("r") > 0.2).cast("bigint"), F.lit(0)).alias("n")),
        n("rejected_candidates", s.filter("rejected")), n("several_candidates", s.groupBy("mention").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")),
    ])


_INDEPENDENT = "['GRANT_ID_MATCH', 'PAGE_LINKS_OWNER', 'PAGE_NAMES_OWNER']"


@query(f"""{_JDEC}, auto AS (SELECT mention, project_id, method FROM dec WHERE status = 'HIGH_CONFIDENCE_AUTO'), asig AS (SELECT a.*, sg, ng FROM auto a JOIN sig USING (mention, project_id)), gr AS (SELECT project_id FROM pg GROUP BY 1 HAVING count(*) > 1), same AS (SELECT k FROM pk WHERE k <> '' GROUP BY 1 HAVING count(DISTINCT project_id) > 1)
  SELECT 'mention_target_missing' AS "check", count(*) AS n FROM dec WHERE project_id IS NOT NULL AND project_id NOT IN (SELECT canonical_id FROM project) UNION ALL SELECT 'title_only_auto', count(*) FROM asig WHERE NOT list_has_any(sg, {_INDEPENDENT}) UNION ALL SELECT 'auto_despite_contradiction', count(*) FROM asig WHERE list_has_any(ng, ['GRANT_ID_CONFLICT','PERIOD_CONFLICT','LINKS_OTHER_PAGE'])
  UNION ALL SELECT 'conflicting_grant_ids', count(*) FROM gr UNION ALL SELECT 'same_title_distinct', count(*) FROM same UNION ALL SELECT 'without_evidence', count(*) FROM (SELECT canonical_id FROM project GROUP BY 1 HAVING max(coalesce(len(identity_evidence), 0)) = 0)
  UNION ALL SELECT 'unresolved_mentions', count(*) FROM dec WHERE project_id IS NULL UNION ALL SELECT 'duplicate_title_groups', count(*) FROM (SELECT k FROM pmn JOIN dec USING (mention) WHERE dec.project_id IS NULL AND k <> '' GROUP BY 1 HAVING count(*) > 1)""")
def project_checks(spark, d):
    """Checks on projects and their mentions: targets, title-only or contradicted decisions, grants, shared titles."""
    m, manual, s = _project_signals(spark, d)
    dec = cut(M.decide(m, s, "project_id", M.project_viable(), M.project_rule(), M.PROJECT_BLOCKING, manual, _NO_PROJECT, _WEAK_TITLE))
    p = read_table(spark, d, "project", "canonical_id", "title", "alternate_titles", "grant_id", "start", "end", "website", "source_refs", "identity_evidence")
    facts = cut(M.project_facts(p))
    auto = dec.filter("status = 'HIGH_CONFIDENCE_AUTO'").select("mention", "project_id").join(s, ["mention", "project_id"])
    n = lambda name, df: df.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("n"))
    size = F.coalesce(F.when(F.col("identity_evidence").isNotNull(), F.size("identity_evidence")), F.lit(0))
    open_ = dec.filter("project_id IS NULL")
    return _union([
        n("mention_target_missing", dec.filter("project_id IS NOT NULL").join(p.select(F.col("canonical_id").alias("project_id")).distinct(), "project_id", "left_anti")), n("title_only_auto", auto.filter(~M.among(F.col("signals"), ["GRANT_ID_MATCH", "PAGE_LINKS_OWNER", "PAGE_NAMES_OWNER"]))),
        n("auto_despite_contradiction", auto.filter(M.among(F.col("negatives"), ["GRANT_ID_CONFLICT", "PERIOD_CONFLICT", "LINKS_OTHER_PAGE"]))), n("conflicting_grant_ids", facts.filter(F.size("grants") > 1)),
        n("same_title_distinct", facts.select("project_id", F.explode("keys").alias("k")).groupBy("k").agg(F.countDistinct("project_id").alias("v")).filter("v > 1")), n("without_evidence", p.groupBy("canonical_id").agg(F.max(size).alias("v")).filter("v = 0")),
        n("unresolved_mentions", open_), n("duplicate_title_groups", m.join(open_.select("mention"), "mention").filter("k <> ''").groupBy("k").agg(F.count(F.lit(1)).alias("v")).filter("v > 1")),
    ])


@query(f"""WITH {_PEOPLE}, sd AS (SELECT DISTINCT left_label AS seed FROM matches WHERE entity_type = 'Person' AND trim(left_label) <> ''), pk AS (SELECT DISTINCT {_FREE.format(key_sql('label'))} AS k FROM people WHERE label IS NOT NULL) SELECT seed, {_FREE.format(key_sql('seed'))} IN (SELECT k FROM pk) AS present FROM sd""")
def seed_coverage(spark, d):
    """Which expected names (here the left labels of matches) some person bears, in whatever order."""
    free = lambda c: F.array_join(F.array_sort(F.split(text.name_key(c), " ")), " ")
    seeds = read_table(spark, d, "matches", "left_label", "entity_type").filter("entity_type = 'Person' AND trim(left_label) <> ''").select(F.col("left_label").alias("seed")).distinct().withColumn("k", free(F.col("seed")))
    have = people(spark, d, "label").filter("label IS NOT NULL").select(free(F.col("label")).alias("k"), F.lit(True).alias("present")).distinct()
    return seeds.join(have, "k", "left").select("seed", F.coalesce("present", F.lit(False)).alias("present"))


_SHARE = lambda i, name, n, of: f"SELECT '{i}' AS id, '{name}' AS indicator, CAST(({n}) AS BIGINT) AS n, CAST(({of}) AS BIGINT) AS total"
_PERS, _PROJ = "SELECT count(*) FROM people", "SELECT count(DISTINCT canonical_id) FROM project"
_WITH = lambda t: f"SELECT count(*) FROM people WHERE canonical_id IN (SELECT source_id FROM r WHERE type IN ({t}))"
_IND = [
    _SHARE("A1", "persons_with_affiliation", _WITH("'AFFILIATED_WITH'"), _PERS), _SHARE("A2", "persons_with_named_unit", _WITH("'MEMBER_OF'"), _PERS),
    _SHARE("A3", "persons_with_position", "SELECT count(*) FROM people WHERE len(position_titles) > 0", _PERS), _SHARE("A4", "units_in_hierarchy", "SELECT count(*) FROM un WHERE id IN (SELECT s FROM up JOIN ins ON ins.id = up.t)", "SELECT count(*) FROM un"),
    _SHARE("B1", "persons_with_project_edge", _WITH("'PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF'"), _PERS), _SHARE("B2", "projects_with_person", f"SELECT count(*) FROM z WHERE project IN (SELECT canonical_id FROM project)", _PROJ),
    _SHARE("B2p", "projects_with_lead", "SELECT count(DISTINCT target_id) FROM r WHERE type = 'PRINCIPAL_INVESTIGATOR_OF' AND target_id IN (SELECT canonical_id FROM project)", _PROJ), _SHARE("B2t", "projects_with_two_persons", "SELECT count(*) FROM z WHERE n >= 2 AND project IN (SELECT canonical_id FROM project)", _PROJ),
    _SHARE("B4", "project_edges_observed", "SELECT count(*) FROM e4 WHERE o", "SELECT count(*) FROM e4"), _SHARE("C1", "persons_in_ties", "SELECT count(DISTINCT x) FROM (SELECT a AS x FROM t UNION ALL SELECT b FROM t)", "SELECT count(DISTINCT person) FROM m"),
    _SHARE("C2", "ties_through_large_projects", "SELECT count(*) FROM t WHERE big >= 8", "SELECT count(*) FROM t"), _SHARE("C3", "ties_by_one_project", "SELECT count(*) FROM t WHERE s = 1", "SELECT count(*) FROM t"),
    _SHARE("D1", "persons_with_topic", "SELECT count(*) FROM people WHERE canonical_id IN (SELECT subject.canonical_id FROM claims WHERE predicate = 'WORKS_ON_TOPIC')", _PERS), _SHARE("D2", "persons_stating_an_area", "SELECT count(*) FROM people WHERE canonical_id IN (SELECT subject.canonical_id FROM claims WHERE predicate = 'research_area' AND value IS NOT NULL)", _PERS),
    _SHARE("I2", "names_of_several_persons", f"SELECT count(*) FROM (SELECT {_FREE.format(key_sql('label'))} AS k FROM people WHERE label IS NOT NULL GROUP BY 1 HAVING count(*) > 1)", f"SELECT count(DISTINCT {_FREE.format(key_sql('label'))}) FROM people WHERE label IS NOT NULL"),
    _SHARE("I4", "projects_with_status", "SELECT count(DISTINCT canonical_id) FROM project WHERE status_label IS NOT NULL", _PROJ), _SHARE("I5", "edges_with_claims", "SELECT count(DISTINCT relation_id) FROM relations WHERE len(claim_ids) > 0", "SELECT count(DISTINCT relation_id) FROM relations"),
    _SHARE("I6", "persons_with_structure_only", "SELECT count(*) FROM people WHERE canonical_id NOT IN (SELECT x FROM (SELECT source_id AS x, type FROM r UNION ALL SELECT target_id, type FROM r) WHERE type NOT IN ('AFFILIATED_WITH','MEMBER_OF','LEADS','PART_OF'))", _PERS),
    _SHARE("T1", "affiliations_with_dates", "SELECT count(*) FROM (SELECT source_id, target_id FROM relations WHERE type = 'AFFILIATED_WITH' AND source_id IS NOT NULL AND target_id IS NOT NULL GROUP BY 1, 2 HAVING count(valid_from) + count(valid_until) > 0)", "SELECT count(*) FROM r WHERE type = 'AFFILIATED_WITH'"),
    _SHARE("T1p", "projects_with_start", "SELECT count(DISTINCT canonical_id) FROM project WHERE \"start\" IS NOT NULL", _PROJ),
]


@query(f"""WITH RECURSIVE {_PEOPLE}, r AS (SELECT DISTINCT type, source_id, target_id FROM relations WHERE source_id IS NOT NULL AND target_id IS NOT NULL), {_MEM}, {_SIZE}, po AS (SELECT source_id AS s, target_id AS t FROM r WHERE type = 'PART_OF'), up(s, t) AS (SELECT s, t FROM po UNION SELECT up.s, po.t FROM up JOIN po ON po.s = up.t),
  un AS (SELECT DISTINCT canonical_id AS id FROM org_units WHERE entity_type = 'OrganisationalUnit'), ins AS (SELECT DISTINCT canonical_id AS id FROM org_units WHERE entity_type = 'Institution'), t AS (SELECT a.person AS a, b.person AS b, count(*) AS s, max(z.n) AS big FROM m a JOIN m b ON a.project = b.project AND a.person < b.person JOIN z ON z.project = a.project GROUP BY 1, 2),
  e4 AS (SELECT target_id, source_id, bool_or(epistemic_status = 'OBSERVED') AS o FROM relations WHERE type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF') AND source_id IS NOT NULL AND target_id IS NOT NULL GROUP BY 1, 2) {' UNION ALL '.join(_IND)}""")
def readiness_indicators(spark, d):
    """Indicators of composition, coverage, ties, topics, identity and time, each with its denominator."""
    p = cut(people(spark, d, "label", "position_titles"))
    r = cut(relations(spark, d))
    ids = p.select("canonical_id").distinct()
    m = cut(membership(spark, d))
    z = m.groupBy("project").agg(F.count(F.lit(1)).alias("n"))
    pj = read_table(spark, d, "project", "canonical_id", "start", "status_label").groupBy("canonical_id").agg(F.count("start").alias("dated"), F.count("status_label").alias("labelled"))
    zp = pj.select("canonical_id", "dated", "labelled").join(z.withColumnRenamed("project", "canonical_id"), "canonical_id", "left")
    lead = r.filter("type = 'PRINCIPAL_INVESTIGATOR_OF'").select(F.col("target_id").alias("canonical_id")).distinct()
    units = read_table(spark, d, "org_units", "canonical_id", "entity_type").distinct()
    up = G.closure(part_of(spark, d))
    under = up.join(units.filter("entity_type = 'Institution'").select(F.col("canonical_id").alias("ancestor")), "ancestor", "left_semi").select(F.col("node").alias("canonical_id")).distinct()
    own = units.filter("entity_type = 'OrganisationalUnit'").select("canonical_id").distinct()
    sized = m.join(z, "project")
    t = cut(sized.alias("l").join(m.alias("r"), (F.col("l.project") == F.col("r.project")) & (F.col("l.person") < F.col("r.person"))).groupBy(F.col("l.person").alias("a"), F.col("r.person").alias("b")).agg(F.count(F.lit(1)).alias("s"), F.max("l.n").alias("big")))
    c = read_table(spark, d, "claims", "predicate", "subject", "value")
    said = lambda where: c.filter(where).select(F.col("subject.canonical_id").alias("canonical_id")).filter("canonical_id IS NOT NULL").distinct()
    typed = lambda *types: r.filter(F.col("type").isin(*types)).select(F.col("source_id").alias("canonical_id")).distinct()
    raw = read_table(spark, d, "relations", "relation_id", "type", "source_id", "target_id", "claim_ids", "epistemic_status", "valid_from", "valid_until")
    e4 = raw.filter("type IN ('PARTICIPATES_IN', 'PRINCIPAL_INVESTIGATOR_OF') AND source_id IS NOT NULL AND target_id IS NOT NULL").groupBy("target_id", "source_id").agg(F.bool_or(F.col("epistemic_status") == "OBSERVED").alias("o"))
    e5 = raw.filter("relation_id IS NOT NULL").groupBy("relation_id").agg(F.max(F.coalesce(F.size("claim_ids"), F.lit(0)) > 0).alias("o"))
    dated = raw.filter("type = 'AFFILIATED_WITH' AND source_id IS NOT NULL AND target_id IS NOT NULL").groupBy("source_id", "target_id").agg((F.count("valid_from") + F.count("valid_until") > 0).alias("o"))
    other = r.filter(~F.col("type").isin("AFFILIATED_WITH", "MEMBER_OF", "LEADS", "PART_OF")).select(F.explode(F.array("source_id", "target_id")).alias("canonical_id")).distinct()
    free = F.array_join(F.array_sort(F.split(text.name_key(F.col("label")), " ")), " ")
    named = p.filter("label IS NOT NULL").groupBy(free.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    one = F.count(F.lit(1))
    row = lambda i, name, df, hit: df.agg(F.lit(i).alias("id"), F.lit(name).alias("indicator"), F.count_if(hit).alias("n"), one.alias("total"))
    among = lambda i, name, who, hits: row(i, name, who.join(hits.withColumn("hit", F.lit(True)), "canonical_id", "left"), F.col("hit").isNotNull())
    in_ties = t.select(F.explode(F.array("a", "b")).alias("person")).distinct().withColumn("hit", F.lit(True))
    return _union([
        among("A1", "persons_with_affiliation", ids, typed("AFFILIATED_WITH")), among("A2", "persons_with_named_unit", ids, typed("MEMBER_OF")), row("A3", "persons_with_position", p, F.size("position_titles") > 0), among("A4", "units_in_hierarchy", own, under),
        among("B1", "persons_with_project_edge", ids, typed("PARTICIPATES_IN", "PRINCIPAL_INVESTIGATOR_OF")), row("B2", "projects_with_person", zp, F.col("n").isNotNull()), among("B2p", "projects_with_lead", pj.select("canonical_id"), lead), row("B2t", "projects_with_two_persons", zp, F.col("n") >= 2),
        row("B4", "project_edges_observed", e4, F.col("o")), row("C1", "persons_in_ties", m.select("person").distinct().join(in_ties, "person", "left"), F.col("hit").isNotNull()), row("C2", "ties_through_large_projects", t, F.col("big") >= 8), row("C3", "ties_by_one_project", t, F.col("s") == 1),
        among("D1", "persons_with_topic", ids, said("predicate = 'WORKS_ON_TOPIC'")), among("D2", "persons_stating_an_area", ids, said("predicate = 'research_area' AND value IS NOT NULL")), row("I2", "names_of_several_persons", named, F.col("n") > 1), row("I4", "projects_with_status", zp, F.col("labelled") > 0),
        row("I5", "edges_with_claims", e5, F.col("o")), row("I6", "persons_with_structure_only", ids.join(other.withColumn("hit", F.lit(True)), "canonical_id", "left"), F.col("hit").isNull()), row("T1", "affiliations_with_dates", dated, F.col("o")), row("T1p", "projects_with_start", zp, F.col("dated") > 0),
    ])


QUERIES, ORACLES = R.queries, R.oracles
