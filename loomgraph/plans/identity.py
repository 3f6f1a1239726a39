"""Queries of entity resolution: record pairs, structural matches, identity map, mentions of people and projects."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import dates, text, urls
from loomgraph.operators import graph as G
from loomgraph.operators import mentions as M
from loomgraph.operators import resolution as ER
from loomgraph.operators.windows import best_row
from loomgraph.plans.registry import Registry
from loomgraph.plans.strings import _EXACT, _FOLD, _GRANTS, _stripped
from loomgraph.plans.texts import _HOST, _KEY
from loomgraph.session import cut
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query

#: Surnames that are too common for an institute and a unique name to decide.
COMMON_SURNAMES = ["nagy", "kovacs", "toth", "szabo"]
#: Hosts whose addresses count as stated by the source itself.
TRUSTED_HOSTS = ["kultura.vt-kutato.example", "varos.pk-kutato.example", "munka.pk-kutato.example"]

key_sql = lambda c: _KEY.replace("canonical_name", c)
exact_sql = lambda c: _EXACT.replace("canonical_name", c)
_quoted = lambda xs: ",".join(f"'{x}'" for x in xs)

_PEOPLE = "people AS (SELECT * FROM person QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY snapshot_date DESC, loaded_at DESC) = 1)"
_LINKS = """pairs AS (SELECT a, b, min(CASE WHEN s LIKE '%same_as' AND s NOT LIKE '%not%' THEN 1 END) AS yes, min(CASE WHEN s LIKE '%not_same_as' THEN 1 END) AS no FROM (SELECT "left" AS a, "right" AS b, method AS s FROM matches UNION ALL SELECT "right", "left", method FROM matches)
  WHERE s LIKE 'manual:%' AND a IS NOT NULL AND b IS NOT NULL GROUP BY a, b)"""
_MEN = f"""refs AS (SELECT DISTINCT unnest(source_refs) AS ref, canonical_id FROM person),
  ends AS (SELECT "left" AS ref, left_label AS label FROM matches WHERE entity_type = 'Person' UNION ALL SELECT "right", right_label FROM matches WHERE entity_type = 'Person'),
  men AS (SELECT ref AS mention, label AS name, split_part(ref, '|', 1) AS site, CASE WHEN regexp_matches(split_part(ref, '|', 2), '^https?://') THEN split_part(ref, '|', 2) END AS url FROM (SELECT ref, label, count(*) AS n FROM ends WHERE ref IS NOT NULL AND trim(label) <> '' GROUP BY 1, 2)
    WHERE ref NOT IN (SELECT ref FROM refs WHERE ref IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY ref ORDER BY n DESC, label) = 1),
  {_LINKS}, man AS (SELECT DISTINCT a AS mention, r.canonical_id AS person_id, CASE WHEN no = 1 THEN 'not_same_as' ELSE 'same_as' END AS decision FROM pairs JOIN refs r ON r.ref = b JOIN men ON men.mention = a)"""


def people(spark, d, *columns):
    """The latest row of each person."""
    p = read_table(spark, d, "person", "canonical_id", "snapshot_date", "loaded_at", *columns)
    return best_row(p, ["canonical_id"], F.desc_nulls_last("snapshot_date"), F.desc_nulls_last("loaded_at"))


def person_mentions(spark, d):
    """(mention, name, site, url): ends of person matches that no person record holds, with their commonest label."""
    refs = read_table(spark, d, "person", "source_refs").select(F.explode("source_refs").alias("ref")).distinct()
    m = read_table(spark, d, "matches", "left", "right", "left_label", "right_label", "entity_type").filter("entity_type = 'Person'")
    ends = m.select(F.explode(F.array(F.struct(F.col("left").alias("ref"), F.col("left_label").alias("label")), F.struct(F.col("right").alias("ref"), F.col("right_label").alias("label")))).alias("e")).select("e.*")
    counted = ends.filter("ref IS NOT NULL AND trim(label) <> ''").groupBy("ref", "label").agg(F.count(F.lit(1)).alias("n")).join(refs, "ref", "left_anti")
    one = best_row(counted, ["ref"], F.desc("n"), F.asc("label"))
    return one.select(F.col("ref").alias("mention"), F.col("label").alias("name"), F.substring_index("ref", "|", 1).alias("site"), urls.ref_url(F.col("ref")).alias("url"))


def manual_decisions(spark, d, mentions):
    """(mention, person_id, decision) from reviewed pairs of a mention and a person's record, whichever side it is on."""
    refs = read_table(spark, d, "person", "source_refs", "canonical_id").select(F.explode("source_refs").alias("b"), F.col("canonical_id").alias("person_id")).distinct()
    m = read_table(spark, d, "matches", "left", "right", "method").filter("method LIKE 'manual:%' AND `left` IS NOT NULL AND `right` IS NOT NULL")
    both = m.select(F.explode(F.array(F.struct(F.col("left").alias("a"), F.col("right").alias("b")), F.struct(F.col("right").alias("a"), F.col("left").alias("b")))).alias("e"), "method").select("e.*", "method")
    pairs = both.groupBy("a", "b").agg(F.bool_or(F.endswith("method", F.lit("not_same_as"))).alias("no"))
    return pairs.join(refs, "b").join(mentions.select(F.col("mention").alias("a")), "a", "left_semi").select(F.col("a").alias("mention"), "person_id", F.when(F.col("no"), "not_same_as").otherwise("same_as").alias("decision")).distinct()


def _person_signals(spark, d):
    p = people(spark, d, "label", "alternate_names", "source_refs", "profile_urls")
    names = cut(M.person_names(p))
    facts = cut(M.person_facts(p, names))
    mentions = cut(person_mentions(spark, d))
    r = read_table(spark, d, "relations", "type", "source_id", "target_id").dropna().distinct()
    above = G.closure(r.filter("type = 'PART_OF'").select(F.col("source_id").alias("src"), F.col("target_id").alias("dst")))
    units = r.filter("type IN ('AFFILIATED_WITH', 'MEMBER_OF')").select(F.col("source_id").alias("person_id"), F.col("target_id").alias("unit_id")).distinct()
    site = read_table(spark, d, "org_units", "canonical_id", "source_refs").select("canonical_id", F.explode("source_refs").alias("ref"))
    site_units = site.groupBy(F.substring_index("ref", "|", 1).alias("site")).agg(F.min("canonical_id").alias("unit_id"))
    up = above.select(F.col("node").alias("unit_id"), F.col("ancestor").alias("institute")).unionByName(units.select("unit_id", F.col("unit_id").alias("institute"))).distinct()
    tops = up.join(site_units.select(F.col("unit_id").alias("institute")).distinct(), "institute", "left_semi").groupBy("unit_id").agg(F.collect_set("institute").alias("institutes"))
    placed = units.join(tops, "unit_id", "left").withColumn("institutes", F.coalesce("institutes", F.array().cast("array<string>")))
    projects = r.filter("type IN ('PARTICIPATES_IN', 'PRINCIPAL_INVESTIGATOR_OF')").select(F.col("source_id").alias("person_id"), F.col("target_id").alias("project_id")).distinct()
    c = read_table(spark, d, "claims", "subject", "object").filter("object.canonical_id IS NOT NULL AND subject.source_ref IS NOT NULL")
    context = c.select(F.col("subject.source_ref").alias("mention"), F.col("object.canonical_id").alias("target_id")).distinct().join(mentions.select("mention"), "mention", "left_semi")
    manual = cut(manual_decisions(spark, d, mentions))
    return mentions, manual, cut(M.person_signals(mentions, names, facts, placed, site_units, projects, context, TRUSTED_HOSTS, COMMON_SURNAMES, manual))


_INITIALS = """list_reduce(list_concat([0], range(1, len(s) + 1)), lambda p, i: CASE WHEN p < 0 THEN -1 ELSE coalesce(list_min([j for j in range(p + 1, len(l) + 1)
  if l[j] = s[i] OR (length(s[i]) = 1 AND starts_with(l[j], s[i])) OR (length(l[j]) = 1 AND starts_with(s[i], l[j]))]), -1) END) > 0"""
_FREE = "array_to_string(list_sort(string_split({0}, ' ')), ' ')"
_PSIG = f"""WITH RECURSIVE {_PEOPLE}, {_MEN},
  pn AS (SELECT person_id, k, max(kind) AS kind, list(e) AS es FROM (SELECT canonical_id AS person_id, {key_sql('label')} AS k, 'label' AS kind, {exact_sql('label')} AS e FROM people WHERE label IS NOT NULL
     UNION ALL SELECT canonical_id, {key_sql('a')}, 'alternate', {exact_sql('a')} FROM (SELECT canonical_id, unnest(alternate_names) AS a FROM people) WHERE a IS NOT NULL) WHERE k <> '' GROUP BY 1, 2),
  fam AS (SELECT DISTINCT canonical_id AS person_id, split_part(split_part(r, '|', 1), '_', 1) AS family FROM (SELECT canonical_id, unnest(source_refs) AS r FROM people)),
  sl AS (SELECT DISTINCT canonical_id AS person_id, nullif(regexp_extract(u, '/kutato/([^/?#]+)', 1), '') AS slug, {_HOST.format('u')} AS host FROM (SELECT canonical_id, unnest(profile_urls) AS u FROM people) WHERE regexp_matches(u, '/kutato/[^/?#]+')),
  m AS (SELECT mention, site, split_part(site, '_', 1) AS family, {key_sql('name')} AS k, {exact_sql('name')} AS e, nullif(regexp_extract(url, '/kutato/([^/?#]+)', 1), '') AS slug, {_HOST.format('url')} AS host FROM men),
  ini AS (SELECT m.mention, pn.person_id, string_split(CASE WHEN len(string_split(m.k, ' ')) <= len(string_split(pn.k, ' ')) THEN m.k ELSE pn.k END, ' ')[2:] AS s, string_split(CASE WHEN len(string_split(m.k, ' ')) <= len(string_split(pn.k, ' ')) THEN pn.k ELSE m.k END, ' ')[2:] AS l
     FROM m JOIN pn ON split_part(m.k, ' ', 1) = split_part(pn.k, ' ', 1) AND m.k <> pn.k AND contains(m.k, ' ') AND contains(pn.k, ' ')),
  inc AS (SELECT DISTINCT mention, person_id FROM ini WHERE {_INITIALS}),
  cand AS (SELECT mention, person_id FROM m JOIN pn USING (k) UNION SELECT mention, person_id FROM m JOIN pn ON {_FREE.format('m.k')} = {_FREE.format('pn.k')} UNION SELECT mention, person_id FROM inc UNION SELECT mention, person_id FROM m JOIN sl USING (slug)),
  up(u, a) AS (SELECT DISTINCT source_id, target_id FROM relations WHERE type = 'PART_OF' AND source_id IS NOT NULL AND target_id IS NOT NULL UNION SELECT up.u, r.target_id FROM up JOIN relations r ON r.type = 'PART_OF' AND r.source_id = up.a AND r.target_id IS NOT NULL),
  un AS (SELECT DISTINCT source_id AS person_id, target_id AS u FROM relations WHERE type IN ('AFFILIATED_WITH','MEMBER_OF') AND source_id IS NOT NULL AND target_id IS NOT NULL),
  su AS (SELECT split_part(r, '|', 1) AS site, min(canonical_id) AS u FROM (SELECT canonical_id, unnest(source_refs) AS r FROM org_units) GROUP BY 1),
  ins AS (SELECT DISTINCT person_id, a FROM (SELECT person_id, u AS a FROM un UNION ALL SELECT person_id, up.a FROM un JOIN up USING (u)) WHERE a IN (SELECT u FROM su)),
  same AS (SELECT pn.k, fam.family, count(DISTINCT person_id) AS n, min(person_id) AS one FROM pn JOIN fam USING (person_id) GROUP BY 1, 2),
  ctx AS (SELECT DISTINCT subject.source_ref AS mention, object.canonical_id AS t FROM claims WHERE subject.source_ref IN (SELECT mention FROM m) AND object.canonical_id IS NOT NULL),
  j AS (SELECT c.mention, c.person_id, m.k, m.slug, CASE WHEN EXISTS (SELECT 1 FROM pn WHERE pn.person_id = c.person_id AND list_contains(pn.es, m.e)) THEN CASE WHEN EXISTS (SELECT 1 FROM pn WHERE pn.person_id = c.person_id AND pn.k = m.k AND pn.kind = 'label') THEN 'NAME_EXACT' ELSE 'ALTERNATE_NAME_MATCH' END
      WHEN EXISTS (SELECT 1 FROM pn WHERE pn.person_id = c.person_id AND pn.k = m.k AND pn.kind = 'label') THEN 'SAME_NORMALIZED_NAME' WHEN EXISTS (SELECT 1 FROM pn WHERE pn.person_id = c.person_id AND pn.k = m.k) THEN 'ALTERNATE_NAME_MATCH'
      WHEN EXISTS (SELECT 1 FROM pn WHERE pn.person_id = c.person_id AND {_FREE.format('pn.k')} = {_FREE.format('m.k')}) THEN 'NAME_ORDER_VARIANT' WHEN (c.mention, c.person_id) IN (SELECT (mention, person_id) FROM inc) THEN 'NAME_INITIALS_COMPATIBLE' ELSE 'SLUG_ONLY' END AS name_match,
    EXISTS (SELECT 1 FROM fam WHERE fam.person_id = c.person_id AND fam.family = m.family) AS fam, EXISTS (SELECT 1 FROM sl WHERE sl.person_id = c.person_id AND sl.slug = m.slug) AS own, EXISTS (SELECT 1 FROM sl WHERE sl.person_id = c.person_id) AS paged,
    EXISTS (SELECT 1 FROM sl WHERE sl.person_id = c.person_id AND sl.host = m.host) AS hosted, coalesce(m.host IN ({_quoted(TRUSTED_HOSTS)}), false) AS trusted, m.host IS NOT NULL AS has_host,
    EXISTS (SELECT 1 FROM ctx JOIN relations r ON r.type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF') AND r.target_id = ctx.t WHERE ctx.mention = c.mention AND r.source_id = c.person_id) AS lists, EXISTS (SELECT 1 FROM ctx JOIN un ON un.u = ctx.t WHERE ctx.mention = c.mention AND un.person_id = c.person_id) AS member,
    su.u IS NOT NULL AND EXISTS (SELECT 1 FROM ins WHERE ins.person_id = c.person_id AND ins.a = su.u) AS of_page, su.u IS NOT NULL AND EXISTS (SELECT 1 FROM un WHERE un.person_id = c.person_id) AS placed, same.n AS n_same, same.one,
    EXISTS (SELECT 1 FROM pn WHERE pn.person_id = c.person_id AND pn.k = m.k) AS has_key, EXISTS (SELECT 1 FROM man WHERE man.mention = c.mention AND man.person_id = c.person_id AND decision = 'not_same_as') AS rejected
    FROM cand c JOIN m USING (mention) LEFT JOIN su ON su.site = m.site LEFT JOIN same ON same.k = m.k AND same.family = m.family),
  sig AS (SELECT mention, person_id, name_match, rejected, list_filter([CASE WHEN name_match <> 'SLUG_ONLY' THEN name_match END, CASE WHEN fam THEN 'SAME_INSTITUTION_FAMILY' END, CASE WHEN own AND hosted AND NOT trusted THEN 'PROFILE_SLUG_INFERRED_ALIAS' END, CASE WHEN own AND has_host AND NOT hosted THEN 'PROFILE_SLUG_FAMILY_HOST' END,
      CASE WHEN lists THEN 'OWN_PROFILE_LISTS_PROJECT' END, CASE WHEN member THEN 'SOURCE_UNIT_MEMBER' END, CASE WHEN of_page THEN 'SAME_INSTITUTE' END, CASE WHEN n_same = 1 AND one = person_id THEN 'UNIQUE_NAME_IN_FAMILY' END], lambda x: x IS NOT NULL) AS sg,
    list_filter([CASE WHEN own AND name_match NOT IN ({_quoted(M.FULL_NAME)}) THEN 'LINK_NAME_MISMATCH' END, CASE WHEN slug IS NOT NULL AND NOT own AND paged THEN 'LINKS_OTHER_PROFILE' END, CASE WHEN placed AND NOT of_page THEN 'DIFFERENT_INSTITUTE' END, CASE WHEN n_same > 1 AND has_key AND fam THEN 'SAME_NAME_MULTIPLE_PERSONS' END,
      CASE WHEN split_part(k, ' ', 1) IN ({_quoted(COMMON_SURNAMES)}) THEN 'COMMON_SURNAME' END, CASE WHEN rejected THEN 'MANUAL_NOT_SAME_AS' END], lambda x: x IS NOT NULL) AS ng FROM j)"""


@query(f"{_PSIG} SELECT mention, person_id, name_match, array_to_string(sg, ',') AS signals, array_to_string(ng, ',') AS negatives FROM sig")
def person_mention_signals(spark, d):
    """Every candidate person of every mention with its positive and negative signals."""
    _, _, s = _person_signals(spark, d)
    return s.select("mention", "person_id", "name_match", F.array_join("signals", ",").alias("signals"), F.array_join("negatives", ",").alias("negatives"))


def _person_rule_sql() -> str:
    cases = []
    for name, needs, offs in M.PERSON_RULES:
        off = "".join(f" AND NOT list_contains(ng, '{o}')" for o in offs)
        cases.append(f"WHEN list_has_all(sg, [{_quoted(needs)}]){off} THEN '{name}'")
    return f"CASE WHEN NOT list_has_any(sg, [{_quoted(M.FULL_NAME)}]) THEN NULL {' '.join(cases)} END"


def _decision_sql(base: str, target: str, viable: str, rule: str, blocking: list[str], everyone: str, nothing: str, weak: str) -> str:
    return f"""{base}, v AS (SELECT *, {viable} AS viable, {rule} AS rule FROM sig), per AS (SELECT mention, count(*) AS n, count(*) FILTER (viable) AS nv, count(*) FILTER (rejected) AS nr FROM v GROUP BY 1),
  o AS (SELECT v.* FROM v JOIN per USING (mention) WHERE viable AND nv = 1), hand AS (SELECT mention, min({target}) AS h FROM man WHERE decision = 'same_as' GROUP BY 1),
  z AS (SELECT a.mention, n, nv, nr, h, o.{target} AS t, o.rule, list_sort(list_filter(o.ng, lambda x: x IN ({_quoted(blocking)}))) AS bl FROM {everyone} a LEFT JOIN per USING (mention) LEFT JOIN o USING (mention) LEFT JOIN hand USING (mention)),
  y AS (SELECT *, coalesce(nv = 1 AND len(bl) = 0 AND rule IS NOT NULL, false) AS auto FROM z),
  dec AS (SELECT mention, CASE WHEN h IS NOT NULL THEN 'MANUAL_CONFIRMED' WHEN auto THEN 'HIGH_CONFIDENCE_AUTO' WHEN coalesce(n > nr, false) THEN 'REVIEW_REQUIRED' ELSE 'UNRESOLVED' END AS status, coalesce(h, CASE WHEN auto THEN t END) AS {target}, CASE WHEN h IS NOT NULL THEN 'manual:same_as' WHEN auto THEN rule END AS method,
    CASE WHEN h IS NOT NULL OR auto THEN NULL WHEN n IS NULL THEN '{nothing}' WHEN n = nr THEN 'every candidate was rejected manually' WHEN nv = 0 THEN '{weak}' WHEN nv > 1 THEN nv || ' viable candidates' WHEN len(bl) > 0 THEN 'blocked: ' || array_to_string(bl, ', ') ELSE 'no rule satisfied' END AS reason FROM y)"""


_NO_PERSON, _WEAK_NAME = "no canonical person with a compatible name or the linked profile slug", "only weak name evidence (order variant or initials)"
_PDEC = _decision_sql(_PSIG, "person_id", f"NOT rejected AND (list_has_any(sg, [{_quoted(M.FULL_NAME + M.SLUG_SIGNALS)}]) OR list_contains(ng, 'LINK_NAME_MISMATCH'))", _person_rule_sql(), M.PERSON_BLOCKING, "m", _NO_PERSON, _WEAK_NAME)


def person_decisions(spark, d):
    mentions, manual, s = _person_signals(spark, d)
    return mentions, M.decide(mentions, s, "person_id", M.person_viable(), M.person_rule(), M.PERSON_BLOCKING, manual, _NO_PERSON, _WEAK_NAME)


@query(f"{_PDEC} SELECT * FROM dec")
def person_mention_decisions(spark, d):
    """Status, person, rule and reason of every mention."""
    return person_decisions(spark, d)[1]


@query(f"{_PDEC}, g AS (SELECT split_part(mention, '|', 1) AS site, status FROM dec) SELECT coalesce(site, 'all') AS site, count(*) AS mentions, count(*) FILTER (status IN ('MANUAL_CONFIRMED','DETERMINISTIC')) AS certain, count(*) FILTER (status = 'HIGH_CONFIDENCE_AUTO') AS by_rule, count(*) FILTER (status = 'REVIEW_REQUIRED') AS review, count(*) FILTER (status = 'UNRESOLVED') AS unresolved FROM g GROUP BY ROLLUP (site)")
def person_mention_stats(spark, d):
    """Mentions by site and status, with the total."""
    dec = person_decisions(spark, d)[1].select(F.substring_index("mention", "|", 1).alias("site"), "status")
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    g = dec.rollup("site").agg(F.count(F.lit(1)).alias("mentions"), n("MANUAL_CONFIRMED", "DETERMINISTIC").alias("certain"), n("HIGH_CONFIDENCE_AUTO").alias("by_rule"), n("REVIEW_REQUIRED").alias("review"), n("UNRESOLVED").alias("unresolved"))
    return g.withColumn("site", F.coalesce("site", F.lit("all")))


@query(f"""{_PDEC}, men_nodes AS (SELECT men.mention, name, site, status FROM men JOIN dec USING (mention)) SELECT 'node' AS part, mention AS source, name AS target, status AS detail FROM men_nodes
  UNION ALL SELECT 'RESOLVES_TO', mention, person_id, method FROM dec WHERE person_id IS NOT NULL UNION ALL SELECT 'MENTIONED_IN', mention, url, 'stated' FROM men WHERE url IS NOT NULL""")
def person_mention_projection(spark, d):
    """A mention's node, its RESOLVES_TO edge and its MENTIONED_IN edge, as one table of parts."""
    mentions, dec = person_decisions(spark, d)
    nodes = mentions.join(dec.select("mention", "status"), "mention").select(F.lit("node").alias("part"), F.col("mention").alias("source"), F.col("name").alias("target"), F.col("status").alias("detail"))
    to = dec.filter("person_id IS NOT NULL").select(F.lit("RESOLVES_TO").alias("part"), F.col("mention").alias("source"), F.col("person_id").alias("target"), F.col("method").alias("detail"))
    on = mentions.filter("url IS NOT NULL").select(F.lit("MENTIONED_IN").alias("part"), F.col("mention").alias("source"), F.col("url").alias("target"), F.lit("stated").alias("detail"))
    return nodes.unionByName(to).unionByName(on)


@query(f"{_PDEC} SELECT person_id, count(*) AS mentions, count(*) FILTER (status = 'HIGH_CONFIDENCE_AUTO') AS by_rule, string_agg(mention, ',' ORDER BY mention) AS refs FROM dec WHERE person_id IS NOT NULL GROUP BY 1")
def mentions_of_person(spark, d):
    """The resolved mentions of each person."""
    dec = person_decisions(spark, d)[1].filter("person_id IS NOT NULL")
    return dec.groupBy("person_id").agg(F.count(F.lit(1)).alias("mentions"), F.count_if(F.col("status") == "HIGH_CONFIDENCE_AUTO").alias("by_rule"), F.array_join(F.array_sort(F.collect_list("mention")), ",").alias("refs"))


# project mentions: the titles of project pages
_PM = f"""man AS (SELECT NULL::VARCHAR AS mention, NULL::VARCHAR AS project_id, NULL::VARCHAR AS decision WHERE false),
  raw AS (SELECT document_id AS mention, min(page_title) AS title, min(source_id) AS site FROM documents WHERE source = 'project_pages' AND document_id IS NOT NULL AND trim(page_title) <> '' GROUP BY 1),
  s1 AS (SELECT *, title AS t, {_stripped('title')} AS st FROM raw),
  pmn AS (SELECT mention, site, {_FOLD.format('title')} AS fold, {_FOLD.format("CASE WHEN st = '' THEN title ELSE st END")} AS k, {_GRANTS} AS gs FROM s1)"""
_PF = f"""pt AS (SELECT DISTINCT canonical_id AS project_id, t FROM (SELECT canonical_id, unnest(list_concat([title], coalesce(alternate_titles, []))) AS t FROM project) WHERE t IS NOT NULL),
  pk AS (SELECT DISTINCT project_id, {_FOLD.format('t')} AS fold, {_FOLD.format("CASE WHEN st = '' THEN t ELSE st END")} AS k FROM (SELECT *, {_stripped('t')} AS st FROM pt)),
  pg AS (SELECT DISTINCT project_id, unnest({_GRANTS}) AS g FROM (SELECT project_id, t FROM pt UNION ALL SELECT canonical_id, grant_id FROM project WHERE grant_id IS NOT NULL)),
  ps AS (SELECT canonical_id AS project_id, min(split_part(source_refs[1], '|', 1)) AS site FROM project GROUP BY 1)"""
_GOES_ON = f"((length(a) >= {M.MIN_PREFIX} AND starts_with(b, a || ' ')) OR (length(b) >= {M.MIN_PREFIX} AND starts_with(a, b || ' ')))"
_JSIG = f"""WITH {_PM}, {_PF}, mg AS (SELECT mention, unnest(gs) AS g FROM pmn),
  pre AS (SELECT DISTINCT mention, project_id FROM (SELECT mention, project_id, pmn.k AS a, pk.k AS b FROM pmn JOIN pk ON substr(pmn.k, 1, {M.MIN_PREFIX}) = substr(pk.k, 1, {M.MIN_PREFIX}) WHERE pk.k <> '') WHERE {_GOES_ON}),
  cand AS (SELECT mention, project_id FROM pmn JOIN pk USING (k) WHERE k <> '' UNION SELECT mention, project_id FROM mg JOIN pg USING (g) UNION SELECT * FROM pre),
  j AS (SELECT c.*, CASE WHEN EXISTS (SELECT 1 FROM pk WHERE pk.project_id = c.project_id AND pk.fold = pmn.fold) THEN 'TITLE_EXACT' WHEN EXISTS (SELECT 1 FROM pk WHERE pk.project_id = c.project_id AND pk.k = pmn.k AND pk.k <> '') THEN 'TITLE_EQUAL_AFTER_AFFIXES' WHEN (c.mention, c.project_id) IN (SELECT (mention, project_id) FROM pre) THEN 'TITLE_PREFIX' END AS title_match,
    EXISTS (SELECT 1 FROM mg JOIN pg USING (g) WHERE mg.mention = c.mention AND pg.project_id = c.project_id) AS shared, len(pmn.gs) > 0 AS mgr, EXISTS (SELECT 1 FROM pg WHERE pg.project_id = c.project_id) AS pgr, coalesce(pmn.site = ps.site, false) AS home, pmn.mention AS mm FROM cand c JOIN pmn USING (mention) JOIN ps USING (project_id)),
  cues AS (SELECT mention, title FROM raw),
  sig AS (SELECT mention, project_id, title_match, false AS rejected, list_filter([title_match, CASE WHEN shared THEN 'GRANT_ID_MATCH' END, CASE WHEN home THEN 'SAME_SITE' END], lambda x: x IS NOT NULL) AS sg,
    list_filter([CASE WHEN NOT shared AND mgr AND pgr THEN 'GRANT_ID_CONFLICT' END, CASE WHEN {" OR ".join(f"regexp_matches(title, '{rule.replace('(?iu)', '(?i)')}')" for rule in text.CUES.values())} THEN 'ACTIVITY_CUE' END], lambda x: x IS NOT NULL) AS ng FROM j JOIN cues USING (mention))"""


def _project_signals(spark, d):
    docs = read_table(spark, d, "documents", "document_id", "page_title", "source", "source_id").filter("source = 'project_pages' AND document_id IS NOT NULL AND trim(page_title) <> ''")
    m = docs.groupBy(F.col("document_id").alias("mention")).agg(F.min("page_title").alias("title"), F.min("source_id").alias("site"))
    m = m.select("mention", "title", text.grant_keys(F.col("title")).alias("grants"), F.lit(None).cast("int").alias("first_year"), F.lit(None).cast("int").alias("last_year"), F.lit(None).cast("string").alias("url"), "site", F.lit(None).cast("string").alias("owner"))
    facts = cut(M.project_facts(read_table(spark, d, "project", "canonical_id", "title", "alternate_titles", "grant_id", "start", "end", "website", "source_refs")))
    owners = spark.createDataFrame([], "project_id string, person_id string")
    manual = spark.createDataFrame([], "mention string, project_id string, decision string")
    m = cut(M.keyed_titles(m))
    return m, manual, cut(M.project_signals(m, facts, owners, manual))


@query(f"{_JSIG} SELECT mention, project_id, title_match, array_to_string(sg, ',') AS signals, array_to_string(ng, ',') AS negatives FROM sig")
def project_mention_signals(spark, d):
    """Candidate projects of the titles of project pages with their signals."""
    s = _project_signals(spark, d)[2]
    return s.select("mention", "project_id", "title_match", F.array_join("signals", ",").alias("signals"), F.array_join("negatives", ",").alias("negatives"))


def _project_rule_sql() -> str:
    return "CASE " + " ".join(f"WHEN list_has_any(sg, [{_quoted(a)}]) AND list_has_any(sg, [{_quoted(b)}]) THEN '{n}'" for n, a, b in M.PROJECT_RULES) + " END"


_NO_PROJECT, _WEAK_TITLE = "no anchored project with a compatible title or grant id", "every candidate is blocked"
_JDEC = _decision_sql(_JSIG, "project_id", f"NOT rejected AND NOT list_has_any(ng, [{_quoted(M.PROJECT_BLOCKING)}]) AND list_has_any(sg, [{_quoted([*M.TITLE_SIGNALS, 'GRANT_ID_MATCH'])}])", _project_rule_sql(), M.PROJECT_BLOCKING, "pmn", _NO_PROJECT, _WEAK_TITLE)


@query(f"{_JDEC} SELECT * FROM dec")
def project_mention_decisions(spark, d):
    """Status, project, rule and reason of every title on a project page; title evidence alone decides nothing."""
    m, manual, s = _project_signals(spark, d)
    return M.decide(m, s, "project_id", M.project_viable(), M.project_rule(), M.PROJECT_BLOCKING, manual, _NO_PROJECT, _WEAK_TITLE)


# structural and manual matches
@query(f"""WITH o AS (SELECT r AS ref, entity_type AS t, split_part(r, '|', 1) AS site, {key_sql('label')} AS k FROM (SELECT DISTINCT unnest(source_refs) AS r, entity_type, label FROM org_units WHERE label IS NOT NULL)),
  f AS (SELECT t, site, k, min(ref) AS first FROM o GROUP BY ALL) SELECT DISTINCT first AS "left", ref AS "right", t AS entity_type, 'auto:same_site_same_name' AS method, 0.95 AS score FROM o JOIN f USING (t, site, k) WHERE ref <> first""")
def structural_matches(spark, d):
    """Units of one name within one site, each joined to the first of its group."""
    o = read_table(spark, d, "org_units", "source_refs", "entity_type", "label").filter("label IS NOT NULL").select(F.explode("source_refs").alias("ref"), F.col("entity_type").alias("t"), "label").distinct()
    return ER.structural_matches(o.select("ref", "t", text.name_key(F.col("label")).alias("k")))


@query("""SELECT least("left", "right") AS a, greatest("left", "right") AS b, entity_type, CASE WHEN bool_or(method = 'manual:same_as') THEN 'CONFIRMED' ELSE 'REJECTED' END AS status FROM matches
  WHERE method LIKE 'manual:%' AND entity_type <> 'Person' AND "left" IS NOT NULL AND "right" IS NOT NULL AND "left" <> "right" GROUP BY ALL""")
def manual_matches(spark, d):
    """Reviewed pairs of records other than people; a confirmation stands before a rejection of the same pair."""
    m = read_table(spark, d, "matches", "left", "right", "entity_type", "method").filter("method LIKE 'manual:%' AND entity_type <> 'Person' AND `left` IS NOT NULL AND `right` IS NOT NULL AND `left` <> `right`")
    yes = F.bool_or(F.col("method") == "manual:same_as")
    return m.groupBy(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b"), "entity_type").agg(F.when(yes, "CONFIRMED").otherwise("REJECTED").alias("status"))


_RECS = f"""r0 AS (SELECT unnest(source_refs) AS ref, label, canonical_name AS cn, alternate_names AS an, orcid, mtmt_id FROM person),
  lab AS (SELECT DISTINCT ref, n FROM (SELECT ref, label AS n FROM r0 UNION ALL SELECT ref, cn FROM r0 UNION ALL SELECT ref, unnest(an) FROM r0) WHERE n IS NOT NULL),
  ks AS (SELECT ref, {key_sql('n')} AS k, {_FREE.format(key_sql('n'))} AS f FROM lab), ids AS (SELECT DISTINCT ref, 'orcid' AS kind, orcid AS v FROM r0 WHERE orcid IS NOT NULL UNION SELECT DISTINCT ref, 'mtmt', mtmt_id FROM r0 WHERE mtmt_id IS NOT NULL),
  bl AS (SELECT ref, 'name|' || f AS b FROM ks WHERE f <> '' UNION SELECT ref, kind || '|' || v FROM ids), pr AS (SELECT DISTINCT a.ref AS a, b.ref AS b FROM bl a JOIN bl b ON a.b = b.b AND a.ref < b.ref)"""


def records(spark, d):
    """(ref, keys, free_keys, hard_ids, family, slug): one row for each source record of a person."""
    p = read_table(spark, d, "person", "source_refs", "label", "canonical_name", "alternate_names", "orcid", "mtmt_id").select(F.explode("source_refs").alias("ref"), "label", "canonical_name", "alternate_names", "orcid", "mtmt_id")
    names = F.filter(F.concat(F.array("label", "canonical_name"), F.coalesce("alternate_names", F.array().cast("array<string>"))), lambda n: n.isNotNull())
    ids = F.array_compact(F.array(F.concat(F.lit("orcid:"), "orcid"), F.concat(F.lit("mtmt:"), "mtmt_id")))
    flat = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    g = p.filter("ref IS NOT NULL").groupBy("ref").agg(flat(F.filter(F.transform(names, text.name_key), lambda k: k != "")).alias("keys"), flat(ids).alias("hard_ids"))
    free = F.array_distinct(F.transform("keys", lambda k: F.array_join(F.array_sort(F.split(k, " ")), " ")))
    return g.select("ref", "keys", free.alias("free_keys"), "hard_ids", urls.site_family(F.col("ref")).alias("family"), urls.slug_of(urls.ref_url(F.col("ref"))).alias("slug"))


@query(f"WITH {_RECS} SELECT a, b FROM pr")
def candidate_pairs(spark, d):
    """Pairs of source records that share a hard id or an order-free name key, over all labels of a record."""
    return ER.candidate_pairs(records(spark, d))


@query(f"""WITH {_RECS}, x AS (SELECT a, b, EXISTS (SELECT 1 FROM ids i JOIN ids j ON i.kind = j.kind AND i.v = j.v WHERE i.ref = a AND j.ref = b) AS agrees,
    EXISTS (SELECT 1 FROM ids i JOIN ids j ON i.kind = j.kind WHERE i.ref = a AND j.ref = b AND NOT EXISTS (SELECT 1 FROM ids y JOIN ids z ON y.kind = z.kind AND y.v = z.v WHERE y.ref = a AND z.ref = b AND y.kind = i.kind)) AS conflicts,
    EXISTS (SELECT 1 FROM (SELECT k FROM ks WHERE ref = a UNION ALL SELECT f FROM ks WHERE ref = a) p JOIN (SELECT k FROM ks WHERE ref = b UNION ALL SELECT f FROM ks WHERE ref = b) q ON p.k = q.k AND p.k <> '') AS names,
    (split_part(split_part(a, '|', 1), '_', 1) = split_part(split_part(b, '|', 1), '_', 1))::INT + coalesce((nullif(regexp_extract(a, '/kutato/([^/?#]+)', 1), '') = nullif(regexp_extract(b, '/kutato/([^/?#]+)', 1), ''))::INT, 0) AS s FROM pr)
  SELECT a, b, CASE WHEN conflicts THEN 'REJECTED' WHEN agrees AND names THEN 'CONFIRMED' ELSE 'POSSIBLE' END AS status, CASE WHEN conflicts THEN 'auto:conflicting_hard_id' WHEN agrees AND names THEN 'auto:hard_id+name' WHEN agrees THEN 'auto:hard_id_name_mismatch' ELSE 'auto:same_name' END AS method,
  CAST(CASE WHEN conflicts THEN 0 WHEN agrees AND names THEN 1 WHEN agrees THEN 0.6 ELSE least(0.85, round(0.4 + 0.15 * s, 2)) END AS DOUBLE) AS score FROM x""")
def pair_verdicts(spark, d):
    """The first rule that holds: a kind of id without a common value rejects, a common id with names confirms."""
    return ER.pair_verdicts(records(spark, d))


@query(f"WITH {_RECS}, s AS (SELECT a, b FROM (SELECT least(\"left\", \"right\") AS a, greatest(\"left\", \"right\") AS b, lower(trim(status)) AS t FROM matches) WHERE t = 'possible_match' AND a IS NOT NULL AND a <> b GROUP BY 1, 2) SELECT a, b, (a IN (SELECT ref FROM ks) AND b IN (SELECT ref FROM ks)) AS both_anchored FROM s")
def review_queue(spark, d):
    """Possible matches for review; pairs of anchored records first in the written queue."""
    m = read_table(spark, d, "matches", "left", "right", "status").filter("lower(trim(status)) = 'possible_match' AND `left` <> `right`").select(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b")).distinct()
    refs = read_table(spark, d, "person", "source_refs").select(F.explode("source_refs").alias("r")).filter("r IS NOT NULL").distinct()
    of = lambda c: refs.select(F.col("r").alias(c), F.lit(True).alias(f"has_{c}"))
    return m.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", (F.coalesce("has_a", F.lit(False)) & F.coalesce("has_b", F.lit(False))).alias("both_anchored"))


QUERIES, ORACLES = R.queries, R.oracles
