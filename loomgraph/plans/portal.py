"""Queries of the portal: search, profiles, directories, terms, units, notices, ego views, projections for display."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomgraph.functions import text, urls
from loomgraph.operators import graph as G
from loomgraph.operators.skew import salted_join
from loomgraph.operators.windows import best_row
from loomgraph.plans.graphs import _MEM, membership
from loomgraph.plans.identity import _MEN, _PEOPLE, people, person_mentions
from loomgraph.plans.registry import Registry
from loomgraph.plans.structure import _REL, _UP, part_of, relations
from loomgraph.session import cut
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query

_FOLD = "trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g'))"


def tokens(words, q):
    """Best hit of a query word among the words: equal 1, begun .85, alike from .45 on .8 of the likeness (words of four letters and more)."""
    like = lambda w: text.jaccard(text.trigrams(w), text.trigrams(F.lit(q)))
    return F.array_max(F.transform(words, lambda w: F.when(w == q, 1.0).when(F.startswith(w, F.lit(q)), 0.85).when(F.lit(len(q) >= 4) & (like(w) >= 0.45), 0.8 * like(w)).otherwise(0.0)))


_TRI = lambda x: f"list_distinct([substr('  ' || {x} || ' ', CAST(i AS BIGINT), 3) for i in range(1, length({x}) + 2)])"
_SIM = lambda w, q: f"(len(list_intersect({_TRI(w)}, {_TRI(q)}))::DOUBLE / len(list_distinct(list_concat({_TRI(w)}, {_TRI(q)}))))"
_HIT = lambda q: f"list_max([CASE WHEN w = '{q}' THEN 1.0 WHEN starts_with(w, '{q}') THEN 0.85 WHEN {str(len(q) >= 4).lower()} AND {_SIM('w', chr(39) + q + chr(39))} >= 0.45 THEN 0.8 * {_SIM('w', chr(39) + q + chr(39))} ELSE 0.0 END for w in string_split(k, ' ')])"
_Q = ("bebodor", "noemi")
_SCORED = f"""sc AS (SELECT kind, id, name, k, {_HIT(_Q[0])} AS a, {_HIT(_Q[1])} AS b FROM docs WHERE k <> ''), s2 AS (SELECT kind, id, name, CAST(round(1000000 * (a + b) / 2 * CASE WHEN contains(k, '{" ".join(_Q)}') THEN 1.0 ELSE 0.9 END * CASE kind WHEN 'mention' THEN 0.9 ELSE 1.0 END) AS BIGINT) AS score FROM sc WHERE a > 0 AND b > 0)"""


@query(f"""WITH {_PEOPLE}, {_MEN}, docs AS (SELECT 'person' AS kind, canonical_id AS id, label AS name, {_FOLD.format('label')} AS k FROM people WHERE label IS NOT NULL UNION SELECT 'project', canonical_id, title, {_FOLD.format('title')} FROM project WHERE title IS NOT NULL UNION SELECT 'unit', canonical_id, label, {_FOLD.format('label')} FROM org_units WHERE label IS NOT NULL
  UNION SELECT 'mention', mention, name, {_FOLD.format('name')} FROM men), {_SCORED} SELECT kind, id, name, score, place FROM (SELECT *, row_number() OVER (PARTITION BY kind = 'mention' ORDER BY score DESC, id, name) AS place FROM s2) WHERE place <= CASE kind WHEN 'mention' THEN 4 ELSE 10 END""")
def search(spark, d, q: tuple[str, ...] = _Q):
    """Ten best entities of all kinds, then four best mentions at nine tenths of their score: every word of the query must be met."""
    row = lambda kind, df, i, n: df.select(F.lit(kind).alias("kind"), F.col(i).alias("id"), F.col(n).alias("name")).filter("name IS NOT NULL").distinct()
    docs = reduce(lambda a, b: a.unionByName(b), [
        row("person", people(spark, d, "label"), "canonical_id", "label"), row("project", read_table(spark, d, "project", "canonical_id", "title"), "canonical_id", "title"),
        row("unit", read_table(spark, d, "org_units", "canonical_id", "label"), "canonical_id", "label"), row("mention", person_mentions(spark, d), "mention", "name"),
    ]).withColumn("k", text.title_fold(F.col("name"))).filter("k <> ''")
    words = F.split("k", " ")
    hits = docs.select("kind", "id", "name", "k", F.array(*[tokens(words, w) for w in q]).alias("h")).filter(F.forall("h", lambda x: x > 0))
    total = F.aggregate("h", F.lit(0.0), lambda a, x: a + x) / len(q)
    score = total * F.when(F.contains("k", F.lit(" ".join(q))), 1.0).otherwise(0.9) * F.when(F.col("kind") == "mention", 0.9).otherwise(1.0)
    scored = hits.select("kind", "id", "name", F.round(1_000_000 * score).cast("bigint").alias("score"))
    best = lambda df, n: df.orderBy(F.desc("score"), "id", "name").limit(n)
    top = best(scored.filter("kind <> 'mention'"), 10).unionByName(best(scored.filter("kind = 'mention'"), 4))
    w = Window.partitionBy(F.col("kind") == "mention").orderBy(F.desc("score"), "id", "name")
    return top.withColumn("place", F.row_number().over(w))


@query(f"""WITH {_PEOPLE}, {_REL}, {_MEM}, u AS (SELECT source_id AS p, string_agg(DISTINCT target_id, ',' ORDER BY target_id) AS units FROM r WHERE type IN ('AFFILIATED_WITH','MEMBER_OF') GROUP BY 1), l AS (SELECT source_id AS p, string_agg(target_id, ',' ORDER BY target_id) AS led FROM r WHERE type = 'PRINCIPAL_INVESTIGATOR_OF' GROUP BY 1),
  t AS (SELECT source_id AS p, string_agg(target_id, ',' ORDER BY target_id) AS took FROM r x WHERE type = 'PARTICIPATES_IN' AND NOT EXISTS (SELECT 1 FROM r y WHERE y.type = 'PRINCIPAL_INVESTIGATOR_OF' AND y.source_id = x.source_id AND y.target_id = x.target_id) GROUP BY 1), c AS (SELECT a.person AS p, count(DISTINCT b.person) AS n FROM m a JOIN m b ON a.project = b.project AND a.person <> b.person GROUP BY 1),
  o AS (SELECT person_id AS p, count(DISTINCT mention) AS n FROM man WHERE decision = 'same_as' GROUP BY 1), {_MEN} SELECT canonical_id, coalesce(units, '') AS units, coalesce(led, '') AS led, coalesce(took, '') AS participated, coalesce(c.n, 0) AS co_participants, coalesce(o.n, 0) AS confirmed_mentions FROM people LEFT JOIN u ON u.p = canonical_id LEFT JOIN l ON l.p = canonical_id LEFT JOIN t ON t.p = canonical_id LEFT JOIN c ON c.p = canonical_id LEFT JOIN o ON o.p = canonical_id""".replace(f"o AS (SELECT person_id AS p, count(DISTINCT mention) AS n FROM man WHERE decision = 'same_as' GROUP BY 1), {_MEN}", f"{_MEN}, o AS (SELECT person_id AS p, count(DISTINCT mention) AS n FROM man WHERE decision = 'same_as' GROUP BY 1)"))
def person_profile(spark, d):
    """Units, projects led, projects taken part in besides, co-participants and confirmed mentions of every person."""
    from loomgraph.plans.identity import manual_decisions

    p = people(spark, d).select("canonical_id")
    r = relations(spark, d)
    listed = lambda df, name: df.groupBy(F.col("source_id").alias("canonical_id")).agg(F.array_join(F.array_sort(F.collect_set("target_id")), ",").alias(name))
    led = r.filter("type = 'PRINCIPAL_INVESTIGATOR_OF'").select("source_id", "target_id")
    took = r.filter("type = 'PARTICIPATES_IN'").select("source_id", "target_id").join(led, ["source_id", "target_id"], "left_anti")
    t = G.ties(membership(spark, d))
    co = t.select(F.explode(F.array("a", "b")).alias("canonical_id")).groupBy("canonical_id").agg(F.count(F.lit(1)).alias("co_participants"))
    mine = manual_decisions(spark, d, person_mentions(spark, d)).filter("decision = 'same_as'").groupBy(F.col("person_id").alias("canonical_id")).agg(F.countDistinct("mention").alias("confirmed_mentions"))
    out = p
    for part in (listed(r.filter("type IN ('AFFILIATED_WITH', 'MEMBER_OF')"), "units"), listed(led, "led"), listed(took, "participated"), co, mine):
        out = out.join(part, "canonical_id", "left")
    return out.fillna("", ["units", "led", "participated"]).fillna(0, ["co_participants", "confirmed_mentions"])


@query(f"""WITH {_REL}, pj AS (SELECT canonical_id, min(title) AS title, string_agg(DISTINCT grant_id, ',' ORDER BY grant_id) AS grants, min("start") AS s, max("end") AS e FROM project GROUP BY 1), l AS (SELECT target_id AS p, string_agg(source_id, ',' ORDER BY source_id) AS leads FROM r WHERE type = 'PRINCIPAL_INVESTIGATOR_OF' GROUP BY 1),
  t AS (SELECT target_id AS p, string_agg(source_id, ',' ORDER BY source_id) AS others FROM r x WHERE type = 'PARTICIPATES_IN' AND NOT EXISTS (SELECT 1 FROM r y WHERE y.type = 'PRINCIPAL_INVESTIGATOR_OF' AND y.source_id = x.source_id AND y.target_id = x.target_id) GROUP BY 1), h AS (SELECT source_id AS p, string_agg(target_id, ',' ORDER BY target_id) AS hosts FROM r WHERE type = 'HOSTED_BY' GROUP BY 1)
  SELECT canonical_id, title, coalesce(grants, '') AS grants, s AS begun, e AS ended, coalesce(leads, '') AS leads, coalesce(others, '') AS others, coalesce(hosts, '') AS hosts FROM pj LEFT JOIN l ON l.p = canonical_id LEFT JOIN t ON t.p = canonical_id LEFT JOIN h ON h.p = canonical_id""")
def project_profile(spark, d):
    """Title, grants, span, leads, other participants and hosts of every project."""
    p = read_table(spark, d, "project", "canonical_id", "title", "grant_id", "start", "end").groupBy("canonical_id").agg(F.min("title").alias("title"), F.array_join(F.array_sort(F.collect_set("grant_id")), ",").alias("grants"), F.min("start").alias("begun"), F.max("end").alias("ended"))
    r = relations(spark, d)
    listed = lambda df, end, other, name: df.groupBy(F.col(end).alias("canonical_id")).agg(F.array_join(F.array_sort(F.collect_set(other)), ",").alias(name))
    led = r.filter("type = 'PRINCIPAL_INVESTIGATOR_OF'").select("source_id", "target_id")
    took = r.filter("type = 'PARTICIPATES_IN'").select("source_id", "target_id").join(led, ["source_id", "target_id"], "left_anti")
    out = p
    for part in (listed(led, "target_id", "source_id", "leads"), listed(took, "target_id", "source_id", "others"), listed(r.filter("type = 'HOSTED_BY'"), "source_id", "target_id", "hosts")):
        out = out.join(part, "canonical_id", "left")
    return out.fillna("", ["grants", "leads", "others", "hosts"])


@query(f"""WITH RECURSIVE {_REL}, {_UP}, tr AS (SELECT canonical_id AS root, canonical_id AS u FROM org_units UNION SELECT a, n FROM up WHERE a IN (SELECT canonical_id FROM org_units)), pe AS (SELECT root, source_id AS p FROM tr JOIN r ON r.target_id = tr.u WHERE type IN ('AFFILIATED_WITH','MEMBER_OF')), ch AS (SELECT target_id AS root, count(*) AS n FROM r WHERE type = 'PART_OF' AND source_id <> target_id GROUP BY 1),
  tp AS (SELECT DISTINCT subject.canonical_id AS p, object.canonical_id AS t FROM claims WHERE predicate = 'WORKS_ON_TOPIC' AND object.canonical_id IS NOT NULL), tt AS (SELECT root, t, count(DISTINCT p) AS n FROM pe JOIN tp USING (p) GROUP BY 1, 2), t1 AS (SELECT root, t, n FROM tt QUALIFY row_number() OVER (PARTITION BY root ORDER BY n DESC, t) = 1)
  SELECT canonical_id, label, coalesce(ch.n, 0) AS children, coalesce(m.n, 0) AS people, t1.t AS top_topic, coalesce(t1.n, 0) AS topic_people FROM (SELECT DISTINCT canonical_id, label FROM org_units) o LEFT JOIN ch ON ch.root = canonical_id LEFT JOIN (SELECT root, count(DISTINCT p) AS n FROM pe GROUP BY 1) m ON m.root = canonical_id LEFT JOIN t1 ON t1.root = canonical_id""")
def unit_profile(spark, d):
    """People of a unit's whole subtree, its children and the topic most of those people work on."""
    u = read_table(spark, d, "org_units", "canonical_id", "label").distinct()
    r = relations(spark, d)
    up = G.closure(part_of(spark, d))
    tree = u.select(F.col("canonical_id").alias("root"), F.col("canonical_id").alias("target_id")).unionByName(up.select(F.col("ancestor").alias("root"), F.col("node").alias("target_id"))).distinct()
    members = r.filter("type IN ('AFFILIATED_WITH', 'MEMBER_OF')").select("target_id", F.col("source_id").alias("p"))
    pe = cut(salted_join(members, tree, "target_id", "inner").select("root", "p").distinct())
    c = read_table(spark, d, "claims", "predicate", "subject", "object").filter("predicate = 'WORKS_ON_TOPIC' AND object.canonical_id IS NOT NULL AND subject.canonical_id IS NOT NULL")
    topics = c.select(F.col("subject.canonical_id").alias("p"), F.col("object.canonical_id").alias("top_topic")).distinct()
    best = best_row(pe.join(topics, "p").groupBy("root", "top_topic").agg(F.countDistinct("p").alias("topic_people")), ["root"], F.desc("topic_people"), F.asc("top_topic"))
    children = r.filter("type = 'PART_OF' AND source_id <> target_id").groupBy(F.col("target_id").alias("root")).agg(F.count(F.lit(1)).alias("children"))
    out = u.withColumnRenamed("canonical_id", "root")
    for part in (children, pe.groupBy("root").agg(F.countDistinct("p").alias("people")), best):
        out = out.join(part, "root", "left")
    return out.fillna(0, ["children", "people", "topic_people"]).withColumnRenamed("root", "canonical_id")


_TERMS = "t AS (SELECT DISTINCT subject.canonical_id AS p, value AS term FROM claims WHERE predicate = 'research_area' AND value IS NOT NULL AND subject.canonical_id IS NOT NULL)"


@query(f"""WITH {_REL}, {_TERMS}, co AS (SELECT a.term, b.term AS other, count(*) AS n FROM t a JOIN t b ON a.p = b.p AND a.term <> b.term GROUP BY 1, 2), un AS (SELECT term, target_id AS u, count(*) AS n FROM t JOIN r ON source_id = p WHERE type = 'MEMBER_OF' GROUP BY 1, 2), s AS (SELECT term, count(*) AS n FROM t GROUP BY 1)
  SELECT s.term, s.n AS people, (SELECT count(*) FROM co WHERE co.term = s.term) AS related, (SELECT arg_max(other, (n, -1)) FROM (SELECT other, n FROM co WHERE co.term = s.term ORDER BY n DESC, other LIMIT 1)) AS closest, (SELECT count(*) FROM un WHERE un.term = s.term) AS units FROM s""")
def term_profile(spark, d):
    """People, related terms, the closest one and the units of every stated research area."""
    c = read_table(spark, d, "claims", "predicate", "subject", "value").filter("predicate = 'research_area' AND value IS NOT NULL AND subject.canonical_id IS NOT NULL")
    t = cut(c.select(F.col("subject.canonical_id").alias("p"), F.col("value").alias("term")).distinct())
    co = t.join(t.withColumnRenamed("term", "other"), "p").filter("term <> other").groupBy("term", "other").agg(F.count(F.lit(1)).alias("n"))
    near = co.groupBy("term").agg(F.count(F.lit(1)).alias("related"), F.min(F.struct((-F.col("n")).alias("n"), "other")).alias("b")).select("term", "related", F.col("b.other").alias("closest"))
    un = t.join(relations(spark, d, "MEMBER_OF").select(F.col("source_id").alias("p"), "target_id"), "p").groupBy("term").agg(F.countDistinct("target_id").alias("units"))
    return t.groupBy("term").agg(F.count(F.lit(1)).alias("people")).join(near, "term", "left").join(un, "term", "left").fillna(0, ["related", "units"])


@query("""SELECT value AS term, count(DISTINCT subject.canonical_id) AS people, count(DISTINCT claim_id) AS claims, string_agg(DISTINCT coalesce(derivation_method, 'stated'), ',' ORDER BY coalesce(derivation_method, 'stated')) AS derivations, min(snippet) AS example FROM claims WHERE predicate = 'research_area' AND value IS NOT NULL GROUP BY 1""")
def term_links(spark, d):
    """How each term is linked to people: stated or derived, by how many claims, with an example."""
    c = read_table(spark, d, "claims", "predicate", "subject", "value", "claim_id", "derivation_method", "snippet").filter("predicate = 'research_area' AND value IS NOT NULL")
    how = F.coalesce("derivation_method", F.lit("stated"))
    return c.groupBy(F.col("value").alias("term")).agg(F.countDistinct("subject.canonical_id").alias("people"), F.countDistinct("claim_id").alias("claims"), F.array_join(F.array_sort(F.collect_set(how)), ",").alias("derivations"), F.min("snippet").alias("example"))


@query(f"""WITH RECURSIVE {_PEOPLE}, {_REL}, {_UP}, un AS (SELECT canonical_id AS u FROM org_units WHERE unit_type IN ('institute','department') UNION SELECT n FROM up WHERE a IN (SELECT canonical_id FROM org_units WHERE unit_type IN ('institute','department'))) SELECT canonical_id, label, count(*) AS terms FROM people JOIN (SELECT DISTINCT subject.canonical_id AS p, value FROM claims WHERE predicate = 'research_area' AND value IS NOT NULL) t ON t.p = canonical_id
  WHERE {_FOLD.format('label')} LIKE '%an%' AND canonical_id IN (SELECT source_id FROM r WHERE type = 'AFFILIATED_WITH' AND target_id IN (SELECT u FROM un)) GROUP BY 1, 2""")
def directory_people(spark, d, q: str = "an", kinds: tuple[str, ...] = ("institute", "department")):
    """People by text, subtree of units and stated terms; text and kinds are parameters."""
    p = people(spark, d, "label").filter(F.contains(text.title_fold(F.col("label")), F.lit(q))).select("canonical_id", "label")
    top = read_table(spark, d, "org_units", "canonical_id", "unit_type").filter(F.col("unit_type").isin(*kinds)).select(F.col("canonical_id").alias("u")).distinct()
    below = G.closure(part_of(spark, d)).join(top.withColumnRenamed("u", "ancestor"), "ancestor", "left_semi").select(F.col("node").alias("u"))
    at = relations(spark, d, "AFFILIATED_WITH").withColumnRenamed("target_id", "u").join(top.unionByName(below).distinct(), "u", "left_semi").select(F.col("source_id").alias("canonical_id"))
    c = read_table(spark, d, "claims", "predicate", "subject", "value").filter("predicate = 'research_area' AND value IS NOT NULL AND subject.canonical_id IS NOT NULL")
    terms = c.groupBy(F.col("subject.canonical_id").alias("canonical_id")).agg(F.countDistinct("value").alias("terms"))
    return p.join(at, "canonical_id", "left_semi").join(terms, "canonical_id")


@query(f"""WITH {_MEM}, z AS (SELECT project, count(*) AS n FROM m GROUP BY 1), pj AS (SELECT canonical_id, max(coalesce(status_label, 'none')) AS status, min(title) AS title FROM project GROUP BY 1), h AS (SELECT DISTINCT source_id AS p FROM relations WHERE type = 'HOSTED_BY' AND target_id IN (SELECT canonical_id FROM org_units))
  SELECT canonical_id, status, coalesce(n, 0) AS people FROM pj LEFT JOIN z ON project = canonical_id WHERE {_FOLD.format('title')} LIKE '%ok%' AND canonical_id IN (SELECT p FROM h) AND coalesce(n, 0) >= 1""")
def directory_projects(spark, d, q: str = "ok", statuses: tuple[str, ...] | None = None, least: int = 1):
    """Projects by text, host, status (``none`` where nothing is stated) and number of people."""
    p = read_table(spark, d, "project", "canonical_id", "status_label", "title").groupBy("canonical_id").agg(F.max(F.coalesce("status_label", F.lit("none"))).alias("status"), F.min("title").alias("title"))
    p = p.filter(F.contains(text.title_fold(F.col("title")), F.lit(q)))
    p = p.filter(F.col("status").isin(*statuses)) if statuses else p
    units = read_table(spark, d, "org_units", "canonical_id").select(F.col("canonical_id").alias("target_id")).distinct()
    hosted = relations(spark, d, "HOSTED_BY").join(units, "target_id", "left_semi").select(F.col("source_id").alias("canonical_id"))
    z = membership(spark, d).groupBy(F.col("project").alias("canonical_id")).agg(F.count(F.lit(1)).alias("people"))
    return p.join(hosted, "canonical_id", "left_semi").join(z, "canonical_id", "left").fillna(0, ["people"]).filter(F.col("people") >= least).select("canonical_id", "status", "people")


@query("""SELECT (SELECT count(DISTINCT canonical_id) FROM person) AS persons, (SELECT count(DISTINCT canonical_id) FROM project) AS projects, (SELECT count(DISTINCT canonical_id) FROM org_units WHERE entity_type = 'Institution') AS institutions, (SELECT count(DISTINCT canonical_id) FROM org_units WHERE entity_type <> 'Institution') AS units, (SELECT count(DISTINCT relation_id) FROM relations) AS relations,
  (SELECT count(DISTINCT relation_id) FROM relations WHERE type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF')) AS project_edges, (SELECT count(DISTINCT claim_id) FROM claims) AS claims, (SELECT count(DISTINCT document_id) FROM documents) AS documents, (SELECT count(DISTINCT source_id) FROM documents) AS sources, (SELECT count(DISTINCT value) FROM claims WHERE predicate = 'research_area') AS terms, (SELECT count(DISTINCT source_id) FROM relations WHERE type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF')) AS persons_with_project""")
def overview(spark, d):
    """Eleven figures of the whole graph."""
    on = lambda c, where: F.countDistinct(F.when(F.expr(where), F.col(c)))
    edge = "type IN ('PARTICIPATES_IN', 'PRINCIPAL_INVESTIGATOR_OF')"
    parts = [
        read_table(spark, d, "person", "canonical_id").agg(F.countDistinct("canonical_id").alias("persons")), read_table(spark, d, "project", "canonical_id").agg(F.countDistinct("canonical_id").alias("projects")),
        read_table(spark, d, "org_units", "canonical_id", "entity_type").agg(on("canonical_id", "entity_type = 'Institution'").alias("institutions"), on("canonical_id", "entity_type <> 'Institution'").alias("units")),
        read_table(spark, d, "relations", "relation_id", "type", "source_id").agg(F.countDistinct("relation_id").alias("relations"), on("relation_id", edge).alias("project_edges"), on("source_id", edge).alias("persons_with_project")),
        read_table(spark, d, "claims", "claim_id", "predicate", "value").agg(F.countDistinct("claim_id").alias("claims"), on("value", "predicate = 'research_area'").alias("terms")), read_table(spark, d, "documents", "document_id", "source_id").agg(F.countDistinct("document_id").alias("documents"), F.countDistinct("source_id").alias("sources")),
    ]
    return reduce(lambda a, b: a.crossJoin(b), parts)  # single rows


@query(f"""WITH RECURSIVE {_REL}, {_UP}, {_MEM}, tr AS (SELECT canonical_id AS root, canonical_id AS u FROM org_units WHERE entity_type = 'Institution' UNION SELECT a, n FROM up WHERE a IN (SELECT canonical_id FROM org_units WHERE entity_type = 'Institution')), pe AS (SELECT DISTINCT root, source_id AS p FROM tr JOIN r ON r.target_id = tr.u WHERE type IN ('AFFILIATED_WITH','MEMBER_OF')), pj AS (SELECT DISTINCT root, source_id AS project FROM tr JOIN r ON r.target_id = tr.u WHERE type = 'HOSTED_BY')
  SELECT i.canonical_id AS unit, (SELECT count(*) FROM pe WHERE root = i.canonical_id) AS people, (SELECT count(*) FROM pe WHERE root = i.canonical_id AND p NOT IN (SELECT person FROM m)) AS without_project, (SELECT count(*) FROM pj WHERE root = i.canonical_id) AS hosted, (SELECT count(*) FROM pj WHERE root = i.canonical_id AND project NOT IN (SELECT target_id FROM r WHERE type = 'PRINCIPAL_INVESTIGATOR_OF')) AS without_lead FROM (SELECT DISTINCT canonical_id FROM org_units WHERE entity_type = 'Institution') i""")
def institution_notices(spark, d):
    """For each institution with its whole tree: people without a project edge and hosted projects without a lead."""
    ins = read_table(spark, d, "org_units", "canonical_id", "entity_type").filter("entity_type = 'Institution'").select(F.col("canonical_id").alias("root")).distinct()
    r = relations(spark, d)
    up = G.closure(part_of(spark, d)).join(ins.withColumnRenamed("root", "ancestor"), "ancestor", "left_semi")
    tree = cut(ins.select("root", F.col("root").alias("target_id")).unionByName(up.select(F.col("ancestor").alias("root"), F.col("node").alias("target_id"))).distinct())
    pe = salted_join(r.filter("type IN ('AFFILIATED_WITH', 'MEMBER_OF')").select("target_id", F.col("source_id").alias("person")), tree, "target_id", "inner").select("root", "person").distinct()
    pj = salted_join(r.filter("type = 'HOSTED_BY'").select("target_id", F.col("source_id").alias("project")), tree, "target_id", "inner").select("root", "project").distinct()
    has = membership(spark, d).select("person").distinct().withColumn("h", F.lit(True))
    led = r.filter("type = 'PRINCIPAL_INVESTIGATOR_OF'").select(F.col("target_id").alias("project")).distinct().withColumn("h", F.lit(True))
    a = pe.join(has, "person", "left").groupBy("root").agg(F.count(F.lit(1)).alias("people"), F.count_if(F.col("h").isNull()).alias("without_project"))
    b = pj.join(led, "project", "left").groupBy("root").agg(F.count(F.lit(1)).alias("hosted"), F.count_if(F.col("h").isNull()).alias("without_lead"))
    return ins.join(a, "root", "left").join(b, "root", "left").fillna(0).withColumnRenamed("root", "unit")


@query("""WITH e AS (SELECT source_id AS a, target_id AS b, min(relation_id) AS rel, string_agg(DISTINCT type, ',' ORDER BY type) AS types FROM relations WHERE source_id IS NOT NULL AND target_id IS NOT NULL GROUP BY 1, 2), c AS (SELECT DISTINCT source_id AS a, target_id AS b, unnest(claim_ids) AS c FROM relations), k AS (SELECT a, b, c, row_number() OVER (PARTITION BY a, b ORDER BY c) AS place FROM c WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL)
  SELECT e.a, e.b, types, count(c) AS shown, coalesce(string_agg(c, ',' ORDER BY c), '') AS claim_ids FROM e LEFT JOIN (SELECT * FROM k WHERE place <= 12) k ON k.a = e.a AND k.b = e.b GROUP BY 1, 2, 3""")
def merged_edge_evidence(spark, d):
    """Parallel edges merged, with at most twelve of the claims behind them (the limit is the view's)."""
    r = read_table(spark, d, "relations", "relation_id", "type", "source_id", "target_id", "claim_ids").filter("source_id IS NOT NULL AND target_id IS NOT NULL")
    e = r.groupBy(F.col("source_id").alias("a"), F.col("target_id").alias("b")).agg(F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"))
    c = r.select(F.col("source_id").alias("a"), F.col("target_id").alias("b"), F.explode("claim_ids").alias("c")).filter("c IS NOT NULL").distinct()
    top = c.withColumn("place", F.row_number().over(Window.partitionBy("a", "b").orderBy("c"))).filter("place <= 12").groupBy("a", "b").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    return e.join(top, ["a", "b"], "left").select("a", "b", "types", F.coalesce(F.size("cs"), F.lit(0)).alias("shown"), F.coalesce(F.array_join("cs", ","), F.lit("")).alias("claim_ids"))


@query(f"""WITH {_REL}, f AS (SELECT source_id AS ego, target_id AS id, type FROM r WHERE type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF') UNION SELECT target_id, source_id, type FROM r WHERE type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF')), p AS (SELECT DISTINCT canonical_id AS ego FROM person), h1 AS (SELECT DISTINCT ego, id FROM f JOIN p USING (ego)), h2 AS (SELECT DISTINCT h1.ego, f.id FROM h1 JOIN f ON f.ego = h1.id WHERE f.id <> h1.ego)
  SELECT p.ego, (SELECT count(*) FROM h1 WHERE h1.ego = p.ego) AS first_hop, (SELECT count(*) FROM h2 WHERE h2.ego = p.ego AND (h2.ego, h2.id) NOT IN (SELECT (ego, id) FROM h1)) AS second_hop FROM p""")
def ego_sizes(spark, d):
    """Nodes one and two hops from every person over project edges; edges within the second hop are not followed."""
    m = membership(spark, d)
    p = read_table(spark, d, "person", "canonical_id").select(F.col("canonical_id").alias("ego")).distinct()
    first = p.join(m.withColumnRenamed("person", "ego"), "ego").select("ego", "project")
    second = first.join(m, "project").filter("person <> ego").select("ego", "person").distinct()
    a, b = first.groupBy("ego").agg(F.count(F.lit(1)).alias("first_hop")), second.groupBy("ego").agg(F.count(F.lit(1)).alias("second_hop"))
    return p.join(a, "ego", "left").join(b, "ego", "left").fillna(0)


@query(f"""WITH {_PEOPLE} SELECT 'person' AS kind, canonical_id AS id, coalesce(label, canonical_id) AS name, coalesce(array_to_string(list_sort(list_distinct(alternate_names)), '|'), '') AS also FROM people UNION SELECT 'unit', canonical_id, coalesce(label, canonical_id), coalesce(array_to_string(list_sort(list_distinct(alternate_names)), '|'), '') FROM org_units UNION SELECT 'project', canonical_id, coalesce(label, canonical_id), coalesce(array_to_string(list_sort(list_distinct(alternate_titles)), '|'), '') FROM project""")
def display_entities(spark, d):
    """Entities of all kinds in one shape for display: a name that is never null and the other forms."""
    also = lambda c: F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.filter(c, lambda x: x.isNotNull()))), "|"), F.lit(""))
    row = lambda kind, df, other: df.select(F.lit(kind).alias("kind"), F.col("canonical_id").alias("id"), F.coalesce("label", "canonical_id").alias("name"), also(F.col(other)).alias("also"))
    parts = [row("person", people(spark, d, "label", "alternate_names"), "alternate_names"), row("unit", read_table(spark, d, "org_units", "canonical_id", "label", "alternate_names"), "alternate_names"), row("project", read_table(spark, d, "project", "canonical_id", "label", "alternate_titles"), "alternate_titles")]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


@query("""SELECT id, row_number() OVER (ORDER BY k, id) AS place FROM (SELECT DISTINCT canonical_id AS id, lower(strip_accents(label)) AS k FROM org_units WHERE label IS NOT NULL)""")
def alphabetical_units(spark, d):
    """Units in alphabetical order, accents as ties (a fixed, small table). For display ``ORDER BY label COLLATE hu`` gives the Hungarian order."""
    u = read_table(spark, d, "org_units", "canonical_id", "label").filter("label IS NOT NULL").select(F.col("canonical_id").alias("id"), F.lower(text.strip_accents(F.col("label"))).alias("k")).distinct()
    return u.select("id", F.row_number().over(Window.orderBy("k", "id")).alias("place"))


QUERIES, ORACLES = R.queries, R.oracles
