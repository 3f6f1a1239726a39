"""Queries over the structure of the graph: projections, agreement, communities, paths, hierarchies, migration, slices."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomgraph.operators import centrality
from loomgraph.operators import graph as G
from loomgraph.operators.skew import salted_join
from loomgraph.operators.windows import average_rank, top_share
from loomgraph.plans.graphs import _MEM, _PAIRS, _SITE, _SIZE, membership, sites
from loomgraph.plans.registry import Registry
from loomgraph.session import cut
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query

_REL = "r AS (SELECT DISTINCT type, source_id, target_id FROM relations WHERE source_id IS NOT NULL AND target_id IS NOT NULL)"
_UP = "po AS (SELECT source_id AS s, target_id AS t FROM r WHERE type = 'PART_OF' AND source_id <> target_id), up(n, a) AS (SELECT s, t FROM po UNION SELECT up.n, po.t FROM up JOIN po ON po.s = up.a)"
_TOP = f"{_UP}, tops AS (SELECT n AS node, a AS top FROM up WHERE a NOT IN (SELECT s FROM po) AND n <> a UNION SELECT u, u FROM (SELECT DISTINCT target_id AS u FROM r WHERE type IN ('AFFILIATED_WITH','MEMBER_OF')) WHERE u NOT IN (SELECT s FROM po))"


def relations(spark, d, *types):
    r = read_table(spark, d, "relations", "type", "source_id", "target_id").dropna()
    return (r.filter(F.col("type").isin(*types)) if types else r).distinct()


def part_of(spark, d):
    return relations(spark, d, "PART_OF").select(F.col("source_id").alias("src"), F.col("target_id").alias("dst"))


def unit_tops(spark, d):
    """(node, top) for the units that people belong to."""
    units = relations(spark, d, "AFFILIATED_WITH", "MEMBER_OF").select(F.col("target_id").alias("id")).distinct()
    return cut(G.top_ancestors(units, part_of(spark, d)))


def _millionths(c):
    return F.round(c * 1_000_000).cast("bigint")


@query(f"""WITH {_MEM}, {_SIZE}, k(drop_from) AS (VALUES (NULL), (8)), e AS (SELECT k.drop_from, a.person AS a, b.person AS b, count(*) AS shared, sum(1.0 / (z.n - 1)) AS w FROM k, m a JOIN m b ON a.project = b.project AND a.person < b.person JOIN z ON z.project = a.project WHERE k.drop_from IS NULL OR z.n < k.drop_from GROUP BY ALL),
  g AS (SELECT drop_from, count(*) AS ties, sum(shared) AS s, sum(w) AS w FROM e GROUP BY 1), n AS (SELECT count(DISTINCT person) AS nodes FROM m)
  SELECT weighting, coalesce(drop_from, 0) AS drop_from, nodes, ties, CAST(round(1000000 * CASE weighting WHEN 'unweighted' THEN ties WHEN 'project_count' THEN s ELSE w END) AS BIGINT) AS weight_millionths FROM g, n, (VALUES ('unweighted'), ('project_count'), ('size_discounted')) x(weighting)""")
def projection_weightings(spark, d):
    """The projection under each weighting, with and without projects of eight and more persons; isolates stay."""
    m = cut(membership(spark, d))
    out = None
    for drop in (None, 8):
        for w in G.WEIGHTINGS:
            nodes, edges = G.projection(m, w, drop)
            row = edges.agg(F.count(F.lit(1)).alias("ties"), _millionths(F.coalesce(F.sum("weight"), F.lit(0.0))).alias("weight_millionths")).crossJoin(nodes.agg(F.count(F.lit(1)).alias("nodes")))
            row = row.select(F.lit(w).alias("weighting"), F.lit(drop or 0).alias("drop_from"), "nodes", "ties", "weight_millionths").filter("ties > 0")
            out = row if out is None else out.unionByName(row)
    return out


@query(f"""WITH RECURSIVE {_MEM}, {_SIZE}, t AS (SELECT a.person AS a, b.person AS b, count(*) AS shared, max(z.n) AS biggest, min(z.n) AS least, sum(1.0 / (z.n - 1)) AS w FROM m a JOIN m b ON a.project = b.project AND a.person < b.person JOIN z ON z.project = a.project GROUP BY 1, 2),
  {_SITE}, cr AS (SELECT t.a, t.b FROM t WHERE NOT EXISTS (SELECT 1 FROM s x JOIN s y ON x.site = y.site WHERE x.person = t.a AND y.person = t.b)), via AS (SELECT p.project, count(*) AS n FROM cr JOIN m p ON p.person = cr.a JOIN m q ON q.person = cr.b AND q.project = p.project GROUP BY 1),
  en AS (SELECT a AS x, biggest, least FROM t UNION ALL SELECT b, biggest, least FROM t), un AS (SELECT a AS x, b AS y FROM t UNION SELECT b, a FROM t), rc(x, y) AS (SELECT x, x FROM un UNION SELECT rc.x, un.y FROM rc JOIN un ON un.x = rc.y), cp AS (SELECT x, min(y) AS c FROM rc GROUP BY 1), cs AS (SELECT c, count(*) AS n FROM cp GROUP BY 1)
  SELECT (SELECT count(*) FROM z) AS projects_with_person, (SELECT count(*) FROM z WHERE n >= 2) AS projects_with_two, (SELECT count(DISTINCT person) FROM m) AS persons_with_edge, (SELECT count(*) FROM t) AS ties, (SELECT count(DISTINCT x) FROM en) AS persons_in_ties,
  (SELECT count(*) FROM t WHERE biggest >= 8) AS ties_through_8, (SELECT count(*) FROM t WHERE least >= 8) AS ties_only_through_8, (SELECT count(*) FROM (SELECT x FROM en GROUP BY 1 HAVING min(least) >= 8)) AS persons_only_through_8, (SELECT CAST(round(1000000 * sum(w)) AS BIGINT) FROM t) AS weight_millionths,
  (SELECT count(*) FROM t WHERE shared = 1) AS ties_by_one, (SELECT count(*) FROM t WHERE shared = 2) AS ties_by_two, (SELECT count(*) FROM t WHERE shared >= 3) AS ties_by_more, (SELECT count(*) FROM cr) AS cross_ties, (SELECT count(*) FROM via) AS cross_projects, (SELECT coalesce(max(n), 0) FROM via) AS cross_by_one_project, (SELECT count(*) FROM cs) AS components, (SELECT max(n) FROM cs) AS largest_component""")
def tie_report(spark, d):
    """Size, concentration, weights, cross-institute ties and components of the co-participation graph in one row."""
    m = cut(membership(spark, d))
    sized = cut(m.join(m.groupBy("project").agg(F.count(F.lit(1)).alias("n")), "project"))
    pairs = sized.alias("l").join(m.alias("r"), (F.col("l.project") == F.col("r.project")) & (F.col("l.person") < F.col("r.person")))
    t = cut(pairs.groupBy(F.col("l.person").alias("a"), F.col("r.person").alias("b")).agg(F.count(F.lit(1)).alias("shared"), F.max("l.n").alias("biggest"), F.min("l.n").alias("least"), F.sum(1 / (F.col("l.n") - 1)).alias("w")))
    s = sites(spark, d).groupBy("person").agg(F.collect_set("site").alias("sites"))
    of = lambda c: s.select(F.col("person").alias(c), F.col("sites").alias(f"{c}_sites"))
    none = F.array().cast("array<string>")
    cross = cut(t.join(of("a"), "a", "left").join(of("b"), "b", "left").filter(~F.arrays_overlap(F.coalesce("a_sites", none), F.coalesce("b_sites", none))).select("a", "b"))
    via = cross.join(m.select(F.col("person").alias("a"), "project"), "a").join(m.select(F.col("person").alias("b"), "project"), ["b", "project"]).groupBy("project").agg(F.count(F.lit(1)).alias("n"))
    ends = t.select(F.explode(F.array("a", "b")).alias("x"), "least").groupBy("x").agg(F.min("least").alias("least"))
    comp = G.components(t.select(F.col("a").alias("src"), F.col("b").alias("dst"))).groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    n = F.count(F.lit(1))
    rows = [
        sized.select("project", "n").distinct().agg(n.alias("projects_with_person"), F.count_if(F.col("n") >= 2).alias("projects_with_two")), m.agg(F.countDistinct("person").alias("persons_with_edge")),
        t.agg(n.alias("ties"), F.count_if(F.col("biggest") >= 8).alias("ties_through_8"), F.count_if(F.col("least") >= 8).alias("ties_only_through_8"), _millionths(F.sum("w")).alias("weight_millionths"), F.count_if(F.col("shared") == 1).alias("ties_by_one"), F.count_if(F.col("shared") == 2).alias("ties_by_two"), F.count_if(F.col("shared") >= 3).alias("ties_by_more")),
        ends.agg(n.alias("persons_in_ties"), F.count_if(F.col("least") >= 8).alias("persons_only_through_8")), cross.agg(n.alias("cross_ties")), via.agg(n.alias("cross_projects"), F.coalesce(F.max("n"), F.lit(0)).alias("cross_by_one_project")), comp.agg(n.alias("components"), F.max("n").alias("largest_component")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.crossJoin(r)  # single rows
    return out


def _scores(m):
    """(person, degree, strength, projects) of the size-discounted projection, isolates with zeros."""
    t = G.ties(m)
    ends = t.select(F.explode(F.array("a", "b")).alias("person"), "weight").groupBy("person").agg(F.count(F.lit(1)).alias("degree"), F.round(F.sum("weight"), 9).alias("strength"))
    return m.groupBy("person").agg(F.count(F.lit(1)).alias("projects")).join(ends, "person", "left").fillna({"degree": 0, "strength": 0.0})


_SC = f"""{_MEM}, {_SIZE}, t AS (SELECT a.person AS a, b.person AS b, sum(1.0 / (z.n - 1)) AS w FROM m a JOIN m b ON a.project = b.project AND a.person < b.person JOIN z ON z.project = a.project GROUP BY 1, 2), en AS (SELECT a AS person, w FROM t UNION ALL SELECT b, w FROM t),
  sc AS (SELECT p.person, p.projects, coalesce(e.degree, 0) AS degree, coalesce(e.strength, 0) AS strength FROM (SELECT person, count(*) AS projects FROM m GROUP BY 1) p LEFT JOIN (SELECT person, count(*) AS degree, round(sum(w), 9) AS strength FROM en GROUP BY 1) e USING (person))"""


@query(f"""WITH {_SC}, rk AS (SELECT *, rank() OVER (ORDER BY degree) + (count(*) OVER (PARTITION BY degree) - 1) / 2.0 AS rd, rank() OVER (ORDER BY strength) + (count(*) OVER (PARTITION BY strength) - 1) / 2.0 AS rs, rank() OVER (ORDER BY projects) + (count(*) OVER (PARTITION BY projects) - 1) / 2.0 AS rp FROM sc),
  k AS (SELECT CAST(greatest(1, ceil(count(*) * 10 / 100)) AS BIGINT) AS k FROM sc), cd AS (SELECT min(degree) AS c FROM (SELECT degree FROM sc ORDER BY degree DESC LIMIT (SELECT k FROM k))), cs AS (SELECT min(strength) AS c FROM (SELECT strength FROM sc ORDER BY strength DESC LIMIT (SELECT k FROM k))),
  td AS (SELECT person FROM sc, cd WHERE degree >= c AND degree > 0), ts AS (SELECT person FROM sc, cs WHERE strength >= c AND strength > 0)
  SELECT (SELECT count(*) FROM sc) AS persons, CASE WHEN (SELECT count(*) FROM sc) < 3 OR (SELECT min(degree) = max(degree) OR min(strength) = max(strength) FROM sc) THEN NULL ELSE (SELECT CAST(round(1000000 * corr(rd, rs)) AS BIGINT) FROM rk) END AS degree_strength_rho, (SELECT CAST(round(1000000 * corr(rd, rp)) AS BIGINT) FROM rk) AS degree_projects_rho,
  (SELECT count(*) FROM td) AS top_degree, (SELECT count(*) FROM ts) AS top_strength, (SELECT count(*) FROM td JOIN ts USING (person)) AS top_both""")
def scoring_agreement(spark, d):
    """How far degree, size-discounted strength and number of projects rank people alike: rank correlation and top deciles."""
    sc = cut(_scores(cut(membership(spark, d))))
    r = average_rank(average_rank(average_rank(sc, "degree", "rd"), "strength", "rs"), "projects", "rp")
    spread = (F.count(F.lit(1)) >= 3) & (F.min("degree") < F.max("degree")) & (F.min("strength") < F.max("strength"))
    one = r.agg(F.count(F.lit(1)).alias("persons"), F.when(spread, _millionths(F.corr("rd", "rs"))).alias("degree_strength_rho"), _millionths(F.corr("rd", "rp")).alias("degree_projects_rho"))
    td, ts = cut(top_share(sc, "degree", 10).select("person")), cut(top_share(sc, "strength", 10).select("person"))
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return one.crossJoin(n(td, "top_degree")).crossJoin(n(ts, "top_strength")).crossJoin(n(td.join(ts, "person"), "top_both"))  # single rows


@query("""WITH a AS (SELECT coalesce(lang, '-') AS x, source AS y FROM documents WHERE source IS NOT NULL), t AS (SELECT count(*) AS t FROM a), c AS (SELECT x, y, count(*) AS n FROM a GROUP BY ALL), hx AS (SELECT -sum(n / t * ln(n / t)) AS h FROM (SELECT x, sum(n) AS n FROM c GROUP BY 1), t), hy AS (SELECT -sum(n / t * ln(n / t)) AS h FROM (SELECT y, sum(n) AS n FROM c GROUP BY 1), t),
  mi AS (SELECT sum(c.n / t * ln(c.n * t / (p.n * q.n))) AS m FROM c JOIN (SELECT x, sum(n) AS n FROM c GROUP BY 1) p USING (x) JOIN (SELECT y, sum(n) AS n FROM c GROUP BY 1) q USING (y), t) SELECT t AS n, CAST(round(1000000 * CASE WHEN hx.h < 1e-12 AND hy.h < 1e-12 THEN 1 WHEN hx.h < 1e-12 OR hy.h < 1e-12 THEN 0 ELSE m / ((hx.h + hy.h) / 2) END) AS BIGINT) AS nmi_millionths FROM t, hx, hy, mi""")
def nmi(spark, d):
    """Normalised mutual information of two labelings of documents, arithmetic mean of the entropies."""
    docs = read_table(spark, d, "documents", "lang", "source").select(F.coalesce("lang", F.lit("-")).alias("a"), F.col("source").alias("b"))
    return G.label_agreement(docs, "a", "b")


def _community_graph(spark, d):
    _, edges = G.projection(cut(membership(spark, d)), "size_discounted")
    return cut(edges.select(F.col("a").alias("src"), F.col("b").alias("dst"), "weight"))


@query()
def communities(spark, d):
    """Communities of the size-discounted co-participation graph, numbered by size (no SQL: checked by invariants in tests)."""
    return centrality.communities(_community_graph(spark, d))


@query()
def community_profile(spark, d):
    """Sizes, modularity, agreement with institutes and stability over seeds of the communities."""
    e = _community_graph(spark, d)
    part = cut(centrality.communities(e))
    home = sites(spark, d).groupBy("person").agg(F.when(F.countDistinct("site") == 1, F.min("site")).otherwise("multi").alias("site"))
    labelled = part.join(home.withColumnRenamed("person", "id"), "id", "left").withColumn("site", F.coalesce("site", F.lit("other")))
    of = lambda c: part.select(F.col("id").alias(c), F.col("community").alias(f"c_{c}"))
    placed = e.join(of("src"), "src").join(of("dst"), "dst")
    inside = placed.agg((F.sum(F.when(F.col("c_src") == F.col("c_dst"), F.col("weight"))) / F.sum("weight")).alias("inside"), F.sum("weight").alias("m"))
    ends = placed.select(F.explode(F.array("c_src", "c_dst")).alias("c"), "weight").groupBy("c").agg(F.sum("weight").alias("w")).agg(F.sum(F.col("w") * F.col("w")).alias("sq"))
    sizes = part.groupBy("community").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("communities"), F.max("n").alias("largest"), F.sum("n").alias("persons"))
    other = cut(centrality.communities(e, seed=1)).withColumnRenamed("community", "other")
    stable = G.label_agreement(part.join(other, "id"), "community", "other").select(F.col("nmi_millionths").alias("seed_stability"))
    with_site = G.label_agreement(labelled, "community", "site").select(F.col("nmi_millionths").alias("nmi_with_institute"))
    one = sizes.crossJoin(inside).crossJoin(ends).crossJoin(stable).crossJoin(with_site)  # single rows
    return one.select("persons", "communities", "largest", _millionths(F.col("inside") - F.col("sq") / (4 * F.col("m") * F.col("m"))).alias("modularity_millionths"), "seed_stability", "nmi_with_institute")


@query(f"""WITH RECURSIVE {_REL}, {_TOP}, p AS (SELECT DISTINCT source_id AS person, top FROM r JOIN tops ON node = target_id WHERE type IN ('AFFILIATED_WITH','MEMBER_OF')) SELECT top, count(*) AS people, count(*) FILTER (person IN (SELECT person FROM p GROUP BY 1 HAVING count(*) > 1)) AS shared_people FROM p GROUP BY 1""")
def people_by_top_unit(spark, d):
    """People under each unit that is part of nothing, and how many of them are under another one too."""
    r = relations(spark, d, "AFFILIATED_WITH", "MEMBER_OF").select(F.col("source_id").alias("person"), F.col("target_id").alias("node"))
    p = cut(r.join(unit_tops(spark, d), "node").select("person", "top").distinct())
    many = p.groupBy("person").agg((F.count(F.lit(1)) > 1).alias("many"))
    return p.join(many, "person").groupBy("top").agg(F.count(F.lit(1)).alias("people"), F.count_if("many").alias("shared_people"))


@query(f"""WITH RECURSIVE {_REL}, {_TOP}, c AS (SELECT top, count(DISTINCT source_id) AS n FROM r JOIN tops ON node = target_id WHERE type = 'AFFILIATED_WITH' GROUP BY 1) SELECT count(*) AS tops, CAST(sum(n) AS BIGINT) AS total, CAST(round(1000000 * sum(n * n) / (sum(n) * sum(n))) AS BIGINT) AS hhi_millionths FROM c""")
def herfindahl(spark, d):
    """Concentration of people over the top units of their affiliations."""
    r = relations(spark, d, "AFFILIATED_WITH").select(F.col("source_id").alias("person"), F.col("target_id").alias("node"))
    c = r.join(unit_tops(spark, d), "node").groupBy("top").agg(F.countDistinct("person").alias("n"))
    return c.agg(F.count(F.lit(1)).alias("tops"), F.sum("n").alias("total"), _millionths(F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("hhi_millionths"))


@query("""WITH RECURSIVE e0 AS (SELECT source_id AS a, target_id AS b FROM relations WHERE epistemic_status = 'OBSERVED' AND source_id IS NOT NULL AND target_id IS NOT NULL AND source_id <> target_id), e AS (SELECT a AS x, b AS y FROM e0 UNION SELECT b, a FROM e0), st AS (SELECT min(x) AS id FROM e),
  h0(id, hop) AS (SELECT id, 0 FROM st UNION SELECT e.y, h0.hop + 1 FROM h0 JOIN e ON e.x = h0.id WHERE h0.hop < 8), h AS (SELECT id, min(hop) AS hop FROM h0 GROUP BY 1), pr AS (SELECT h.id, h.hop, min(g.id) AS prev FROM h JOIN e ON e.y = h.id JOIN h g ON g.id = e.x AND g.hop = h.hop - 1 GROUP BY 1, 2),
  pa(id, hop, path) AS (SELECT id, 0, id FROM st UNION ALL SELECT pr.id, pr.hop, pa.path || '>' || pr.id FROM pa JOIN pr ON pr.prev = pa.id AND pr.hop = pa.hop + 1) SELECT id, hop, path FROM pa""")
def shortest_paths(spark, d):
    """Shortest observed paths of up to eight edges from the least id, as paths, not lengths."""
    r = read_table(spark, d, "relations", "source_id", "target_id", "epistemic_status").filter("epistemic_status = 'OBSERVED'").dropna().filter("source_id <> target_id")
    e = r.select(F.col("source_id").alias("src"), F.col("target_id").alias("dst")).distinct()
    return G.shortest_paths(e, e.select(F.least("src", "dst").alias("id")).agg(F.min("id").alias("id")), 8)


@query(f"WITH RECURSIVE {_REL}, po AS (SELECT source_id AS s, target_id AS t FROM r WHERE type = 'PART_OF' AND source_id <> target_id), de(root, id, g) AS (SELECT t, s, 1 FROM po UNION SELECT de.root, po.s, de.g + 1 FROM de JOIN po ON po.t = de.id WHERE de.g < 6) SELECT root, id AS descendant, min(g) AS generation FROM de WHERE root <> id GROUP BY 1, 2")
def descendants(spark, d):
    """Units up to six generations below each unit, with the generation."""
    up = G.closure(part_of(spark, d))
    return up.filter("depth <= 6").select(F.col("ancestor").alias("root"), F.col("node").alias("descendant"), F.col("depth").alias("generation"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT source_id AS s, target_id AS t FROM relations WHERE type = 'PART_OF' AND source_id IS NOT NULL AND target_id IS NOT NULL AND source_id <> target_id), w(start, node, path, n) AS (SELECT s, t, s || '>' || t, 1 FROM e WHERE s IN (SELECT s FROM e) UNION ALL SELECT w.start, e.t, w.path || '>' || e.t, n + 1 FROM w JOIN e ON e.s = w.node WHERE w.node <> w.start AND n < 64 AND (e.t = w.start OR NOT contains('>' || w.path || '>', '>' || e.t || '>')))
  SELECT start AS unit, min(path) AS path FROM (SELECT start, path, n, min(n) OVER (PARTITION BY start) AS least FROM w WHERE node = start) WHERE n = least GROUP BY 1""")
def cycle_paths(spark, d):
    """For each unit on a PART_OF cycle the shortest way back to itself, the least of several. Only edges on cycles are walked."""
    e = part_of(spark, d).filter("src <> dst").distinct()
    back = G.closure(e).select(F.col("ancestor").alias("src"), F.col("node").alias("dst"))
    e = cut(e.join(back, ["src", "dst"], "left_semi"))
    walk = cut(e.select(F.col("src").alias("unit"), F.col("dst").alias("node"), F.concat("src", F.lit(">"), "dst").alias("path")))
    found = None
    while not walk.isEmpty():
        closed = walk.filter("unit = node").groupBy("unit").agg(F.min("path").alias("path"))
        found = closed if found is None else found.unionByName(closed)
        open_ = walk.join(closed.select("unit"), "unit", "left_anti")
        step = open_.join(e, F.col("node") == F.col("src")).select("unit", F.col("dst").alias("node"), F.concat("path", F.lit(">"), "dst").alias("path"))
        seen = open_.select("unit", "node")  # a shortest way never meets a node twice: of equal ends the least path goes on
        walk = cut(step.join(seen, ["unit", "node"], "left_anti").groupBy("unit", "node").agg(F.min("path").alias("path")))
    return found.select("unit", "path") if found is not None else walk.select("unit", "path")


@query(f"""WITH RECURSIVE {_REL}, {_TOP}, a AS (SELECT DISTINCT source_id AS p, target_id AS u, CAST(substr(valid_from, 1, 4) AS INT) AS f, CAST(substr(valid_until, 1, 4) AS INT) AS t FROM relations WHERE type = 'AFFILIATED_WITH' AND source_id IS NOT NULL AND target_id IS NOT NULL)
  SELECT x.top AS from_top, y.top AS to_top, count(DISTINCT a.p) AS movers FROM a JOIN a b ON a.p = b.p AND a.u <> b.u AND a.t <= b.f JOIN tops x ON x.node = a.u JOIN tops y ON y.node = b.u WHERE x.top <> y.top GROUP BY 1, 2""")
def migration_between_tops(spark, d):
    """People whose affiliation under one top unit ended before one under another began."""
    r = read_table(spark, d, "relations", "type", "source_id", "target_id", "valid_from", "valid_until").filter("type = 'AFFILIATED_WITH' AND source_id IS NOT NULL AND target_id IS NOT NULL")
    y = lambda c: F.substring(c, 1, 4).cast("int")
    a = r.select(F.col("source_id").alias("p"), F.col("target_id").alias("u"), y("valid_from").alias("f"), y("valid_until").alias("t")).distinct()
    tops = unit_tops(spark, d)
    ended = a.filter("t IS NOT NULL").join(tops.withColumnRenamed("node", "u"), "u").select("p", F.col("top").alias("from_top"), "t", F.col("u").alias("u0"))
    begun = a.filter("f IS NOT NULL").join(tops.withColumnRenamed("node", "u"), "u").select("p", F.col("top").alias("to_top"), "f", F.col("u").alias("u1"))
    return ended.join(begun, "p").filter("u0 <> u1 AND t <= f AND from_top <> to_top").groupBy("from_top", "to_top").agg(F.countDistinct("p").alias("movers"))


@query(f"""WITH RECURSIVE {_REL}, {_UP} SELECT r.source_id AS person, r.type AS relation, r.target_id AS unit, coalesce(string_agg(up.a, ',' ORDER BY up.a), '') AS ancestors FROM r LEFT JOIN up ON up.n = r.target_id AND up.a <> r.target_id WHERE r.type IN ('AFFILIATED_WITH','MEMBER_OF') GROUP BY 1, 2, 3""")
def affiliation_history(spark, d):
    """Each affiliation with all units above its unit; units without a parent stay."""
    up = G.closure(part_of(spark, d)).groupBy(F.col("node").alias("unit")).agg(F.array_join(F.array_sort(F.collect_set("ancestor")), ",").alias("ancestors"))
    r = relations(spark, d, "AFFILIATED_WITH", "MEMBER_OF").select(F.col("source_id").alias("person"), F.col("type").alias("relation"), F.col("target_id").alias("unit"))
    return salted_join(r, up, "unit").withColumn("ancestors", F.coalesce("ancestors", F.lit("")))


@query("""WITH t AS (SELECT DISTINCT subject.canonical_id AS p, object.canonical_id AS topic FROM claims WHERE predicate = 'WORKS_ON_TOPIC' AND subject.canonical_id IS NOT NULL AND object.canonical_id IS NOT NULL), u AS (SELECT DISTINCT source_id AS p, target_id AS unit FROM relations WHERE type = 'MEMBER_OF' AND source_id IS NOT NULL AND target_id IS NOT NULL)
  SELECT topic, unit, count(*) AS people, min(p) AS first_person FROM t JOIN u USING (p) GROUP BY 1, 2""")
def topic_and_unit(spark, d):
    """People who meet both of two predicates: a topic and a unit."""
    c = read_table(spark, d, "claims", "predicate", "subject", "object").filter("predicate = 'WORKS_ON_TOPIC' AND subject.canonical_id IS NOT NULL AND object.canonical_id IS NOT NULL")
    t = c.select(F.col("subject.canonical_id").alias("p"), F.col("object.canonical_id").alias("topic")).distinct()
    u = relations(spark, d, "MEMBER_OF").select(F.col("source_id").alias("p"), F.col("target_id").alias("unit"))
    return t.join(u, "p").groupBy("topic", "unit").agg(F.count(F.lit(1)).alias("people"), F.min("p").alias("first_person"))


@query("""WITH t AS (SELECT DISTINCT subject.canonical_id AS p, object.canonical_id AS topic FROM claims WHERE predicate = 'WORKS_ON_TOPIC' AND subject.canonical_id IS NOT NULL AND object.canonical_id IS NOT NULL), u AS (SELECT source_id AS p, string_agg(DISTINCT target_id, ',' ORDER BY target_id) AS units FROM relations WHERE type IN ('MEMBER_OF','AFFILIATED_WITH') AND target_id IS NOT NULL GROUP BY 1)
  SELECT p AS person, count(*) AS topics, string_agg(topic, ',' ORDER BY topic) AS bridged, coalesce(any_value(units), '') AS units FROM t LEFT JOIN u USING (p) GROUP BY 1 HAVING count(*) > 1""")
def topic_bridges(spark, d):
    """People who work on several topics, with their units if any."""
    c = read_table(spark, d, "claims", "predicate", "subject", "object").filter("predicate = 'WORKS_ON_TOPIC' AND subject.canonical_id IS NOT NULL AND object.canonical_id IS NOT NULL")
    t = c.select(F.col("subject.canonical_id").alias("person"), F.col("object.canonical_id").alias("topic")).distinct()
    u = relations(spark, d, "MEMBER_OF", "AFFILIATED_WITH").groupBy(F.col("source_id").alias("person")).agg(F.array_join(F.array_sort(F.collect_set("target_id")), ",").alias("units"))
    b = t.groupBy("person").agg(F.count(F.lit(1)).alias("topics"), F.array_join(F.array_sort(F.collect_list("topic")), ",").alias("bridged")).filter("topics > 1")
    return b.join(u, "person", "left").withColumn("units", F.coalesce("units", F.lit("")))


@query(f"""WITH {_REL}, u AS (SELECT DISTINCT canonical_id AS id FROM org_units WHERE entity_type = 'Institution'), e AS (SELECT type, source_id AS a, target_id AS b FROM r UNION SELECT type, target_id, source_id FROM r), h1 AS (SELECT DISTINCT e.b AS id FROM u JOIN e ON e.a = u.id WHERE type IN ('PART_OF','HOSTED_BY') AND e.b NOT IN (SELECT id FROM u)),
  h2 AS (SELECT DISTINCT e.b AS id FROM h1 JOIN e ON e.a = h1.id WHERE type IN ('AFFILIATED_WITH','PARTICIPATES_IN') AND e.b NOT IN (SELECT id FROM u UNION SELECT id FROM h1)) SELECT id, 0 AS hop FROM u UNION ALL SELECT id, 1 FROM h1 UNION ALL SELECT id, 2 FROM h2""")
def hop_slice(spark, d):
    """From all institutions: one hop over hierarchy and hosting, a second over people."""
    seeds = read_table(spark, d, "org_units", "canonical_id", "entity_type").filter("entity_type = 'Institution'").select(F.col("canonical_id").alias("id")).distinct()
    e = relations(spark, d).select(F.col("source_id").alias("src"), F.col("target_id").alias("dst"), "type")
    return G.reachable_by(e, seeds, [["PART_OF", "HOSTED_BY"], ["AFFILIATED_WITH", "PARTICIPATES_IN"]])


_SLICE = f"{_MEM}, big AS (SELECT project FROM m GROUP BY 1 HAVING count(*) >= 20), k AS (SELECT DISTINCT relation_id, source_id AS a, target_id AS b FROM relations WHERE type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF') AND epistemic_status IN ('OBSERVED','DERIVED') AND source_id IS NOT NULL AND target_id IS NOT NULL AND target_id NOT IN (SELECT project FROM big)), e AS (SELECT DISTINCT a, b FROM k), deg AS (SELECT id, count(*) AS d FROM (SELECT a AS id FROM e UNION ALL SELECT b FROM e) GROUP BY 1)"


@query(f"WITH {_SLICE} SELECT a, b, x.d AS degree_a, y.d AS degree_b FROM e JOIN deg x ON x.id = a JOIN deg y ON y.id = b")
def filtered_slice(spark, d):
    """The slice of project edges by status and project size, with degrees within the slice."""
    r = read_table(spark, d, "relations", "type", "source_id", "target_id", "epistemic_status").filter("type IN ('PARTICIPATES_IN', 'PRINCIPAL_INVESTIGATOR_OF') AND epistemic_status IN ('OBSERVED', 'DERIVED')").select(F.col("source_id").alias("a"), F.col("target_id").alias("b")).dropna().distinct()
    big = membership(spark, d).groupBy("project").agg(F.count(F.lit(1)).alias("n")).filter("n >= 20").select(F.col("project").alias("b"))
    e = cut(r.join(big, "b", "left_anti"))
    deg = e.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("deg"))
    of = lambda c: deg.select(F.col("id").alias(c), F.col("deg").alias(f"degree_{c}"))
    return salted_join(salted_join(e, of("a"), "a", "inner"), of("b"), "b", "inner").select("a", "b", "degree_a", "degree_b")


@query(f"WITH {_SLICE}, keep AS (SELECT canonical_id AS id FROM person WHERE snapshot_date = (SELECT max(snapshot_date) FROM person) UNION SELECT canonical_id FROM project WHERE \"start\" IS NOT NULL), i AS (SELECT a, b FROM e WHERE a IN (SELECT id FROM keep) AND b IN (SELECT id FROM keep)) SELECT id, count(*) AS degree FROM (SELECT a AS id FROM i UNION ALL SELECT b FROM i) GROUP BY 1")
def restricted_slice(spark, d):
    """The slice restricted to people of the last snapshot and dated projects; degrees counted anew."""
    e = filtered_slice(spark, d).select("a", "b")
    p = read_table(spark, d, "person", "canonical_id", "snapshot_date")
    last = p.agg(F.max("snapshot_date").alias("snapshot_date"))
    keep = p.join(F.broadcast(last), "snapshot_date").select("canonical_id").unionByName(read_table(spark, d, "project", "canonical_id", "start").filter("start IS NOT NULL").select("canonical_id")).distinct()
    i = e.join(keep.withColumnRenamed("canonical_id", "a"), "a", "left_semi").join(keep.withColumnRenamed("canonical_id", "b"), "b", "left_semi")
    return i.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


@query(f"WITH {_SLICE} SELECT (SELECT count(*) FROM deg) AS nodes, (SELECT count(*) FROM e) AS edges, (SELECT max(d) FROM deg) AS max_degree, (SELECT count(*) FROM deg WHERE d = 1) AS leaves, (SELECT count(DISTINCT a) FROM e) AS people, (SELECT count(DISTINCT b) FROM e) AS projects")
def slice_stats(spark, d):
    e = cut(filtered_slice(spark, d))
    deg = e.select(F.col("a").alias("id"), F.col("degree_a").alias("n")).unionByName(e.select(F.col("b").alias("id"), F.col("degree_b").alias("n"))).distinct()
    return deg.agg(F.count(F.lit(1)).alias("nodes"), F.max("n").alias("max_degree"), F.count_if(F.col("n") == 1).alias("leaves")).crossJoin(e.agg(F.count(F.lit(1)).alias("edges"), F.countDistinct("a").alias("people"), F.countDistinct("b").alias("projects")))


@query(f"""WITH RECURSIVE {_REL}, {_TOP}, pt AS (SELECT DISTINCT source_id AS person, top FROM r JOIN tops ON node = target_id WHERE type IN ('AFFILIATED_WITH','MEMBER_OF')), pj AS (SELECT DISTINCT source_id AS person, target_id AS project FROM r WHERE type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF'))
  SELECT x.top AS top_a, y.top AS top_b, count(DISTINCT x.project) AS projects FROM (SELECT DISTINCT top, project FROM pt JOIN pj USING (person)) x JOIN (SELECT DISTINCT top, project FROM pt JOIN pj USING (person)) y ON x.project = y.project AND x.top < y.top GROUP BY 1, 2""")
def unit_tree_bridges(spark, d):
    """Projects that bridge two unit trees: people under one top and people under another take part."""
    r = relations(spark, d, "AFFILIATED_WITH", "MEMBER_OF").select(F.col("source_id").alias("person"), F.col("target_id").alias("node"))
    return G.bridges(r, unit_tops(spark, d), membership(spark, d))


QUERIES, ORACLES = R.queries, R.oracles
