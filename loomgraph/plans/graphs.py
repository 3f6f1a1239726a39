"""Queries over the graph: projections, paths, components, readiness figures, resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import graph as G
from loomgraph.operators import resolution as ER
from loomgraph.plans.registry import Registry
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query

_MEM = "m AS (SELECT DISTINCT target_id AS project, source_id AS person FROM relations WHERE type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF') AND source_id IS NOT NULL AND target_id IS NOT NULL)"
_SIZE = "z AS (SELECT project, count(*) AS n FROM m GROUP BY 1)"
_PAIRS = "p AS (SELECT a.person AS a, b.person AS b, count(*) AS shared, max(z.n) AS biggest FROM m a JOIN m b ON a.project = b.project AND a.person < b.person JOIN z ON z.project = a.project GROUP BY 1, 2)"
_SITE = "s AS (SELECT DISTINCT canonical_id AS person, split_part(r, '|', 1) AS site FROM (SELECT canonical_id, unnest(source_refs) AS r FROM person))"
_EDGES = "e AS (SELECT DISTINCT least(source_id, target_id) AS a, greatest(source_id, target_id) AS b FROM relations WHERE source_id IS NOT NULL AND target_id IS NOT NULL AND source_id <> target_id)"


def membership(spark: SparkSession, d: str) -> DataFrame:
    """(project, person) of participation and leadership, distinct."""
    r = read_table(spark, d, "relations", "type", "source_id", "target_id").filter("type IN ('PARTICIPATES_IN', 'PRINCIPAL_INVESTIGATOR_OF')")
    return r.dropna().select(F.col("target_id").alias("project"), F.col("source_id").alias("person")).distinct()


def edges(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "relations", "source_id", "target_id").dropna().select(F.col("source_id").alias("src"), F.col("target_id").alias("dst")).filter("src <> dst").distinct()


def sites(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "person", "canonical_id", "source_refs").select(F.col("canonical_id").alias("person"), F.explode("source_refs").alias("r"))
    return p.select("person", F.substring_index("r", "|", 1).alias("site")).distinct()


@query(f"WITH {_MEM}, {_SIZE} SELECT a.person AS a, b.person AS b, count(*) AS shared, CAST(round(sum(1.0 / (z.n - 1)) * 1000000) AS BIGINT) AS weight_millionths FROM m a JOIN m b ON a.project = b.project AND a.person < b.person JOIN z ON z.project = a.project GROUP BY 1, 2")
def co_participation_ties(spark, d):
    return G.ties(membership(spark, d)).select("a", "b", "shared", F.round(F.col("weight") * 1000000).cast("bigint").alias("weight_millionths"))


@query("""WITH m AS (SELECT DISTINCT l_orderkey AS project, l_suppkey AS person FROM lineitem), z AS (SELECT project, count(*) AS n FROM m GROUP BY 1)
  SELECT a.person AS a, b.person AS b, count(*) AS shared, CAST(round(sum(1.0 / (z.n - 1)) * 1000) AS BIGINT) AS weight_thousandths FROM m a JOIN m b ON a.project = b.project AND a.person < b.person JOIN z ON z.project = a.project GROUP BY 1, 2""")
def co_supply_ties(spark, d):
    """The same projection over orders and suppliers: dense, every pair tied."""
    m = read_table(spark, d, "lineitem", "l_orderkey", "l_suppkey").select(F.col("l_orderkey").alias("project"), F.col("l_suppkey").alias("person"))
    return G.ties(m).select("a", "b", "shared", F.round(F.col("weight") * 1000).cast("bigint").alias("weight_thousandths"))


@query(f"WITH {_MEM}, {_SIZE} SELECT CASE WHEN n <= 3 THEN CAST(n AS VARCHAR) WHEN n <= 5 THEN '4-5' WHEN n <= 7 THEN '6-7' WHEN n <= 9 THEN '8-9' ELSE '10+' END AS bucket, count(*) AS projects FROM z GROUP BY 1")
def size_distribution(spark, d):
    z = membership(spark, d).groupBy("project").agg(F.count(F.lit(1)).alias("n"))
    bucket = F.when(F.col("n") <= 3, F.col("n").cast("string")).when(F.col("n") <= 5, "4-5").when(F.col("n") <= 7, "6-7").when(F.col("n") <= 9, "8-9").otherwise("10+")
    return z.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("projects"))


@query(f"""WITH {_MEM}, {_SIZE}, t AS (SELECT a.person AS a, b.person AS b, bool_or(z.n >= 8) AS big, bool_and(z.n >= 8) AS solely FROM m a JOIN m b ON a.project = b.project AND a.person < b.person JOIN z ON z.project = a.project GROUP BY 1, 2)
  SELECT count(*) AS ties, count(*) FILTER (big) AS through_large, count(*) FILTER (solely) AS only_through_large FROM t""")
def large_project_concentration(spark, d):
    m = membership(spark, d)
    sized = m.join(m.groupBy("project").agg(F.count(F.lit(1)).alias("n")), "project")
    t = sized.alias("l").join(m.alias("r"), (F.col("l.project") == F.col("r.project")) & (F.col("l.person") < F.col("r.person"))).groupBy("l.person", "r.person").agg(F.bool_or(F.col("n") >= 8).alias("big"), F.bool_and(F.col("n") >= 8).alias("only"))
    return t.agg(F.count(F.lit(1)).alias("ties"), F.count_if("big").alias("through_large"), F.count_if("only").alias("only_through_large"))


@query(f"WITH {_MEM}, {_SIZE} SELECT person, count(*) AS projects, count(*) FILTER (n > 1) AS tied_projects FROM m JOIN z USING (project) GROUP BY 1")
def strength_vs_bipartite_degree(spark, d):
    return G.strength(membership(spark, d))


@query(f"WITH {_MEM}, {_SIZE} SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) AS shared_total, CAST(sum(CASE WHEN n > 1 THEN n END) AS BIGINT) AS double_discounted_total, count(*) AS projects FROM z")
def tie_weight_totals(spark, d):
    """Totals in closed form from project sizes, without building pairs: n(n-1)/2 and n/2 each."""
    z = membership(spark, d).groupBy("project").agg(F.count(F.lit(1)).alias("n"))
    return z.agg(F.sum(F.expr("n * (n - 1) DIV 2")).alias("shared_total"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("double_discounted_total"), F.count(F.lit(1)).alias("projects"))


@query(f"""WITH {_MEM}, {_SITE}, t AS (SELECT DISTINCT a.person AS a, b.person AS b FROM m a JOIN m b ON a.project = b.project AND a.person < b.person),
  same AS (SELECT DISTINCT t.a, t.b FROM t JOIN s x ON x.person = t.a JOIN s y ON y.person = t.b AND x.site = y.site) SELECT count(*) AS ties, (SELECT count(*) FROM t) - (SELECT count(*) FROM same) AS cross_site FROM t""")
def cross_institute_ties(spark, d):
    """Ties between persons with disjoint site sets."""
    sets = sites(spark, d).groupBy("person").agg(F.collect_set("site").alias("sites"))
    t = G.ties(membership(spark, d)).select("a", "b")
    of = lambda c: sets.select(F.col("person").alias(c), F.col("sites").alias(f"{c}_s"))
    t = t.join(of("a"), "a", "left").join(of("b"), "b", "left")
    none = F.array().cast("array<string>")
    apart = ~F.arrays_overlap(F.coalesce("a_s", none), F.coalesce("b_s", none))
    return t.agg(F.count(F.lit(1)).alias("ties"), F.count_if(apart).alias("cross_site"))


@query(f"""WITH RECURSIVE {_EDGES}, u AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e), r(v, m) AS (SELECT x, x FROM u UNION SELECT u.y, r.m FROM r JOIN u ON u.x = r.v WHERE r.m < u.y)
  SELECT v AS id, min(m) AS component FROM r GROUP BY 1""")
def connected_components(spark, d):
    return G.components(edges(spark, d))


@query(f"""WITH RECURSIVE {_EDGES}, u AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e), r(v, m) AS (SELECT x, x FROM u UNION SELECT u.y, r.m FROM r JOIN u ON u.x = r.v WHERE r.m < u.y),
  c AS (SELECT v, min(m) AS m FROM r GROUP BY 1), n AS (SELECT m, count(*) AS n FROM c GROUP BY 1) SELECT count(*) AS components, max(n) AS largest, count(*) FILTER (n = 2) AS pairs FROM n""")
def component_summary(spark, d):
    n = G.components(edges(spark, d)).groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("components"), F.max("n").alias("largest"), F.count_if(F.col("n") == 2).alias("pairs"))


@query(f"WITH {_EDGES} SELECT id, count(*) AS degree FROM (SELECT a AS id FROM e UNION ALL SELECT b FROM e) GROUP BY 1")
def node_degrees(spark, d):
    return G.degrees(edges(spark, d))


@query(f"""WITH {_EDGES}, u AS (SELECT a AS x, b AS y FROM e UNION ALL SELECT b, a FROM e), s AS (SELECT min(canonical_id) AS id FROM person WHERE canonical_id IN (SELECT a FROM e UNION SELECT b FROM e)),
  h1 AS (SELECT DISTINCT y AS id FROM s JOIN u ON u.x = s.id), h2 AS (SELECT DISTINCT u.y AS id FROM h1 JOIN u ON u.x = h1.id),
  a AS (SELECT id, 0 AS hop FROM s UNION ALL SELECT id, 1 FROM h1 UNION ALL SELECT id, 2 FROM h2) SELECT id, CAST(min(hop) AS INT) AS hop FROM a GROUP BY 1""")
def k_hop_slice(spark, d):
    e = edges(spark, d)
    people = read_table(spark, d, "person", "canonical_id").select(F.col("canonical_id").alias("id"))
    ends = e.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return G.hops(e, people.join(ends, "id", "left_semi").agg(F.min("id").alias("id")), 2)


@query(f"""WITH RECURSIVE {_EDGES}, u AS (SELECT a AS x, b AS y FROM e UNION ALL SELECT b, a FROM e), s AS (SELECT min(a) AS id FROM e),
  r(id, hop) AS (SELECT id, 0 FROM s UNION SELECT u.y, r.hop + 1 FROM r JOIN u ON u.x = r.id WHERE r.hop < 8) SELECT id, CAST(min(hop) AS INT) AS hop FROM r GROUP BY 1""")
def shortest_path_hops(spark, d):
    e = edges(spark, d)
    return G.hops(e, e.select(F.least("src", "dst").alias("id")).agg(F.min("id").alias("id")), 8)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT source_id AS s, target_id AS t FROM relations WHERE type = 'PART_OF' AND source_id IS NOT NULL AND target_id IS NOT NULL AND source_id <> target_id),
  r(node, ancestor, depth) AS (SELECT s, t, 1 FROM e UNION SELECT r.node, e.t, r.depth + 1 FROM r JOIN e ON e.s = r.ancestor WHERE r.depth < 500 AND e.t <> r.node) SELECT node, ancestor, CAST(min(depth) AS INT) AS depth FROM r GROUP BY 1, 2""")
def hierarchy_closure(spark, d):
    r = read_table(spark, d, "relations", "type", "source_id", "target_id").filter("type = 'PART_OF'")
    return G.closure(r.select(F.col("source_id").alias("src"), F.col("target_id").alias("dst")))


@query("""WITH RECURSIVE a AS (SELECT DISTINCT source_id AS person, target_id AS unit FROM relations WHERE type = 'AFFILIATED_WITH' AND source_id IS NOT NULL AND target_id IS NOT NULL),
  p AS (SELECT DISTINCT source_id AS unit, target_id AS parent FROM relations WHERE type = 'PART_OF' AND source_id IS NOT NULL AND target_id IS NOT NULL AND source_id <> target_id),
  up(unit, top) AS (SELECT unit, parent FROM p UNION SELECT up.unit, p.parent FROM up JOIN p ON p.unit = up.top)
  SELECT top, count(DISTINCT person) AS people FROM (SELECT person, unit AS top FROM a UNION SELECT a.person, up.top FROM a JOIN up USING (unit)) GROUP BY 1""")
def unit_tree_counts(spark, d):
    """People of each unit and of all units below it, counted once."""
    r = read_table(spark, d, "relations", "type", "source_id", "target_id").dropna()
    a = r.filter("type = 'AFFILIATED_WITH'").select(F.col("source_id").alias("person"), F.col("target_id").alias("unit")).distinct()
    above = G.closure(r.filter("type = 'PART_OF'").select(F.col("source_id").alias("src"), F.col("target_id").alias("dst")))
    up = a.join(above, F.col("unit") == F.col("node")).select("person", F.col("ancestor").alias("top"))
    return a.select("person", F.col("unit").alias("top")).unionByName(up).groupBy("top").agg(F.countDistinct("person").alias("people"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT source_id AS s, target_id AS t FROM relations WHERE type = 'PART_OF' AND source_id IS NOT NULL AND target_id IS NOT NULL),
  up(s, t) AS (SELECT s, t FROM e UNION SELECT up.s, e.t FROM up JOIN e ON e.s = up.t)
  SELECT e.s AS unit, e.t AS other FROM e JOIN up ON e.s = up.t AND e.t = up.s""")
def cycle_check(spark, d):
    """The PART_OF edges that lie on a cycle of any length, self-parts included."""
    e = read_table(spark, d, "relations", "type", "source_id", "target_id").filter("type = 'PART_OF'").select("source_id", "target_id").dropna().distinct()
    above = G.closure(e.select(F.col("source_id").alias("src"), F.col("target_id").alias("dst")))
    back = above.select(F.col("ancestor").alias("source_id"), F.col("node").alias("target_id"))
    own = e.filter("source_id = target_id")
    return e.join(back, ["source_id", "target_id"], "left_semi").unionByName(own).select(F.col("source_id").alias("unit"), F.col("target_id").alias("other"))


@query(f"WITH {_MEM} SELECT a.person AS a, b.person AS b, count(DISTINCT a.project) AS n_via, string_agg(DISTINCT a.project, ',' ORDER BY a.project) AS via FROM m a JOIN m b ON a.project = b.project AND a.person < b.person GROUP BY 1, 2 HAVING count(DISTINCT a.project) > 1")
def ego_shared_hubs(spark, d):
    m = membership(spark, d)
    p = m.alias("l").join(m.alias("r"), (F.col("l.project") == F.col("r.project")) & (F.col("l.person") < F.col("r.person")))
    via = F.collect_set("l.project")
    return p.groupBy(F.col("l.person").alias("a"), F.col("r.person").alias("b")).agg(F.size(via).cast("bigint").alias("n_via"), F.array_join(F.array_sort(via), ",").alias("via")).filter("n_via > 1")


@query("""WITH t AS (SELECT DISTINCT subject.canonical_id AS p, value AS term FROM claims WHERE predicate = 'research_area' AND value IS NOT NULL AND subject.canonical_id IS NOT NULL)
  SELECT a.term AS term_a, b.term AS term_b, count(*) AS persons FROM t a JOIN t b ON a.p = b.p AND a.term < b.term GROUP BY 1, 2""")
def related_terms(spark, d):
    c = read_table(spark, d, "claims", "subject", "predicate", "value").filter("predicate = 'research_area' AND value IS NOT NULL AND subject.canonical_id IS NOT NULL")
    t = c.select(F.col("subject.canonical_id").alias("p"), F.col("value").alias("term")).distinct()
    pairs = t.alias("l").join(t.alias("r"), (F.col("l.p") == F.col("r.p")) & (F.col("l.term") < F.col("r.term")))
    return pairs.groupBy(F.col("l.term").alias("term_a"), F.col("r.term").alias("term_b")).agg(F.count(F.lit(1)).alias("persons"))


@query("""SELECT relation_id, type FROM (SELECT DISTINCT relation_id, type, valid_from, valid_until, first_observed_at, last_observed_at FROM relations) WHERE CASE WHEN valid_from IS NOT NULL
  THEN CAST(substr(valid_from, 1, 4) AS INT) <= 2020 AND coalesce(CAST(substr(valid_until, 1, 4) AS INT), 9999) >= 2020 ELSE year(first_observed_at AT TIME ZONE 'UTC') <= 2020 AND year(last_observed_at AT TIME ZONE 'UTC') >= 2020 END GROUP BY ALL""")
def active_in_year(spark, d):
    r = read_table(spark, d, "relations", "relation_id", "type", "valid_from", "valid_until", "first_observed_at", "last_observed_at")
    y = lambda c: F.substring(c, 1, 4).cast("int")
    stated = (y("valid_from") <= 2020) & (F.coalesce(y("valid_until"), F.lit(9999)) >= 2020)
    seen = (F.year("first_observed_at") <= 2020) & (F.year("last_observed_at") >= 2020)
    return r.filter(F.when(F.col("valid_from").isNotNull(), stated).otherwise(seen)).select("relation_id", "type").distinct()


@query("""WITH a AS (SELECT DISTINCT source_id AS p, target_id AS u, valid_from AS f, valid_until AS t FROM relations WHERE type = 'AFFILIATED_WITH' AND source_id IS NOT NULL AND target_id IS NOT NULL)
  SELECT DISTINCT x.p AS person, x.u AS from_unit, y.u AS to_unit FROM a x JOIN a y ON x.p = y.p AND x.u <> y.u AND x.t <= y.f""")
def migration(spark, d):
    a = read_table(spark, d, "relations", "type", "source_id", "target_id", "valid_from", "valid_until").filter("type = 'AFFILIATED_WITH' AND source_id IS NOT NULL AND target_id IS NOT NULL").distinct()
    moved = a.alias("x").join(a.alias("y"), (F.col("x.source_id") == F.col("y.source_id")) & (F.col("x.target_id") != F.col("y.target_id")) & (F.col("x.valid_until") <= F.col("y.valid_from")))
    return moved.select(F.col("x.source_id").alias("person"), F.col("x.target_id").alias("from_unit"), F.col("y.target_id").alias("to_unit")).distinct()


@query("""SELECT source_id, target_id, CASE WHEN bool_or(type = 'PRINCIPAL_INVESTIGATOR_OF') THEN 'lead' ELSE 'member' END AS role, string_agg(DISTINCT type, ',' ORDER BY type) AS types, bool_or(epistemic_status = 'OBSERVED') AS observed
  FROM relations WHERE source_id IS NOT NULL AND target_id IS NOT NULL GROUP BY 1, 2""")
def assemble_edges(spark, d):
    """Parallel edges merged: leadership outranks participation, observed wins."""
    r = read_table(spark, d, "relations", "source_id", "target_id", "type", "epistemic_status").filter("source_id IS NOT NULL AND target_id IS NOT NULL")
    return r.groupBy("source_id", "target_id").agg(
        F.when(F.bool_or(F.col("type") == "PRINCIPAL_INVESTIGATOR_OF"), "lead").otherwise("member").alias("role"),
        F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"), F.bool_or(F.col("epistemic_status") == "OBSERVED").alias("observed"),
    )


_PRUNE = ", ".join(
    f"d{i} AS (SELECT id FROM (SELECT a AS id FROM e{i - 1} UNION ALL SELECT b FROM e{i - 1}) GROUP BY 1 HAVING count(*) >= 3), e{i} AS (SELECT a, b FROM e{i - 1} WHERE a IN (SELECT id FROM d{i}) AND b IN (SELECT id FROM d{i}))"
    for i in range(1, 6)
)


@query(f"WITH {_EDGES}, e0 AS (SELECT a, b FROM e), {_PRUNE} SELECT a AS src, b AS dst FROM e5")
def min_degree_filter(spark, d):
    return G.prune(edges(spark, d), 3, 5)


@query("""WITH p AS (SELECT canonical_id, max(orcid) AS orcid, max(mtmt_id) AS mtmt FROM person GROUP BY 1) SELECT count(*) AS persons, count(*) FILTER (orcid IS NOT NULL OR mtmt IS NOT NULL) AS with_id,
  count(*) FILTER (canonical_id IN (SELECT source_id FROM relations WHERE type = 'PARTICIPATES_IN')) AS with_project, count(*) FILTER (canonical_id IN (SELECT source_id FROM relations WHERE type = 'AFFILIATED_WITH')) AS with_affiliation FROM p""")
def readiness_shares(spark, d):
    """Readiness counts of persons, each with its denominator."""
    p = read_table(spark, d, "person", "canonical_id", "orcid", "mtmt_id").groupBy("canonical_id").agg(F.max("orcid").alias("o"), F.max("mtmt_id").alias("m"))
    r = read_table(spark, d, "relations", "type", "source_id").filter("type IN ('PARTICIPATES_IN', 'AFFILIATED_WITH')")
    has = r.groupBy(F.col("source_id").alias("canonical_id")).agg(F.bool_or(F.col("type") == "PARTICIPATES_IN").alias("pr"), F.bool_or(F.col("type") == "AFFILIATED_WITH").alias("af"))
    j = p.join(has, "canonical_id", "left")
    return j.agg(F.count(F.lit(1)).alias("persons"), F.count_if(F.expr("o IS NOT NULL OR m IS NOT NULL")).alias("with_id"), F.count_if(F.coalesce("pr", F.lit(False))).alias("with_project"), F.count_if(F.coalesce("af", F.lit(False))).alias("with_affiliation"))


@query(f"""WITH m0 AS (SELECT target_id AS project, source_id AS person, bool_or(epistemic_status = 'OBSERVED') AS c FROM relations WHERE type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF') AND source_id IS NOT NULL AND target_id IS NOT NULL GROUP BY 1, 2),
  v AS (SELECT 'default' AS variant, project, person FROM m0 UNION ALL SELECT 'strict', project, person FROM m0 WHERE c UNION ALL SELECT 'complete', project, person FROM m0 WHERE project IN (SELECT project FROM m0 GROUP BY 1 HAVING bool_and(c)))
  SELECT variant, count(*) AS memberships, count(DISTINCT person) AS persons, count(DISTINCT project) AS projects FROM v GROUP BY 1""")
def identity_variants(spark, d):
    r = read_table(spark, d, "relations", "type", "source_id", "target_id", "epistemic_status").filter("type IN ('PARTICIPATES_IN', 'PRINCIPAL_INVESTIGATOR_OF') AND source_id IS NOT NULL AND target_id IS NOT NULL")
    m = r.groupBy(F.col("target_id").alias("project"), F.col("source_id").alias("person")).agg(F.bool_or(F.col("epistemic_status") == "OBSERVED").alias("c"))
    m = m.join(m.groupBy("project").agg(F.bool_and("c").alias("whole")), "project")
    kinds = F.array_compact(F.array(F.lit("default"), F.when(F.col("c"), "strict"), F.when(F.col("whole"), "complete")))
    v = m.select(F.explode(kinds).alias("variant"), "project", "person")
    return v.groupBy("variant").agg(F.count(F.lit(1)).alias("memberships"), F.countDistinct("person").alias("persons"), F.countDistinct("project").alias("projects"))


@query()
def clusters_blocked(spark, d):
    """Clusters of the confirmed match rows, where rejected rows block joins."""
    m = read_table(spark, d, "matches", "left", "right", "status", "score").filter("`left` IS NOT NULL AND `right` IS NOT NULL AND `left` <> `right`")
    status = F.when(F.lower(F.trim("status")) == "confirmed_match", "CONFIRMED").when(F.lower(F.trim("status")) == "rejected_match", "REJECTED")
    v = m.select(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b"), status.alias("status"), F.coalesce("score", F.lit(0.0)).alias("score"))
    return ER.blocked_clusters(v.filter("status IS NOT NULL").groupBy("a", "b", "status").agg(F.max("score").alias("score")))


@query("""WITH c AS (SELECT DISTINCT unnest(source_refs) AS ref, canonical_id AS cluster FROM person), k AS (SELECT ref, canonical_id, min(t) AS at FROM (SELECT unnest(source_refs) AS ref, canonical_id, first_observed_at AS t FROM person WHERE first_observed_at IS NOT NULL) GROUP BY ref, canonical_id),
  ch AS (SELECT cluster, arg_min(k.canonical_id, (k.at, k.canonical_id)) AS old FROM c JOIN k USING (ref) GROUP BY 1), kp AS (SELECT old, min(cluster) AS cluster FROM ch GROUP BY 1), ls AS (SELECT cluster, min(ref) AS least FROM c GROUP BY 1)
  SELECT c.ref, coalesce(kp.old, 'ent_' || substr(sha1(ls.least), 1, 10)) AS canonical_id, kp.old IS NULL AS is_new FROM c JOIN ls USING (cluster) LEFT JOIN kp USING (cluster)""")
def stable_ids(spark, d):
    p = read_table(spark, d, "person", "canonical_id", "source_refs", "first_observed_at").select("canonical_id", F.explode("source_refs").alias("ref"), "first_observed_at")
    known = p.filter("first_observed_at IS NOT NULL").groupBy("ref", "canonical_id").agg(F.min("first_observed_at").alias("assigned_at"))
    return ER.stable_ids(p.select("ref", F.col("canonical_id").alias("cluster")).distinct(), known)


@query(f"""WITH {_MEM}, t AS (SELECT DISTINCT a.person AS a, b.person AS b FROM m a JOIN m b ON a.project = b.project AND a.person < b.person), {_SITE},
  x AS (SELECT person, min(site) AS c FROM s GROUP BY 1), k AS (SELECT a AS id, count(*) AS d FROM (SELECT a FROM t UNION ALL SELECT b FROM t) GROUP BY 1), mm AS (SELECT count(*) AS m FROM t),
  ins AS (SELECT count(*) AS l FROM t JOIN x p ON p.person = t.a JOIN x q ON q.person = t.b WHERE p.c = q.c), dd AS (SELECT c, sum(d) AS d FROM k JOIN x ON x.person = k.id GROUP BY 1)
  SELECT CAST(round(1000000 * ((SELECT l FROM ins) / max(m) - sum(d * d) / (4.0 * max(m) * max(m)))) AS BIGINT) AS modularity_millionths FROM dd, mm""")
def modularity(spark, d):
    """Modularity of the tie graph under the partition of persons by their first site."""
    t = G.ties(membership(spark, d)).select("a", "b")
    x = sites(spark, d).groupBy("person").agg(F.min("site").alias("c"))
    both = t.select(F.explode(F.array("a", "b")).alias("person")).groupBy("person").agg(F.count(F.lit(1)).alias("d")).join(x, "person").groupBy("c").agg(F.sum("d").alias("d"))
    inside = t.join(x.select(F.col("person").alias("a"), F.col("c").alias("ca")), "a").join(x.select(F.col("person").alias("b"), F.col("c").alias("cb")), "b").filter("ca = cb").agg(F.count(F.lit(1)).alias("l"))
    m = t.agg(F.count(F.lit(1)).alias("m"))
    sq = both.agg(F.sum(F.col("d") * F.col("d")).alias("sq"))
    one = inside.crossJoin(m).crossJoin(sq)  # three single rows
    return one.select(F.round(1000000 * (F.col("l") / F.col("m") - F.col("sq") / (4.0 * F.col("m") * F.col("m")))).cast("bigint").alias("modularity_millionths"))


@query("""SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS hour, event_type, count(*) AS n, min(event_id) AS first_event FROM events GROUP BY ALL""")
def window_tumbling(spark, d):
    e = read_table(spark, d, "events", "ts", "event_type", "event_id")
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event")).select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type", "n", "first_event")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), k AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
  SELECT user_id, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS begun FROM k GROUP BY user_id, k""")
def session_windows(spark, d):
    e = read_table(spark, d, "events", "user_id", "ts")
    s = e.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", "n", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("begun"))


@query("SELECT user_id, event_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen, count(*) AS n FROM events GROUP BY 1, 2")
def first_last_observed(spark, d):
    e = read_table(spark, d, "events", "user_id", "event_type", "ts")
    f = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return e.groupBy("user_id", "event_type").agg(f(F.min("ts")).alias("first_seen"), f(F.max("ts")).alias("last_seen"), F.count(F.lit(1)).alias("n"))


QUERIES, ORACLES = R.queries, R.oracles
