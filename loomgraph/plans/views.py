"""Canned views over the graph: profiles, directories, overview, projections, diagnostics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomgraph.functions import text, urls
from loomgraph.operators import graph as G
from loomgraph.operators.windows import best_row, top_share
from loomgraph.plans.graphs import _MEM, _SITE, membership, sites
from loomgraph.plans.registry import Registry
from loomgraph.plans.texts import _HOST
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query
_REL = "r AS (SELECT DISTINCT type, source_id, target_id FROM relations WHERE source_id IS NOT NULL AND target_id IS NOT NULL)"


def _relations(spark, d, *types):
    r = read_table(spark, d, "relations", "type", "source_id", "target_id").dropna()
    return (r.filter(F.col("type").isin(*types)) if types else r).distinct()


@query(f"WITH {_REL} SELECT canonical_id FROM org_units WHERE len(source_refs) > 0 AND canonical_id IN (SELECT target_id FROM r WHERE type IN ('AFFILIATED_WITH','MEMBER_OF','HOSTED_BY'))")
def covered_units(spark, d):
    u = read_table(spark, d, "org_units", "canonical_id", "source_refs").filter("size(source_refs) > 0").select("canonical_id")
    return u.join(_relations(spark, d, "AFFILIATED_WITH", "MEMBER_OF", "HOSTED_BY").select(F.col("target_id").alias("canonical_id")), "canonical_id", "left_semi")


@query("""WITH t AS (SELECT DISTINCT subject.canonical_id AS p, value AS term FROM claims WHERE predicate = 'research_area' AND value IS NOT NULL AND subject.canonical_id IS NOT NULL),
  c AS (SELECT a.term, b.term AS other, count(*) AS n FROM t a JOIN t b ON a.p = b.p AND a.term <> b.term GROUP BY 1, 2)
  SELECT term, other, n, CAST(k AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY n DESC, other) AS k FROM c) WHERE k <= 3""")
def term_cards(spark, d):
    """The three terms that most often stand beside each term."""
    c = read_table(spark, d, "claims", "subject", "predicate", "value").filter("predicate = 'research_area' AND value IS NOT NULL AND subject.canonical_id IS NOT NULL")
    t = c.select(F.col("subject.canonical_id").alias("p"), F.col("value").alias("term")).distinct()
    pairs = t.join(t.withColumnRenamed("term", "other"), "p").filter("term <> other").groupBy("term", "other").agg(F.count(F.lit(1)).alias("n"))
    return pairs.withColumn("place", F.row_number().over(Window.partitionBy("term").orderBy(F.desc("n"), "other"))).filter("place <= 3")


@query(f"WITH {_REL} SELECT coalesce(target_id, 'none') AS unit, count(*) AS people FROM (SELECT DISTINCT canonical_id FROM person) p LEFT JOIN (SELECT * FROM r WHERE type = 'AFFILIATED_WITH') r ON r.source_id = p.canonical_id GROUP BY 1")
def people_by_affiliation(spark, d):
    p = read_table(spark, d, "person", "canonical_id").distinct()
    a = _relations(spark, d, "AFFILIATED_WITH").select(F.col("source_id").alias("canonical_id"), "target_id")
    return p.join(a, "canonical_id", "left").groupBy(F.coalesce("target_id", F.lit("none")).alias("unit")).agg(F.count(F.lit(1)).alias("people"))


@query(f"""WITH {_REL} SELECT source_id AS person, count(DISTINCT target_id) AS units, min(target_id) AS one, max(target_id) AS other FROM r WHERE type = 'AFFILIATED_WITH' GROUP BY 1 HAVING count(DISTINCT target_id) > 1""")
def slice_bridge(spark, d):
    """Persons who bridge units."""
    a = _relations(spark, d, "AFFILIATED_WITH")
    return a.groupBy(F.col("source_id").alias("person")).agg(F.countDistinct("target_id").alias("units"), F.min("target_id").alias("one"), F.max("target_id").alias("other")).filter("units > 1")


@query("""SELECT canonical_id, coalesce(len(conflict), 0) > 1 AS has_conflicts, search_text FROM (SELECT canonical_id, list_distinct(list(label)) AS conflict, array_to_string(list_sort(list_distinct(list(lower(strip_accents(label))))), ' ') AS search_text FROM person WHERE label IS NOT NULL GROUP BY 1)""")
def node_projection(spark, d):
    p = read_table(spark, d, "person", "canonical_id", "label").filter("label IS NOT NULL")
    g = p.groupBy("canonical_id").agg((F.countDistinct("label") > 1).alias("has_conflicts"), F.array_join(F.array_sort(F.collect_set(F.lower(text.strip_accents(F.col("label"))))), " ").alias("search_text"))
    return g


@query("""SELECT DISTINCT relation_id, type, CAST(substr(valid_from, 1, 4) AS INT) AS from_year, CAST(substr(valid_until, 1, 4) AS INT) AS until_year, epistemic_status = 'OBSERVED' AS observed, coalesce(array_to_string(qualifiers['role'], '|'), '') AS role FROM relations""")
def edge_projection(spark, d):
    r = read_table(spark, d, "relations", "relation_id", "type", "valid_from", "valid_until", "epistemic_status", "qualifiers")
    year = lambda c: F.substring(c, 1, 4).cast("int")
    role = F.coalesce(F.array_join(F.try_element_at("qualifiers", F.lit("role")), "|"), F.lit(""))
    return r.select("relation_id", "type", year("valid_from").alias("from_year"), year("valid_until").alias("until_year"), (F.col("epistemic_status") == "OBSERVED").alias("observed"), role.alias("role")).distinct()


@query("SELECT DISTINCT c AS claim_id, relation_id AS about FROM (SELECT relation_id, unnest(claim_ids) AS c FROM relations) UNION SELECT claim_id, subject.canonical_id FROM claims WHERE subject.canonical_id IS NOT NULL")
def claim_about(spark, d):
    r = read_table(spark, d, "relations", "relation_id", "claim_ids").select(F.explode("claim_ids").alias("claim_id"), F.col("relation_id").alias("about"))
    c = read_table(spark, d, "claims", "claim_id", "subject").select("claim_id", F.col("subject.canonical_id").alias("about")).filter("about IS NOT NULL")
    return r.unionByName(c).distinct()


@query("""WITH s AS (SELECT DISTINCT "left" AS l, "right" AS r, method, coalesce(signals['name_key'], '0') = '1' AS nk, coalesce(signals['same_host'], '0') = '1' AS sh FROM matches WHERE "left" IS NOT NULL AND "right" IS NOT NULL),
  g AS (SELECT l, r, bool_or(nk) AS nk, bool_or(sh) AS sh, bool_or(method = 'auto:hard_id') AS hid, bool_or(method = 'manual:not_same_as') AS no FROM s GROUP BY 1, 2)
  SELECT l AS left_ref, r AS right_ref, CASE WHEN no THEN 'rejected' WHEN hid AND nk THEN 'hard_id_name' WHEN nk AND sh THEN 'name_host' WHEN nk THEN 'review:name' WHEN sh THEN 'review:host' ELSE 'open' END AS decision FROM g""")
def mention_rules(spark, d):
    """Signals of a pair united, then the first rule whose needs are met and whose blocks are absent."""
    m = read_table(spark, d, "matches", "left", "right", "method", "signals").filter("`left` IS NOT NULL AND `right` IS NOT NULL")
    has = lambda k: F.bool_or(F.coalesce(F.try_element_at("signals", F.lit(k)), F.lit("0")) == "1")
    g = m.groupBy(F.col("left").alias("left_ref"), F.col("right").alias("right_ref")).agg(has("name_key").alias("nk"), has("same_host").alias("sh"), F.coalesce(F.bool_or(F.col("method") == "auto:hard_id"), F.lit(False)).alias("hid"), F.coalesce(F.bool_or(F.col("method") == "manual:not_same_as"), F.lit(False)).alias("no"))
    rule = F.when(F.col("no"), "rejected").when(F.expr("hid AND nk"), "hard_id_name").when(F.expr("nk AND sh"), "name_host").when(F.col("nk"), "review:name").when(F.col("sh"), "review:host").otherwise("open")
    return g.select("left_ref", "right_ref", rule.alias("decision"))


@query("""WITH p AS (SELECT "left" AS l, count(DISTINCT "right") AS n, min("right") AS r FROM matches WHERE lower(trim(status)) = 'possible_match' AND "left" IS NOT NULL AND "right" IS NOT NULL GROUP BY 1)
  SELECT l AS mention, r AS only_candidate FROM p WHERE n = 1 AND l NOT IN (SELECT "left" FROM matches WHERE lower(trim(status)) = 'confirmed_match' AND "left" IS NOT NULL)""")
def review_upper_bound(spark, d):
    """Open references with exactly one possible partner."""
    m = read_table(spark, d, "matches", "left", "right", "status").withColumn("s", F.lower(F.trim("status")))
    one = m.filter("s = 'possible_match' AND `left` IS NOT NULL AND `right` IS NOT NULL").groupBy(F.col("left").alias("mention")).agg(F.countDistinct("right").alias("n"), F.min("right").alias("only_candidate")).filter("n = 1")
    return one.join(m.filter("s = 'confirmed_match'").select(F.col("left").alias("mention")), "mention", "left_anti").select("mention", "only_candidate")




@query(f"""WITH k AS (SELECT canonical_id, string_split(trim(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM (SELECT DISTINCT canonical_id, title FROM project WHERE title IS NOT NULL)),
  t AS (SELECT DISTINCT trim(regexp_replace(lower(strip_accents(value)), '[^a-z0-9]+', ' ', 'g')) AS term FROM claims WHERE predicate = 'research_area' AND value IS NOT NULL)
  SELECT DISTINCT canonical_id, term FROM k JOIN t ON contains(' ' || array_to_string(w, ' ') || ' ', ' ' || term || ' ') WHERE len(string_split(term, ' ')) <= 3""")
def contains_join(spark, d):
    """Titles that contain a term: an equi-join of the titles' word runs with the terms, no pairwise test."""
    key = lambda c: text.title_fold(F.col(c))
    k = read_table(spark, d, "project", "canonical_id", "title").filter("title IS NOT NULL").distinct().select("canonical_id", F.split(key("title"), " ").alias("w"))
    runs = lambda n: F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))
    words = k.select("canonical_id", F.explode(F.array_distinct(F.concat(runs(1), runs(2), runs(3)))).alias("term"))
    terms = read_table(spark, d, "claims", "predicate", "value").filter("predicate = 'research_area' AND value IS NOT NULL").select(key("value").alias("term")).distinct()
    return words.join(terms, "term").select("canonical_id", "term")


@query("""SELECT doc_id, CAST((text IS NOT NULL)::INT + (lang IS NOT NULL)::INT + (page_title IS NOT NULL)::INT + (raw_path IS NOT NULL)::INT AS INT) AS fields,
  CASE WHEN http_status >= 400 THEN 'error' WHEN text IS NULL OR trim(text) = '' THEN 'empty' ELSE 'ok' END AS status FROM documents""")
def page_diagnostics(spark, d):
    t = read_table(spark, d, "documents", "doc_id", "text", "lang", "page_title", "raw_path", "http_status")
    n = sum((F.col(c).isNotNull().cast("int") for c in ("lang", "page_title", "raw_path")), F.col("text").isNotNull().cast("int"))
    return t.select("doc_id", n.alias("fields"), F.when(F.col("http_status") >= 400, "error").when(F.col("text").isNull() | (F.trim("text") == ""), "empty").otherwise("ok").alias("status"))


@query(rf"""WITH h AS (SELECT DISTINCT canonical_id, {_HOST.format('u')} AS host FROM (SELECT canonical_id, unnest(profile_urls) AS u FROM person)),
  f AS (SELECT canonical_id, string_agg(DISTINCT host, ',' ORDER BY host) AS hosts FROM h WHERE host IS NOT NULL GROUP BY 1), {_SITE}, g AS (SELECT person, string_agg(DISTINCT site, ',' ORDER BY site) AS sites FROM s GROUP BY 1)
  SELECT p.canonical_id, coalesce(hosts, sites, 'other') AS sources FROM (SELECT DISTINCT canonical_id FROM person) p LEFT JOIN f ON f.canonical_id = p.canonical_id LEFT JOIN g ON g.person = p.canonical_id""")
def entity_sources(spark, d):
    """Sources of a person by the hosts of its profiles, else by its references, else ``other``."""
    p = read_table(spark, d, "person", "canonical_id", "profile_urls")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    hosts = p.select("canonical_id", F.explode("profile_urls").alias("u")).select("canonical_id", urls.host(F.col("u")).alias("h")).filter("h IS NOT NULL").groupBy("canonical_id").agg(joined("h").alias("hosts"))
    own = sites(spark, d).groupBy(F.col("person").alias("canonical_id")).agg(joined("site").alias("sites"))
    return p.select("canonical_id").distinct().join(hosts, "canonical_id", "left").join(own, "canonical_id", "left").select("canonical_id", F.coalesce("hosts", "sites", F.lit("other")).alias("sources"))


@query("""SELECT canonical_id, title, "start" FROM (SELECT DISTINCT canonical_id, title, "start", status_label FROM project WHERE title IS NOT NULL) ORDER BY (CASE WHEN status_label = 'futó' THEN 0 ELSE 1 END), "start" DESC NULLS LAST, title, canonical_id LIMIT 25""")
def recent_projects(spark, d):
    """Top-k view: running first, then by start, newest first."""
    p = read_table(spark, d, "project", "canonical_id", "title", "start", "status_label").filter("title IS NOT NULL").distinct()
    return p.orderBy(F.when(F.col("status_label") == "futó", 0).otherwise(1), F.desc_nulls_last("start"), "title", "canonical_id").limit(25).select("canonical_id", "title", "start")


@query("""WITH a AS (SELECT o_custkey AS k, count(*) AS n, CAST(round(sum(o_totalprice)) AS BIGINT) AS v FROM orders GROUP BY 1), k AS (SELECT CAST(ceil(count(*) * 10 / 100) AS BIGINT) AS k FROM a),
  x AS (SELECT k FROM a WHERE n >= (SELECT min(n) FROM (SELECT n FROM a ORDER BY n DESC LIMIT (SELECT k FROM k)))), y AS (SELECT k FROM a WHERE v >= (SELECT min(v) FROM (SELECT v FROM a ORDER BY v DESC LIMIT (SELECT k FROM k))))
  SELECT (SELECT count(*) FROM x JOIN y USING (k)) AS shared, (SELECT count(*) FROM (SELECT k FROM x UNION SELECT k FROM y)) AS united""")
def jaccard(spark, d):
    """Overlap of the top tenths by two measures."""
    a = read_table(spark, d, "orders", "o_custkey", "o_totalprice").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice")).cast("bigint").alias("v"))
    x, y = top_share(a, "n", 10).select("k", F.lit(1).alias("x")), top_share(a, "v", 10).select("k", F.lit(1).alias("y"))
    return x.join(y, "k", "full").agg(F.count_if(F.expr("x = 1 AND y = 1")).alias("shared"), F.count(F.lit(1)).alias("united"))


@query("""WITH n AS (SELECT source, count(*) AS of, count(*) FILTER (lang IS NOT NULL) AS n FROM documents GROUP BY 1) SELECT source, n, of, CAST((200 * n + of) // (2 * of) AS BIGINT) AS percent FROM n""")
def percent_half_up(spark, d):
    n = read_table(spark, d, "documents", "source", "lang").groupBy("source").agg(F.count(F.lit(1)).alias("of"), F.count_if(F.col("lang").isNotNull()).alias("n"))
    return n.select("source", "n", "of", F.expr("(200 * n + of) DIV (2 * of)").alias("percent"))


@query("""WITH a AS (SELECT canonical_id, list_distinct([x for x in position_titles if x IS NOT NULL]) AS t FROM person WHERE position_titles IS NOT NULL GROUP BY ALL)
  SELECT DISTINCT canonical_id, array_to_string(list_sort([x for x in t if NOT list_bool_or([y <> x AND contains(y, x) for y in t])]), '|') AS kept FROM a WHERE len(t) > 0""")
def contained_dropped(spark, d):
    """Titles that are part of another title of the same list go."""
    a = read_table(spark, d, "person", "canonical_id", "position_titles").filter("size(position_titles) > 0").select("canonical_id", F.array_distinct(F.filter("position_titles", lambda x: x.isNotNull())).alias("t")).filter("size(t) > 0")
    kept = F.filter("t", lambda x: ~F.exists("t", lambda y: (y != x) & F.contains(y, x)))
    return a.select("canonical_id", F.array_join(F.array_sort(kept), "|").alias("kept")).distinct()


@query(f"""WITH RECURSIVE {_REL}, e AS (SELECT source_id AS s, target_id AS t FROM r WHERE type IN ('PART_OF') AND source_id <> target_id), up(p, u) AS (SELECT source_id, target_id FROM r WHERE type = 'AFFILIATED_WITH' UNION SELECT up.p, e.t FROM up JOIN e ON e.s = up.u)
  SELECT DISTINCT p AS person FROM up JOIN org_units o ON o.canonical_id = up.u WHERE o.entity_type = 'Institution'""")
def reaches_root(spark, d):
    """Persons whose affiliation leads up to an institution."""
    a = _relations(spark, d, "AFFILIATED_WITH").select(F.col("source_id").alias("person"), F.col("target_id").alias("node"))
    up = G.closure(_relations(spark, d, "PART_OF").select(F.col("source_id").alias("src"), F.col("target_id").alias("dst")))
    tops = read_table(spark, d, "org_units", "canonical_id", "entity_type").filter("entity_type = 'Institution'").select(F.col("canonical_id").alias("node"))
    reach = a.unionByName(a.join(up, "node").select("person", F.col("ancestor").alias("node")))
    return reach.join(tops, "node", "left_semi").select("person").distinct()


@query("""SELECT document_id, doc_id FROM documents WHERE document_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY retrieved_at NULLS LAST, doc_id) = 1""")
def first_wins(spark, d):
    t = read_table(spark, d, "documents", "document_id", "doc_id", "retrieved_at").filter("document_id IS NOT NULL")
    return best_row(t, ["document_id"], F.asc_nulls_last("retrieved_at"), F.asc("doc_id")).select("document_id", "doc_id")


QUERIES, ORACLES = R.queries, R.oracles
