"""Queries over claims and tables: aggregation, windows, joins, sets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomgraph.operators import claims as C
from loomgraph.operators.skew import salted_join
from loomgraph.operators.windows import average_rank, best_row, top_share
from loomgraph.plans.registry import Registry
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query


def _stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


_RANK = "CASE {0} WHEN 'OBSERVED' THEN 0 WHEN 'DERIVED' THEN 1 WHEN 'INFERRED' THEN 2 WHEN 'INTERPRETIVE' THEN 3 ELSE 4 END"


@query(f"""SELECT predicate, subject.canonical_id AS source_id, object.canonical_id AS target_id,
  min(CASE WHEN temporal_basis='EXPLICIT' THEN valid_from END) AS valid_from,
  CASE WHEN count(*) FILTER (temporal_basis='EXPLICIT') = count(CASE WHEN temporal_basis='EXPLICIT' THEN valid_until END) THEN max(CASE WHEN temporal_basis='EXPLICIT' THEN valid_until END) END AS valid_until,
  CASE WHEN bool_or(temporal_basis='EXPLICIT') THEN 'EXPLICIT' WHEN bool_or(temporal_basis='OBSERVED_AT') THEN 'OBSERVED_AT' ELSE 'UNKNOWN' END AS temporal_basis,
  arg_min(epistemic_status, {_RANK.format('epistemic_status')}) AS epistemic_status, max(confidence) AS confidence, count(DISTINCT claim_id) AS n_claims, count(DISTINCT document_id) AS n_documents,
  array_to_string(coalesce(list_sort(list_distinct(list(assertion_type) FILTER (assertion_type IS NOT NULL))), []), ',') AS assertion_types
  FROM claims WHERE object.canonical_id IS NOT NULL AND subject.canonical_id IS NOT NULL GROUP BY 1, 2, 3""")
def claim_to_relation(spark, d):
    cols = ["claim_id", "subject", "predicate", "object", "valid_from", "valid_until", "temporal_basis", "epistemic_status", "confidence", "document_id", "assertion_type"]
    return C.relations(read_table(spark, d, "claims", *cols))


@query("""WITH v AS (SELECT subject.canonical_id AS s, predicate, value, count(DISTINCT document_id) AS n, max(confidence) AS c, max(observed_at) AS l, min(observed_at) AS f FROM claims
   WHERE value IS NOT NULL AND subject.canonical_id IS NOT NULL GROUP BY ALL)
  SELECT s AS subject_id, predicate, value, n AS n_documents, count(*) OVER (PARTITION BY s, predicate) AS n_values FROM v
  QUALIFY row_number() OVER (PARTITION BY s, predicate ORDER BY n DESC, c DESC NULLS LAST, l DESC NULLS LAST, f NULLS LAST, value) = 1""")
def conflict_choice(spark, d):
    return C.chosen_values(read_table(spark, d, "claims", "subject", "predicate", "value", "document_id", "confidence", "observed_at"))


@query("""WITH v AS (SELECT subject.canonical_id AS s, predicate, value, min(observed_at) AS f FROM claims WHERE value IS NOT NULL AND subject.canonical_id IS NOT NULL AND predicate IN ('research_area','position_title') GROUP BY ALL)
  SELECT s AS subject_id, predicate, string_agg(value, '|' ORDER BY f NULLS LAST, value) AS vals FROM v GROUP BY s, predicate""")
def multi_value_fields(spark, d):
    c = read_table(spark, d, "claims", "subject", "predicate", "value", "observed_at").filter("value IS NOT NULL AND subject.canonical_id IS NOT NULL AND predicate IN ('research_area', 'position_title')")
    first = c.groupBy(F.col("subject.canonical_id").alias("subject_id"), "predicate", "value").agg(F.min("observed_at").alias("f"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("f").isNull().alias("n"), "f", "value")))
    return first.groupBy("subject_id", "predicate").agg(F.array_join(F.transform(ordered, lambda x: x["value"]), "|").alias("vals"))


@query(f"SELECT subject.canonical_id AS subject_id, arg_min(epistemic_status, {_RANK.format('epistemic_status')}) AS best, count(*) AS n FROM claims WHERE subject.canonical_id IS NOT NULL GROUP BY 1")
def best_status(spark, d):
    c = read_table(spark, d, "claims", "subject", "epistemic_status").filter("subject.canonical_id IS NOT NULL")
    return c.groupBy(F.col("subject.canonical_id").alias("subject_id")).agg(F.min_by("epistemic_status", C.rank_of(F.col("epistemic_status"), C.STATUS_ORDER)).alias("best"), F.count(F.lit(1)).alias("n"))


@query("""WITH d AS (SELECT DISTINCT subject.canonical_id AS k, value AS v FROM claims WHERE predicate = 'start' AND value IS NOT NULL AND subject.canonical_id IS NOT NULL),
  f AS (SELECT a.k, a.v, count(*) AS n, max(b.v) AS f FROM d a JOIN d b ON a.k = b.k AND starts_with(b.v, a.v || '-') GROUP BY 1, 2)
  SELECT d.k AS subject_id, d.v AS value, CASE WHEN n = 1 THEN f ELSE d.v END AS merged FROM d LEFT JOIN f ON d.k = f.k AND d.v = f.v""")
def partial_date_merge(spark, d):
    c = read_table(spark, d, "claims", "subject", "predicate", "value").filter("predicate = 'start' AND subject.canonical_id IS NOT NULL").select(F.col("subject.canonical_id").alias("subject_id"), "value")
    return C.merge_partial_dates(c, "subject_id", "value")


@query("""WITH v AS (SELECT subject.canonical_id AS s, value, count(*) AS n, min(observed_at) AS f FROM claims WHERE predicate = 'name' AND value IS NOT NULL AND subject.canonical_id IS NOT NULL GROUP BY ALL)
  SELECT s AS subject_id, value AS stated_name, n FROM v QUALIFY row_number() OVER (PARTITION BY s ORDER BY n DESC, f NULLS LAST, value) = 1""")
def mode_first_seen(spark, d):
    c = read_table(spark, d, "claims", "subject", "predicate", "value", "observed_at").filter("predicate = 'name' AND value IS NOT NULL AND subject.canonical_id IS NOT NULL")
    v = c.groupBy(F.col("subject.canonical_id").alias("subject_id"), F.col("value").alias("stated_name")).agg(F.count(F.lit(1)).alias("n"), F.min("observed_at").alias("f"))
    return best_row(v, ["subject_id"], F.desc("n"), F.asc_nulls_last("f"), F.asc("stated_name")).drop("f")


@query("SELECT document_id, strftime(max(retrieved_at) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS last_at, arg_max(doc_id, (retrieved_at, doc_id)) AS doc_id, count(*) AS n FROM documents WHERE document_id IS NOT NULL AND retrieved_at IS NOT NULL GROUP BY 1")
def latest_snapshot(spark, d):
    t = read_table(spark, d, "documents", "document_id", "doc_id", "retrieved_at").filter("document_id IS NOT NULL AND retrieved_at IS NOT NULL")
    return t.groupBy("document_id").agg(_stamp(F.max("retrieved_at")).alias("last_at"), F.max_by("doc_id", F.struct("retrieved_at", "doc_id")).alias("doc_id"), F.count(F.lit(1)).alias("n"))


@query("""SELECT relation_id, strftime(last_observed_at AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS last_observed_at, confidence FROM (SELECT DISTINCT relation_id, last_observed_at, confidence FROM relations)
  QUALIFY row_number() OVER (PARTITION BY relation_id ORDER BY last_observed_at DESC NULLS LAST, confidence DESC NULLS LAST) = 1""")
def last_wins_dedup(spark, d):
    r = read_table(spark, d, "relations", "relation_id", "last_observed_at", "confidence")
    return best_row(r, ["relation_id"], F.desc_nulls_last("last_observed_at"), F.desc_nulls_last("confidence")).withColumn("last_observed_at", _stamp(F.col("last_observed_at")))


@query("""WITH s AS (SELECT subject.canonical_id AS s, object.canonical_id AS o, CASE review_status WHEN 'CONFIRMED' THEN 1 WHEN 'UNREVIEWED' THEN 3 WHEN 'DISPUTED' THEN 4 ELSE 5 END AS r FROM claims WHERE predicate = 'PARTICIPATES_IN' AND object.canonical_id IS NOT NULL)
  SELECT s AS person_id, o AS project_id, min(r) AS strength FROM s GROUP BY 1, 2""")
def strongest_status(spark, d):
    c = read_table(spark, d, "claims", "subject", "object", "predicate", "review_status").filter("predicate = 'PARTICIPATES_IN' AND object.canonical_id IS NOT NULL")
    r = F.when(F.col("review_status") == "CONFIRMED", 1).when(F.col("review_status") == "UNREVIEWED", 3).when(F.col("review_status") == "DISPUTED", 4).otherwise(5)
    return c.groupBy(F.col("subject.canonical_id").alias("person_id"), F.col("object.canonical_id").alias("project_id")).agg(F.min(r).alias("strength"))


@query("""WITH b AS (SELECT source_id, target_id, bool_or(epistemic_status = 'OBSERVED') AS c, bool_or(epistemic_status = 'DERIVED') AS a FROM relations WHERE type IN ('PARTICIPATES_IN','PRINCIPAL_INVESTIGATOR_OF') GROUP BY 1, 2)
  SELECT CASE WHEN c AND a THEN 'certain+auto' WHEN c THEN 'certain' WHEN a THEN 'auto_only' ELSE 'other' END AS basis, count(*) AS n FROM b GROUP BY 1""")
def edge_basis(spark, d):
    r = read_table(spark, d, "relations", "type", "source_id", "target_id", "epistemic_status").filter("type IN ('PARTICIPATES_IN', 'PRINCIPAL_INVESTIGATOR_OF')")
    b = r.groupBy("source_id", "target_id").agg(F.bool_or(F.col("epistemic_status") == "OBSERVED").alias("c"), F.bool_or(F.col("epistemic_status") == "DERIVED").alias("a"))
    return b.groupBy(F.when(F.expr("c AND a"), "certain+auto").when(F.col("c"), "certain").when(F.col("a"), "auto_only").otherwise("other").alias("basis")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT coalesce(source, 'null') AS source, CAST(count(*) FILTER (text IS NOT NULL AND trim(text) <> '') AS BIGINT) AS n, count(*) AS total, CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (text IS NOT NULL AND trim(text) <> '') * 1000 // count(*) AS BIGINT) END AS per_mille, CAST(grouping(source) AS INT) AS is_total
  FROM documents GROUP BY GROUPING SETS ((source), ())""")
def share_table_with_total(spark, d):
    """Share with numerator and denominator for each source and over all."""
    t = read_table(spark, d, "documents", "source", "text").select("source", (F.col("text").isNotNull() & (F.trim("text") != "")).alias("ok"))
    n = F.count_if("ok")
    out = t.groupingSets([["source"], []], "source").agg(n.alias("n"), F.count(F.lit(1)).alias("total"), F.grouping("source").cast("int").alias("is_total"))
    return out.select(F.coalesce("source", F.lit("null")).alias("source"), "n", "total", F.expr("CASE WHEN total > 0 THEN n * 1000 DIV total END").alias("per_mille"), "is_total")


@query("""SELECT predicate, count(*) FILTER (review_status = 'CONFIRMED') AS confirmed, count(*) FILTER (review_status = 'REJECTED') AS rejected, count(*) FILTER (review_status = 'DISPUTED') AS disputed,
  count(*) FILTER (review_status = 'UNREVIEWED') AS unreviewed FROM claims GROUP BY 1""")
def status_pivot(spark, d):
    c = read_table(spark, d, "claims", "predicate", "review_status")
    one = lambda s: F.count_if(F.col("review_status") == s).alias(s.lower())
    return c.groupBy("predicate").agg(*map(one, ["CONFIRMED", "REJECTED", "DISPUTED", "UNREVIEWED"]))


@query("""WITH p AS (SELECT canonical_id, max(CASE WHEN orcid IS NOT NULL THEN 1 ELSE 0 END) AS o, max(CASE WHEN birth_year IS NOT NULL THEN 1 ELSE 0 END) AS b, max(CASE WHEN len(position_titles) > 0 THEN 1 ELSE 0 END) AS t FROM person GROUP BY 1),
  s AS (SELECT DISTINCT canonical_id, split_part(r, '|', 1) AS site FROM (SELECT canonical_id, unnest(source_refs) AS r FROM person)),
  u AS (SELECT site, canonical_id FROM s UNION ALL SELECT 'all', canonical_id FROM p)
  SELECT site, count(*) AS persons, CAST(sum(o) AS BIGINT) AS orcid, CAST(sum(b) AS BIGINT) AS birth_year, CAST(sum(t) AS BIGINT) AS position FROM u JOIN p USING (canonical_id) GROUP BY 1""")
def field_coverage(spark, d):
    """Filled fields by site; a person of several sites counts in each and once in ``all``."""
    rows = read_table(spark, d, "person", "canonical_id", "orcid", "birth_year", "position_titles", "source_refs")
    flag = lambda c: F.max(c.cast("int"))
    p = rows.groupBy("canonical_id").agg(
        flag(F.col("orcid").isNotNull()).alias("o"), flag(F.col("birth_year").isNotNull()).alias("b"), flag(F.coalesce(F.size("position_titles") > 0, F.lit(False))).alias("t"),
        F.array_distinct(F.flatten(F.collect_set(F.transform("source_refs", lambda r: F.substring_index(r, "|", 1))))).alias("sites"),
    )
    u = p.withColumn("site", F.explode(F.concat("sites", F.array(F.lit("all")))))
    return u.groupBy("site").agg(F.count(F.lit(1)).alias("persons"), F.sum("o").cast("bigint").alias("orcid"), F.sum("b").cast("bigint").alias("birth_year"), F.sum("t").cast("bigint").alias("position"))


@query("""WITH r AS (SELECT source, count(*) AS n, count(*) FILTER (lang IS NULL) AS k FROM documents GROUP BY 1 HAVING count(*) >= 20)
  SELECT max(k * 1000 // n) - min(k * 1000 // n) AS spread, count(*) AS groups FROM r""")
def rate_spread(spark, d):
    r = read_table(spark, d, "documents", "source", "lang").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("lang").isNull()).alias("k")).filter("n >= 20")
    rate = F.expr("k * 1000 DIV n")
    return r.agg((F.max(rate) - F.min(rate)).alias("spread"), F.count(F.lit(1)).alias("groups"))


@query("SELECT title, count(DISTINCT canonical_id) AS n, min(canonical_id) AS first_id FROM project WHERE title IS NOT NULL GROUP BY 1 HAVING count(DISTINCT canonical_id) > 1")
def duplicate_keys(spark, d):
    p = read_table(spark, d, "project", "title", "canonical_id").filter("title IS NOT NULL")
    return p.groupBy("title").agg(F.countDistinct("canonical_id").alias("n"), F.min("canonical_id").alias("first_id")).filter("n > 1")


@query("""SELECT coalesce(lang, 'none') AS lang, coalesce(source_type, 'none') AS source_type, count(*) AS docs, count(DISTINCT document_id) AS documents, count(DISTINCT institution_id) AS institutions FROM documents GROUP BY ALL""")
def nested_counts(spark, d):
    t = read_table(spark, d, "documents", "lang", "source_type", "document_id", "institution_id")
    return t.groupBy(F.coalesce("lang", F.lit("none")).alias("lang"), F.coalesce("source_type", F.lit("none")).alias("source_type")).agg(
        F.count(F.lit(1)).alias("docs"), F.countDistinct("document_id").alias("documents"), F.countDistinct("institution_id").alias("institutions")
    )


@query("""SELECT source_id, strftime(min(retrieved_at) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(retrieved_at) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS last_at, substr(sha256(string_agg(DISTINCT document_id, chr(10) ORDER BY document_id)), 1, 16) AS digest FROM documents WHERE document_id IS NOT NULL GROUP BY 1""")
def source_set_digest(spark, d):
    t = read_table(spark, d, "documents", "source_id", "document_id", "retrieved_at").filter("document_id IS NOT NULL")
    return t.groupBy("source_id").agg(_stamp(F.min("retrieved_at")).alias("first_at"), _stamp(F.max("retrieved_at")).alias("last_at"), F.substring(F.sha2(F.array_join(F.array_sort(F.collect_set("document_id")), "\n"), 256), 1, 16).alias("digest"))


@query("SELECT url, count(*) AS n, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, string_agg(DISTINCT coalesce(lang, '-'), ',' ORDER BY coalesce(lang, '-')) AS langs FROM documents WHERE url IS NOT NULL GROUP BY 1")
def merge_frontier(spark, d):
    t = read_table(spark, d, "documents", "url", "source", "lang").filter("url IS NOT NULL")
    join = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return t.groupBy("url").agg(F.count(F.lit(1)).alias("n"), join(F.col("source")).alias("sources"), join(F.coalesce("lang", F.lit("-"))).alias("langs"))


@query("SELECT DISTINCT relation_id, type FROM relations WHERE source_id IN (SELECT canonical_id FROM person) AND target_id IN (SELECT canonical_id FROM project UNION ALL SELECT canonical_id FROM org_units)")
def referential_filter(spark, d):
    r = read_table(spark, d, "relations", "relation_id", "type", "source_id", "target_id")
    people = read_table(spark, d, "person", "canonical_id").select(F.col("canonical_id").alias("source_id")).distinct()
    targets = read_table(spark, d, "project", "canonical_id").unionByName(read_table(spark, d, "org_units", "canonical_id")).select(F.col("canonical_id").alias("target_id")).distinct()
    held = salted_join(salted_join(r, people, "source_id", "left_semi"), targets, "target_id", "left_semi")
    return held.select("relation_id", "type").distinct()


@query("""(SELECT DISTINCT left_label AS name FROM matches WHERE left_label IS NOT NULL UNION SELECT right_label FROM matches WHERE right_label IS NOT NULL) EXCEPT SELECT canonical_name FROM person""")
def set_difference(spark, d):
    m = read_table(spark, d, "matches", "left_label", "right_label")
    names = m.select(F.explode(F.array("left_label", "right_label")).alias("name")).filter("name IS NOT NULL").distinct()
    return names.join(read_table(spark, d, "person", "canonical_name").select(F.col("canonical_name").alias("name")), "name", "left_anti")


@query("""SELECT entity_type, upper(trim(status)) AS status, count(*) AS n, count(DISTINCT "left") AS left_refs, min(score) AS least, max(score) AS greatest FROM matches GROUP BY ALL""")
def match_status(spark, d):
    m = read_table(spark, d, "matches", "entity_type", "status", "left", "score")
    return m.groupBy("entity_type", F.upper(F.trim("status")).alias("status")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("left").alias("left_refs"), F.min("score").alias("least"), F.max("score").alias("greatest"))


@query("""WITH v AS (SELECT s_suppkey, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1) SELECT s_suppkey, n, (rank() OVER (ORDER BY n)) + (count(*) OVER (PARTITION BY n) - 1) / 2 AS avg_rank FROM v""")
def average_ranks(spark, d):
    v = read_table(spark, d, "lineitem", "l_suppkey").join(read_table(spark, d, "supplier", "s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return average_rank(v, "n").select("s_suppkey", "n", "avg_rank")


@query("""WITH v AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), c AS (SELECT n FROM v ORDER BY n DESC LIMIT (SELECT CAST(ceil(count(*) * 10 / 100) AS BIGINT) FROM v))
  SELECT o_custkey, n FROM v WHERE n >= (SELECT min(n) FROM c) AND n > 0""")
def top_share_with_ties(spark, d):
    v = read_table(spark, d, "orders", "o_custkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return top_share(v, "n", 10)


@query("""WITH a AS (SELECT l_suppkey AS k, count(*) AS x, count(DISTINCT l_partkey) AS y FROM lineitem GROUP BY 1),
  r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2 AS ry FROM a)
  SELECT CAST(round(corr(rx, ry) * 1000000) AS BIGINT) AS rho_millionths, count(*) AS n FROM r""")
def spearman(spark, d):
    a = read_table(spark, d, "lineitem", "l_suppkey", "l_partkey").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("x"), F.countDistinct("l_partkey").alias("y"))
    r = average_rank(average_rank(a, "x", "rx"), "y", "ry")
    return r.agg(F.round(F.corr("rx", "ry") * 1000000).cast("bigint").alias("rho_millionths"), F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey, o_orderdate AS last_order, l_last AS prior_order FROM (SELECT o_custkey AS c_custkey, o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS l_last FROM orders) WHERE l_last IS NOT NULL AND o_orderdate - l_last < INTERVAL 30 DAY""")
def snapshot_reuse(spark, d):
    """Gap test: rows whose previous row of the same key is younger than 30 days."""
    o = read_table(spark, d, "orders", "o_custkey", "o_orderdate", "o_orderkey")
    prior = F.lag("o_orderdate").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    t = o.withColumn("prior_order", prior).filter("prior_order IS NOT NULL")
    return t.filter(F.expr("o_orderdate < prior_order + INTERVAL 30 DAYS")).select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("last_order"), "prior_order")


@query("""SELECT claim_id, subject.canonical_id AS subject_key, coalesce(object.canonical_id, object.entity_type || ':' || object.source_ref, value) AS object_key, coalesce(qualifiers['role'], '') AS role FROM (SELECT DISTINCT claim_id, subject, object, value, qualifiers FROM claims)""")
def claim_projection(spark, d):
    c = read_table(spark, d, "claims", "claim_id", "subject", "object", "value", "qualifiers")
    obj = F.coalesce("object.canonical_id", F.concat("object.entity_type", F.lit(":"), "object.source_ref"), "value")
    out = c.select("claim_id", F.col("subject.canonical_id").alias("subject_key"), obj.alias("object_key"), F.coalesce(F.try_element_at("qualifiers", F.lit("role")), F.lit("")).alias("role"))
    return out.distinct()


@query("""SELECT r.relation_id, c AS claim_id, k.predicate, k.document_id, coalesce(dd.url, '') AS url FROM (SELECT DISTINCT relation_id, unnest(claim_ids) AS c FROM relations) r
  JOIN (SELECT claim_id, min(predicate) AS predicate, min(document_id) AS document_id FROM claims GROUP BY 1) k ON k.claim_id = c LEFT JOIN (SELECT document_id, min(url) AS url FROM documents GROUP BY 1) dd ON dd.document_id = k.document_id""")
def relation_evidence(spark, d):
    r = read_table(spark, d, "relations", "relation_id", "claim_ids").select("relation_id", F.explode("claim_ids").alias("claim_id")).distinct()
    k = read_table(spark, d, "claims", "claim_id", "predicate", "document_id").groupBy("claim_id").agg(F.min("predicate").alias("predicate"), F.min("document_id").alias("document_id"))
    docs = read_table(spark, d, "documents", "document_id", "url").groupBy("document_id").agg(F.min("url").alias("url"))
    return salted_join(r.join(k, "claim_id"), docs, "document_id").select("relation_id", "claim_id", "predicate", "document_id", F.coalesce("url", F.lit("")).alias("url"))


@query("SELECT claim_id, predicate FROM (SELECT DISTINCT claim_id, predicate, review_status FROM claims) WHERE coalesce(review_status, 'UNREVIEWED') <> 'REJECTED'")
def review_filter(spark, d):
    c = read_table(spark, d, "claims", "claim_id", "predicate", "review_status").distinct()
    return c.filter(F.coalesce("review_status", F.lit("UNREVIEWED")) != "REJECTED").select("claim_id", "predicate")


QUERIES, ORACLES = R.queries, R.oracles
