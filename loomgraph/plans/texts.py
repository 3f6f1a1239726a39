"""Queries over scalar functions: names, titles, URLs, dates, search, JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import dates, text, urls
from loomgraph.operators.mentions import block_join
from loomgraph.plans.registry import Registry
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query

_DEG = "(" + ",".join(f"'{x}'" for x in text.DEGREES) + ")"
_SQ = r"trim(regexp_replace({0}, '[\s' || chr(160) || ']+', ' ', 'g'))"
_WORDS = f"list_filter(string_split({_SQ.format('replace(canonical_name, chr(44), chr(32))')}, ' '), lambda w: w <> '')"
_CLEAN = f"array_to_string([w for w in string_split({_SQ.format('replace(canonical_name, chr(44), chr(32))')}, ' ') if lower(w) NOT IN {_DEG} AND w <> ''], ' ')"
_KEY = "trim(regexp_replace(regexp_replace(lower(strip_accents(" + _CLEAN + r")), '[^a-z\s]', ' ', 'g'), '\s+', ' ', 'g'))"
_NAMES = "(SELECT DISTINCT canonical_id, canonical_name FROM person WHERE canonical_name IS NOT NULL)"
_TITLES = "(SELECT DISTINCT canonical_id, title FROM project WHERE title IS NOT NULL)"


def _names(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "person", "canonical_id", "canonical_name").filter("canonical_name IS NOT NULL").distinct()


def _titles(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "project", "canonical_id", "title").filter("title IS NOT NULL").distinct()


@query(f"SELECT canonical_id, {_CLEAN} AS clean_name, array_to_string([w for w in string_split({_SQ.format('replace(canonical_name, chr(44), chr(32))')}, ' ') if lower(w) IN {_DEG}], ' ') AS degrees FROM {_NAMES}")
def clean_display_name(spark, d):
    c = F.col("canonical_name")
    return _names(spark, d).select("canonical_id", F.array_join(text.name_words(c), " ").alias("clean_name"), F.array_join(text.name_titles(c), " ").alias("degrees"))


@query(f"SELECT canonical_id, {_KEY} AS name_key, array_to_string(list_sort(string_split({_KEY}, ' ')), ' ') AS order_free_key FROM {_NAMES}")
def name_keys(spark, d):
    c = F.col("canonical_name")
    return _names(spark, d).select("canonical_id", text.name_key(c).alias("name_key"), text.order_free_key(c).alias("order_free_key"))


@query(f"SELECT canonical_id, trim(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM {_TITLES}")
def slugify(spark, d):
    return _titles(spark, d).select("canonical_id", text.slug(F.col("title")).alias("slug"))


@query(r"""SELECT claim_id, CASE WHEN length(s) > 80 THEN substr(s, 1, 79) || '…' ELSE s END AS snippet FROM
  (SELECT DISTINCT claim_id, trim(regexp_replace(snippet, '\s+', ' ', 'g')) AS s FROM claims WHERE snippet IS NOT NULL)""")
def snippet_trim(spark, d):
    c = read_table(spark, d, "claims", "claim_id", "snippet").filter("snippet IS NOT NULL")
    return c.select("claim_id", text.snippet(F.col("snippet"), 80).alias("snippet")).distinct()


@query(f"""WITH s AS (SELECT DISTINCT {_KEY} AS n FROM {_NAMES}),
  g AS (SELECT n, list_distinct([substr('  ' || n || ' ', CAST(i AS BIGINT), 3) for i in range(1, length(n) + 2)]) AS t FROM s),
  q AS (SELECT list_distinct([substr('  ' || 'sentugics zoltan' || ' ', CAST(i AS BIGINT), 3) for i in range(1, 18)]) AS t)
  SELECT n AS name_key, CAST(len(list_intersect(g.t, q.t)) AS BIGINT) AS shared, CAST(len(list_distinct(list_concat(g.t, q.t))) AS BIGINT) AS united FROM g, q WHERE len(list_intersect(g.t, q.t)) > 2""")
def trigram_similarity(spark, d):
    names = _names(spark, d).select(text.name_key(F.col("canonical_name")).alias("name_key")).distinct()
    t, q = text.trigrams(F.col("name_key")), text.trigrams(F.lit("sentugics zoltan"))
    shared, united = F.size(F.array_intersect(t, q)).cast("bigint"), F.size(F.array_union(t, q)).cast("bigint")
    return names.select("name_key", shared.alias("shared"), united.alias("united")).filter("shared > 2")


@query(f"""WITH k AS (SELECT canonical_id, trim(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', ' ', 'g')) AS k FROM {_TITLES}),
  s AS (SELECT canonical_id, k, list_max([CASE WHEN w = 'helyi' THEN 1.0 WHEN starts_with(w, 'helyi') THEN 0.85 ELSE 0.0 END for w in string_split(k, ' ')]) AS a,
     list_max([CASE WHEN w = 'kozoss' THEN 1.0 WHEN starts_with(w, 'kozoss') THEN 0.85 ELSE 0.0 END for w in string_split(k, ' ')]) AS b FROM k)
  SELECT canonical_id, CAST(round(100 * (a + b) / 2 * CASE WHEN contains(k, 'helyi kozoss') THEN 1.0 ELSE 0.9 END * 1000) AS BIGINT) AS score FROM s WHERE a > 0 AND b > 0""")
def search_score(spark, d):
    """Exact and prefix hits; the fuzzy part of the score is covered by tests."""
    t = _titles(spark, d)
    words = F.split(text.title_fold(F.col("title")), " ")
    hit = lambda q: F.array_max(F.transform(words, lambda w: F.when(w == q, 1.0).when(F.startswith(w, F.lit(q)), 0.85).otherwise(0.0)))
    whole = F.when(F.instr(text.title_fold(F.col("title")), "helyi kozoss") > 0, 1.0).otherwise(0.9)
    s = t.select("canonical_id", hit("helyi").alias("a"), hit("kozoss").alias("b"), whole.alias("w")).filter("a > 0 AND b > 0")
    return s.select("canonical_id", F.round(100 * (F.col("a") + F.col("b")) / 2 * F.col("w") * 1000).cast("bigint").alias("score"))


_HOST = r"nullif(lower(regexp_extract({0}, '^[a-zA-Z]+://([^/?#:]+)', 1)), '')"
_PATH = r"regexp_replace(regexp_extract(regexp_replace(trim(u), '#.*$', ''), '^[a-zA-Z]+://[^/?]+([^?]*)', 1), '/{2,}', '/', 'g')"
_URL = f"""'https://' || {_HOST.format('u')} || CASE WHEN length({_PATH}) <= 1 THEN '/' ELSE regexp_replace({_PATH}, '/+$', '') END || CASE WHEN q = '' THEN '' ELSE '?' || q END"""


@query(rf"""SELECT doc_id, {_URL} AS canonical, {_HOST.format('u')} AS host FROM (SELECT doc_id, u, array_to_string(list_sort([p for p in string_split(regexp_extract(u, '\?([^#]*)', 1), '&')
  if regexp_matches(p, '=.') AND string_split(p, '=')[1] NOT IN ('utm_source','utm_medium','utm_campaign','fbclid','gclid')]), '&') AS q FROM (SELECT doc_id, final_url AS u FROM documents WHERE final_url IS NOT NULL))""")
def canonical_url(spark, d):
    u = read_table(spark, d, "documents", "doc_id", "final_url").filter("final_url IS NOT NULL")
    return u.select("doc_id", urls.canonical_url(F.col("final_url")).alias("canonical"), urls.host(F.col("final_url")).alias("host"))


@query("""SELECT doc_id, CASE WHEN url NOT LIKE 'http%' OR url IS NULL THEN 'not_http' WHEN url <> final_url THEN 'redirected' WHEN http_status IS NULL THEN 'unfetched'
  WHEN http_status >= 400 THEN 'failed' WHEN text IS NULL OR trim(text) = '' THEN 'empty' ELSE 'fetched' END AS decision FROM documents""")
def fetch_decision(spark, d):
    t = read_table(spark, d, "documents", "doc_id", "url", "final_url", "http_status", "text")
    ladder = (
        F.when(F.col("url").isNull() | ~F.col("url").startswith("http"), "not_http").when(F.col("url") != F.col("final_url"), "redirected")
        .when(F.col("http_status").isNull(), "unfetched").when(F.col("http_status") >= 400, "failed").when(F.col("text").isNull() | (F.trim("text") == ""), "empty").otherwise("fetched")
    )
    return t.select("doc_id", ladder.alias("decision"))


@query(r"""SELECT claim_id, value, regexp_matches(value, '^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$') AS ok, CASE WHEN regexp_matches(value, '^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$') THEN CAST(substr(value, 1, 4) AS INTEGER) END AS y
  FROM (SELECT DISTINCT claim_id, value FROM claims WHERE predicate = 'start' AND value IS NOT NULL)""")
def partial_dates(spark, d):
    c = read_table(spark, d, "claims", "claim_id", "predicate", "value").filter("predicate = 'start' AND value IS NOT NULL").select("claim_id", "value").distinct()
    return c.select("claim_id", "value", dates.is_partial_date(F.col("value")).alias("ok"), dates.year(F.col("value")).alias("y"))


@query("""WITH p AS (SELECT DISTINCT canonical_id, title, "start" AS s, "end" AS e FROM project WHERE title IS NOT NULL)
  SELECT a.canonical_id AS id_a, b.canonical_id AS id_b, coalesce(CAST(substr(a.e,1,4) AS INT) < CAST(substr(b.s,1,4) AS INT), false) OR coalesce(CAST(substr(b.e,1,4) AS INT) < CAST(substr(a.s,1,4) AS INT), false) AS conflict
  FROM p a JOIN p b ON a.title = b.title AND a.canonical_id < b.canonical_id""")
def period_conflict(spark, d):
    p = read_table(spark, d, "project", "canonical_id", "title", "start", "end").filter("title IS NOT NULL").distinct()
    of = lambda s: p.select("title", F.col("canonical_id").alias(f"id_{s}"), F.col("start").alias(f"start_{s}"), F.col("end").alias(f"end_{s}"))
    pairs = block_join(of("a"), of("b"), ["title"]).filter("id_a < id_b")
    c = dates.periods_conflict(F.col("start_a"), F.col("end_a"), F.col("start_b"), F.col("end_b"))
    return pairs.select("id_a", "id_b", c.alias("conflict"))


@query("SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, min(event_id) AS first_event FROM events GROUP BY 1")
def json_props(spark, d):
    e = read_table(spark, d, "events", "event_id", "props")
    return e.groupBy(F.get_json_object("props", "$.k").cast("bigint").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


@query(r"""WITH t(term, pattern, ord) AS (VALUES ('housing','lakhat|berl',1), ('ageing','idos|elorege',2), ('memory','emlekez',3), ('networks','halozat',4), ('town','varos',5))
  SELECT canonical_id, arg_min(term, ord) AS term FROM (SELECT DISTINCT canonical_id, lower(strip_accents(title)) AS f FROM project WHERE title IS NOT NULL), t WHERE regexp_matches(f, pattern) GROUP BY canonical_id""")
def taxonomy_match(spark, d):
    """First matching pattern of an ordered taxonomy of five terms (broadcast by construction)."""
    terms = spark.createDataFrame([("housing", "lakhat|berl", 1), ("ageing", "idos|elorege", 2), ("memory", "emlekez", 3), ("networks", "halozat", 4), ("town", "varos", 5)], "term string, pattern string, ord int")
    t = _titles(spark, d).select("canonical_id", F.lower(text.strip_accents(F.col("title"))).alias("f"))
    hit = t.join(F.broadcast(terms), F.expr("f rlike pattern"))
    return hit.groupBy("canonical_id").agg(F.min_by("term", "ord").alias("term"))


@query(rf"""WITH k AS (SELECT DISTINCT trim(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', ' ', 'g')) AS k FROM project WHERE title IS NOT NULL)
  SELECT a.k AS short_key, b.k AS long_key FROM k a JOIN k b ON length(a.k) >= 20 AND starts_with(b.k, a.k || ' ')""")
def prefix_join(spark, d):
    """Titles that go on where another ends: an equi-join on the first 20 characters, then the exact test."""
    k = _titles(spark, d).select(text.title_fold(F.col("title")).alias("k")).distinct().filter(F.length("k") >= 20).withColumn("b", F.substring("k", 1, 20))
    pairs = block_join(k.withColumnRenamed("k", "short_key"), k.withColumnRenamed("k", "long_key"), ["b"])
    return pairs.filter(F.startswith("long_key", F.concat("short_key", F.lit(" ")))).select("short_key", "long_key")


@query("""SELECT canonical_id, CASE WHEN orcid IS NOT NULL THEN 'orcid:' || orcid WHEN mtmt_id IS NOT NULL THEN 'mtmt:' || mtmt_id ELSE 'none' END AS hard_id, count(*) AS n FROM person GROUP BY ALL""")
def hard_ids(spark, d):
    p = read_table(spark, d, "person", "canonical_id", "orcid", "mtmt_id")
    key = F.when(F.col("orcid").isNotNull(), F.concat(F.lit("orcid:"), "orcid")).when(F.col("mtmt_id").isNotNull(), F.concat(F.lit("mtmt:"), "mtmt_id")).otherwise("none")
    return p.groupBy("canonical_id", key.alias("hard_id")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT DISTINCT 'rel_' || substr(sha256('["' || type || '", "' || source_id || '", "' || target_id || '"]'), 1, 16) AS key, type, source_id, target_id FROM relations WHERE source_id IS NOT NULL AND target_id IS NOT NULL""")
def deterministic_keys(spark, d):
    r = read_table(spark, d, "relations", "type", "source_id", "target_id").dropna().distinct()
    body = F.concat(F.lit('["'), "type", F.lit('", "'), "source_id", F.lit('", "'), "target_id", F.lit('"]'))
    return r.select(F.concat(F.lit("rel_"), F.substring(F.sha2(body, 256), 1, 16)).alias("key"), "type", "source_id", "target_id")


QUERIES, ORACLES = R.queries, R.oracles
