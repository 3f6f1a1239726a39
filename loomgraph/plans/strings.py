"""Queries over scalar functions with fixed patterns: title keys, grants, cues, scrubbing, periods, identifiers, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import dates, text, urls
from loomgraph.plans.registry import Registry
from loomgraph.plans.texts import _CLEAN, _HOST, _KEY, _NAMES, _TITLES, _names, _titles
from loomgraph.sources.tables import read_table

R = Registry()
query = R.query


def _re(rule: str) -> str:
    """A pattern as DuckDB takes it."""
    return "'" + rule.replace("(?iu)", "(?i)").replace("'", "''") + "'"


def _stripped(c: str) -> str:
    """SQL of ``text.strip_affixes``."""
    chars = "'„”\"''" + "'"
    bare = lambda x: f"trim(trim(trim({x}), {chars}))"
    out = bare(c)
    for _ in range(4):
        for rule in text.AFFIXES:
            out = bare(f"regexp_replace({out}, {_re(rule)}, '', 'g')")
    return out


_FOLD = "trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g'))"
_TKEY = f"(SELECT canonical_id, title, CASE WHEN s = '' THEN title ELSE s END AS s FROM (SELECT canonical_id, title, {_stripped('title')} AS s FROM {_TITLES}))"


@query(f"SELECT canonical_id, s AS bare_title, {_FOLD.format('s')} AS title_key FROM {_TKEY}")
def title_key(spark, d):
    """Titles without period, grant, funder, role, site and year affixes, taken off to the fixpoint (four passes)."""
    t = _titles(spark, d)
    bare = F.transform(F.array("title"), lambda t: text.strip_affixes(t))[0]  # as one generated method the patterns would not compile
    return t.select("canonical_id", bare.alias("bare_title")).withColumn("title_key", text.title_fold(F.col("bare_title")))


_GRANTS = f"list_distinct(list_concat(regexp_extract_all(t, {_re(text.GRANT)}, 1), regexp_extract_all(t, {_re(text.GRANT_BEHIND)}, 1)))"


@query(f"SELECT DISTINCT canonical_id, t AS stated, array_to_string(list_sort(['grant:' || x for x in {_GRANTS}]), ',') AS grant_keys FROM (SELECT canonical_id, concat_ws(' ; ', grant_id, title) AS t FROM project)")
def grant_keys(spark, d):
    """Grant numbers by their context: a bare run of digits is none."""
    p = read_table(spark, d, "project", "canonical_id", "grant_id", "title").select("canonical_id", F.concat_ws(" ; ", "grant_id", "title").alias("stated")).distinct()
    return p.select("canonical_id", "stated", F.array_join(F.array_sort(text.grant_keys(F.col("stated"))), ",").alias("grant_keys"))


_CUE_SQL = ", ".join(f"CASE WHEN regexp_matches(text, {_re(rule)}) THEN '{k}' END" for k, rule in sorted(text.CUES.items()))


@query(f"SELECT doc_id, concat_ws(',', {_CUE_SQL}) AS cues FROM documents WHERE text IS NOT NULL")
def activity_cues(spark, d):
    """What kind of activity a text speaks of: whole texts, eight patterns."""
    t = read_table(spark, d, "documents", "doc_id", "text").filter("text IS NOT NULL")
    return t.select("doc_id", F.array_join(text.activity_cues(F.col("text")), ",").alias("cues"))


@query(f"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, {_re(text.EMAIL)}, 'xxx@\\1', 'g'), {_re(text.PHONE)}, 'XXX', 'g'), {_re(text.LABELLED)}, '\\1XXX', 'g'), {_re(text.AREA)}, 'XXX', 'g') AS scrubbed
  FROM documents WHERE text IS NOT NULL""")
def scrub_text(spark, d):
    """E-mail names and phone numbers in four forms masked."""
    return read_table(spark, d, "documents", "doc_id", "text").filter("text IS NOT NULL").select("doc_id", text.scrub(F.col("text")).alias("scrubbed"))


_EXACT = r"lower(trim(regexp_replace(replace(" + _CLEAN + r", '.', '. '), '\s+', ' ', 'g')))"


@query(f"SELECT canonical_id, {_EXACT} AS exact_form FROM {_NAMES}")
def exact_form(spark, d):
    return _names(spark, d).select("canonical_id", text.exact_form(F.col("canonical_name")).alias("exact_form"))


@query(rf"""WITH k AS (SELECT DISTINCT {_KEY} AS k FROM {_NAMES}), w AS (SELECT k, string_split(k, ' ') AS w FROM k),
  p AS (SELECT a.k AS a, b.k AS b, a.w[2:] AS s, b.w[2:] AS l FROM w a JOIN w b ON a.w[1] = b.w[1] AND a.k <> b.k AND len(a.w) > 1 AND len(b.w) > 1 AND (len(a.w) < len(b.w) OR (len(a.w) = len(b.w) AND a.k < b.k))),
  e AS (SELECT a, b, list_reduce(list_concat([0], range(1, len(s) + 1)), lambda p, i: CASE WHEN p < 0 THEN -1 ELSE coalesce(list_min([j for j in range(p + 1, len(l) + 1)
    if l[j] = s[i] OR (length(s[i]) = 1 AND starts_with(l[j], s[i])) OR (length(l[j]) = 1 AND starts_with(s[i], l[j]))]), -1) END) AS last FROM p)
  SELECT a AS short_key, b AS long_key FROM e WHERE last > 0""")
def initials_candidates(spark, d):
    """Name keys that agree by initials: of the same surname, words of the shorter met in order in the longer.
    The surname block is only joined between names that differ; equal names are one key."""
    keys = _names(spark, d).select(text.name_key(F.col("canonical_name")).alias("k")).distinct().withColumn("surname", F.substring_index("k", " ", 1)).withColumn("n", F.size(F.split("k", " ")))
    ahead = (F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.k") < F.col("b.k")))
    # among names of one surname only those whose first given letters agree somewhere can fit
    initials = F.array_distinct(F.transform(F.slice(F.split("k", " "), 2, F.size(F.split("k", " "))), lambda w: F.substring(w, 1, 1)))
    marked = keys.filter("n > 1").withColumn("i", F.explode(initials))
    first = marked.filter(F.col("i") == F.substring(F.split("k", " ")[1], 1, 1))
    pairs = first.alias("a").join(marked.alias("b"), ["surname", "i"]).filter(ahead).filter(text.initials_compatible(F.col("a.k"), F.col("b.k")))
    return pairs.select(F.col("a.k").alias("short_key"), F.col("b.k").alias("long_key")).distinct()


def _duck_span(c: str, rule: str, k: int) -> str:
    return f"nullif(regexp_extract({c}, {_re(rule)}, {k}), '')"


def _duck_date(y: str, m: str, d: str) -> str:
    pad = lambda x: f"lpad(CAST(CAST({x} AS INT) AS VARCHAR), 2, '0')"
    return f"CASE WHEN {m} IS NULL THEN {y} WHEN {d} IS NULL THEN {y} || '-' || {pad(m)} ELSE {y} || '-' || {pad(m)} || '-' || {pad(d)} END"


_MONTH = lambda x: "CASE lower(" + x + ") " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in text.MONTHS.items()) + " END"
_N, _W = dates._SPAN, dates._NAMED_SPAN
_G = lambda rule, k: _duck_span("t", rule, k)


@query(f"""SELECT DISTINCT ref, t AS stated,
  CASE WHEN regexp_matches(t, {_re(_N)}) THEN {_duck_date(_G(_N, 1), _G(_N, 2), _G(_N, 3))} WHEN regexp_matches(t, {_re(_W)}) THEN {_duck_date(_G(_W, 1), _MONTH(_G(_W, 2)), _G(_W, 3))} END AS period_from,
  CASE WHEN regexp_matches(t, {_re(_N)}) THEN {_duck_date(_G(_N, 4), _G(_N, 5), _G(_N, 6))} WHEN regexp_matches(t, {_re(_W)}) THEN {_duck_date(_G(_W, 4), _MONTH(_G(_W, 5)), _G(_W, 6))} END AS period_until
  FROM (SELECT 'project ' || canonical_id AS ref, replace("start", '-', '. ') || ' – ' || coalesce(replace("end", '-', '. '), '') AS t FROM project WHERE "start" IS NOT NULL
  UNION ALL SELECT 'document ' || doc_id, text FROM documents WHERE text IS NOT NULL)""")
def parse_period(spark, d):
    """Stated periods in numbers or with Hungarian month names, of projects and in whole texts; nothing is guessed."""
    dotted = lambda c: F.replace(F.col(c), F.lit("-"), F.lit(". "))
    p = read_table(spark, d, "project", "canonical_id", "start", "end").filter("start IS NOT NULL").select(F.concat(F.lit("project "), "canonical_id").alias("ref"), F.concat(dotted("start"), F.lit(" – "), F.coalesce(dotted("end"), F.lit(""))).alias("stated"))
    t = read_table(spark, d, "documents", "doc_id", "text").filter("text IS NOT NULL").select(F.concat(F.lit("document "), F.col("doc_id").cast("string")).alias("ref"), F.col("text").alias("stated"))
    return p.unionByName(t).distinct().withColumn("p", dates.parse_period(F.col("stated"))).select("ref", "stated", F.col("p.from").alias("period_from"), F.col("p.until").alias("period_until"))


@query(r"""SELECT canonical_id, regexp_extract(o, '(\d{4}-\d{4}-\d{4}-\d{3}[\dX])', 1) AS orcid, nullif(regexp_extract(m, '(?:sel=(?:authors)?|/authors?/)(\d{4,})', 1), '') AS mtmt, nullif(regexp_extract(u, '/kutato/([^/?#]+)', 1), '') AS slug
  FROM (SELECT DISTINCT canonical_id, 'https://orcid.org/' || orcid AS o, 'https://m2.mtmt.hu/gui2/?type=authors&mode=browse&sel=authors' || mtmt_id AS m, profile_urls[1] AS u FROM person)
  WHERE o IS NULL OR regexp_matches(o, '\d{4}-\d{4}-\d{4}-\d{3}[\dX]')""")
def url_ids(spark, d):
    """Identifiers read back out of the addresses that carry them."""
    p = read_table(spark, d, "person", "canonical_id", "orcid", "mtmt_id", "profile_urls").select("canonical_id", F.concat(F.lit("https://orcid.org/"), "orcid").alias("o"), F.concat(F.lit("https://m2.mtmt.hu/gui2/?type=authors&mode=browse&sel=authors"), "mtmt_id").alias("m"), F.try_element_at("profile_urls", F.lit(1)).alias("u")).distinct()
    orcid = urls.orcid_id(F.col("o"))
    return p.filter(F.col("o").isNull() | orcid.isNotNull()).select("canonical_id", orcid.alias("orcid"), urls.mtmt_id(F.col("m")).alias("mtmt"), urls.slug_of(F.col("u")).alias("slug"))


@query(rf"""SELECT DISTINCT ref, split_part(split_part(ref, '|', 1), '_', 1) AS family, CASE WHEN regexp_matches(split_part(ref, '|', 2), '^https?://') THEN split_part(ref, '|', 2) END AS url,
  {_HOST.format("split_part(ref, '|', 2)")} AS host, regexp_matches(split_part(ref, '|', 2), '^https?://[^/?#\s]+\.[^/?#\s]+([/?#]\S*)?$') AS well_formed FROM (SELECT unnest(source_refs) AS ref FROM person UNION SELECT unnest(source_refs) FROM project UNION SELECT unnest(source_refs) FROM org_units) WHERE ref IS NOT NULL""")
def reference_parts(spark, d):
    """Site family, address, host and well-formedness of every record reference."""
    refs = None
    for t in ("person", "project", "org_units"):
        r = read_table(spark, d, t, "source_refs").select(F.explode("source_refs").alias("ref"))
        refs = r if refs is None else refs.unionByName(r)
    url = F.split_part("ref", F.lit("|"), F.lit(2))
    return refs.filter("ref IS NOT NULL").distinct().select("ref", urls.site_family(F.col("ref")).alias("family"), urls.ref_url(F.col("ref")).alias("url"), urls.host(url).alias("host"), urls.well_formed(url).alias("well_formed"))


@query(r"""SELECT doc_id, line_no, label, CASE WHEN length(label) <= 40 AND len(string_split(label, ' ')) <= 5 AND regexp_matches(label, '^\p{Lu}') AND NOT label LIKE '%.' THEN 'heading' WHEN length(label) <= 48 AND len(string_split(label, ' ')) <= 6 AND contains(line, ':') THEN 'label' ELSE 'text' END AS kind,
  CASE WHEN contains(line, ': ') AND length(split_part(line, ': ', 1)) <= 48 THEN trim(substr(line, strpos(line, ': ') + 2)) END AS val
  FROM (SELECT doc_id, CAST(generate_subscripts(l, 1) AS INT) AS line_no, unnest(l) AS line, trim(split_part(unnest(l), ':', 1)) AS label FROM (SELECT doc_id, string_split(replace(text, chr(13), ''), chr(10)) AS l FROM documents WHERE raw_path IS NOT NULL AND text IS NOT NULL)) WHERE trim(line) <> ''""")
def labelled_lines(spark, d):
    """Lines of pages as heading, label with value, or text, by the length and form of their head."""
    t = read_table(spark, d, "documents", "doc_id", "text", "raw_path").filter("raw_path IS NOT NULL AND text IS NOT NULL")
    lines = t.select("doc_id", F.posexplode(F.split(F.replace(F.col("text"), F.lit("\r"), F.lit("")), "\n")).alias("k", "line")).filter(F.trim("line") != "")
    head = F.trim(F.split_part("line", F.lit(":"), F.lit(1)))
    words = F.size(F.split("label", " "))
    kind = F.when((F.length("label") <= 40) & (words <= 5) & F.col("label").rlike(r"^\p{Lu}") & ~F.endswith("label", F.lit(".")), "heading").when((F.length("label") <= 48) & (words <= 6) & F.contains("line", F.lit(":")), "label").otherwise("text")
    value = F.when(F.contains("line", F.lit(": ")) & (F.length(F.split_part("line", F.lit(": "), F.lit(1))) <= 48), F.trim(F.expr("substring(line, instr(line, ': ') + 2)")))
    return lines.withColumn("label", head).select("doc_id", (F.col("k") + 1).alias("line_no"), "label", kind.alias("kind"), value.alias("val"))


@query(r"""WITH l AS (SELECT doc_id, CAST(generate_subscripts(l, 1) AS INT) AS k, unnest(l) AS line FROM (SELECT doc_id, string_split(replace(text, chr(13), ''), chr(10)) AS l FROM documents WHERE raw_path IS NOT NULL AND text IS NOT NULL)),
  w AS (SELECT doc_id, k, line, NOT bool_or(length(line) > 150) OVER (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS in_header, CASE WHEN regexp_matches(line, '^\s*(\d+(\.\d+)*\.? )?[\p{Lu}][^.!?]{2,40}$') THEN line END AS head FROM l)
  SELECT doc_id, k AS line_no, in_header, last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS section, lag(line) OVER (PARTITION BY doc_id ORDER BY k) AS line_above FROM w""")
def line_context(spark, d):
    """For each line of a page: is it still in the header block, under which heading, and below which line."""
    from pyspark.sql import Window

    t = read_table(spark, d, "documents", "doc_id", "text", "raw_path").filter("raw_path IS NOT NULL AND text IS NOT NULL")
    lines = t.select("doc_id", F.posexplode(F.split(F.replace(F.col("text"), F.lit("\r"), F.lit("")), "\n")).alias("k", "line"))
    w = Window.partitionBy("doc_id").orderBy("k")
    so_far, above = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    head = F.when(F.col("line").rlike(r"^\s*(\d+(\.\d+)*\.? )?[\p{Lu}][^.!?]{2,40}$"), F.col("line"))
    return lines.select("doc_id", (F.col("k") + 1).alias("line_no"), (~F.max(F.length("line") > 150).over(so_far)).alias("in_header"), F.last(head, ignorenulls=True).over(above).alias("section"), F.lag("line").over(w).alias("line_above"))


@query(rf"""SELECT canonical_id, array_to_string([n for n in [trim(regexp_replace(x, '[\s' || chr(160) || ']+', ' ', 'g')) for x in string_split_regex(t, '[,;]| és | and ')] if NOT regexp_matches(n, '\d') AND len(string_split(n, ' ')) >= 2 AND NOT regexp_matches(lower(n), 'intézet|institute|tanszék|kutató|egyetem')], '|') AS names
  FROM (SELECT canonical_id, string_agg(DISTINCT canonical_name, '; ' ORDER BY canonical_name) AS t FROM person WHERE canonical_name IS NOT NULL GROUP BY 1)""")
def split_names(spark, d):
    """A list of names in running text, parted; parts with digits, of one word or naming an organisation are left out."""
    t = read_table(spark, d, "person", "canonical_id", "canonical_name").filter("canonical_name IS NOT NULL").groupBy("canonical_id").agg(F.array_join(F.array_sort(F.collect_set("canonical_name")), "; ").alias("t"))
    parts = F.transform(F.split("t", "[,;]| és | and "), text.squeeze)
    kept = F.filter(parts, lambda n: ~n.rlike(r"\d") & (F.size(F.split(n, " ")) >= 2) & ~F.lower(n).rlike("intézet|institute|tanszék|kutató|egyetem"))
    return t.select("canonical_id", F.array_join(kept, "|").alias("names"))


QUERIES, ORACLES = R.queries, R.oracles
