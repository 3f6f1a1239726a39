"""Mentions of people and projects and what they may be: candidates, signals, decisions by rule tables.

A mention is a record of a name or title on someone else's page. Candidates come
from exact joins (name key, order-free key, surname with initials, profile slug;
title key, grant key, title prefix) and say nothing about identity. Signals are
columns of a (mention, candidate) pair. A mention with exactly one viable
candidate and no blocking signal is decided by the first rule that its signals
satisfy; everything else goes to review or stays unresolved. Manual decisions
come first. All rule tables are parameters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import dates, text, urls
from loomgraph.operators.skew import salted_join

#: A name or title block with more rows is split.
BLOCK_ROWS = 20_000

# Full-name signals, signals of a linked profile, blocking signals, and the rules in order:
# (rule, signals it needs besides a full name, signals that switch it off).
FULL_NAME = ["NAME_EXACT", "SAME_NORMALIZED_NAME", "ALTERNATE_NAME_MATCH"]
SLUG_SIGNALS = ["PROFILE_SLUG_INFERRED_ALIAS", "PROFILE_SLUG_FAMILY_HOST"]
PERSON_BLOCKING = ["LINKS_OTHER_PROFILE", "LINK_NAME_MISMATCH", "MULTIPLE_CANDIDATES", "SAME_NAME_MULTIPLE_PERSONS", "CONFLICTING_HARD_ID", "MANUAL_NOT_SAME_AS"]
PERSON_RULES = [
    ("slug_inferred_alias", ["PROFILE_SLUG_INFERRED_ALIAS"], []),
    ("slug_family_host", ["PROFILE_SLUG_FAMILY_HOST"], []),
    ("own_profile_project", ["OWN_PROFILE_LISTS_PROJECT"], []),
    ("unit_member_unique", ["SOURCE_UNIT_MEMBER", "UNIQUE_NAME_IN_FAMILY"], []),
    ("institute_unique_name", ["SAME_INSTITUTE", "UNIQUE_NAME_IN_FAMILY"], ["COMMON_SURNAME"]),
]
TITLE_SIGNALS = ["TITLE_EXACT", "TITLE_EQUAL_AFTER_AFFIXES", "TITLE_PREFIX"]
OWNER_SIGNALS = ["PAGE_LINKS_OWNER", "PAGE_NAMES_OWNER"]
PROJECT_BLOCKING = ["GRANT_ID_CONFLICT", "PERIOD_CONFLICT", "LINKS_OTHER_PAGE", "MULTIPLE_CANDIDATES", "MANUAL_NOT_SAME_AS"]
PROJECT_RULES = [("grant_and_title", ["GRANT_ID_MATCH"], TITLE_SIGNALS), ("grant_and_owner", ["GRANT_ID_MATCH"], OWNER_SIGNALS), ("title_and_owner", TITLE_SIGNALS, OWNER_SIGNALS)]
MIN_PREFIX = 20


def strings(*cs: Column) -> Column:
    return F.array_compact(F.array(*cs))


def among(signals: Column, wanted: list[str]) -> Column:
    """Does the list hold one of ``wanted``? False for an empty list of wanted."""
    return F.arrays_overlap(signals, F.array(*map(F.lit, wanted))) if wanted else F.lit(False)


def holds(signals: Column, wanted: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.array_contains(signals, w) for w in wanted], F.lit(True))


def person_names(people: DataFrame) -> DataFrame:
    """(person_id, key, kind, exact): the name forms a person is known by, ``label`` before ``alternate``."""
    one = F.array(F.struct(F.col("label").alias("n"), F.lit("label").alias("kind")))
    more = F.transform(F.coalesce("alternate_names", F.array().cast("array<string>")), lambda a: F.struct(a.alias("n"), F.lit("alternate").alias("kind")))
    rows = people.select(F.col("canonical_id").alias("person_id"), F.explode(F.concat(one, more)).alias("x")).filter("x.n IS NOT NULL")
    rows = rows.select("person_id", text.name_key(F.col("x.n")).alias("key"), "x.kind", text.exact_form(F.col("x.n")).alias("exact")).filter("key <> ''")
    return rows.groupBy("person_id", "key").agg(F.max("kind").alias("kind"), F.collect_set("exact").alias("exact"))


def person_facts(people: DataFrame, names: DataFrame) -> DataFrame:
    """One row for each person: names, exact forms, slugs, hosts and families."""
    keys = names.groupBy("person_id").agg(
        F.collect_set("key").alias("keys"), F.collect_set(F.when(F.col("kind") == "label", F.col("key"))).alias("label_keys"), F.array_distinct(F.flatten(F.collect_list("exact"))).alias("exact")
    )
    none = F.array().cast("array<string>")
    refs, pages = F.coalesce("source_refs", none), F.filter(F.coalesce("profile_urls", none), lambda u: urls.slug_of(u).isNotNull())
    facts = people.select(
        F.col("canonical_id").alias("person_id"), F.array_distinct(F.transform(refs, urls.site_family)).alias("families"),
        F.array_distinct(F.transform(pages, urls.slug_of)).alias("slugs"), F.array_distinct(F.transform(pages, urls.host)).alias("hosts"),
    )
    return facts.join(keys, "person_id")


def block_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join on a block key, null keys out, hot blocks split."""
    joined = F.concat_ws("\u0001", *keys) if len(keys) > 1 else F.col(keys[0])
    l, r = left.filter(F.col(keys[0]).isNotNull()).withColumn("_k", joined).drop(*keys), right.filter(F.col(keys[0]).isNotNull()).withColumn("_k", joined).drop(*keys)
    return salted_join(l, r, "_k", "inner", BLOCK_ROWS).drop("_k")


def person_candidates(mentions: DataFrame, names: DataFrame, facts: DataFrame) -> DataFrame:
    """(mention, person_id), distinct. mentions (mention, name, url, site)."""
    m = mentions.select("mention", "url", text.name_key(F.col("name")).alias("key"))
    free = lambda c: F.array_join(F.array_sort(F.split(c, " ")), " ")
    same = block_join(m.select("mention", "key"), names.select("person_id", "key"), ["key"])
    order = block_join(m.select("mention", free("key").alias("f")), names.select("person_id", free("key").alias("f")), ["f"])
    initial = lambda k: F.explode(F.array_distinct(F.transform(F.filter(F.slice(F.split(k, " "), 2, 99), lambda w: w != ""), lambda w: F.substring(w, 1, 1))))
    sided = lambda df, who, k: df.select(who, F.col("key").alias(k), F.substring_index("key", " ", 1).alias("surname"), initial("key").alias("i"))
    short = block_join(sided(m, "mention", "a"), sided(names, "person_id", "b"), ["surname", "i"]).filter(text.initials_compatible(F.col("a"), F.col("b")))
    slug = block_join(m.select("mention", urls.slug_of(F.col("url")).alias("s")), facts.select("person_id", F.explode("slugs").alias("s")), ["s"])
    return reduce(lambda a, b: a.unionByName(b), [x.select("mention", "person_id") for x in (same, order, short, slug)]).distinct()


def person_signals(
    mentions: DataFrame, names: DataFrame, facts: DataFrame, units: DataFrame, site_units: DataFrame, projects: DataFrame, context: DataFrame,
    trusted_hosts: list[str], common_surnames: list[str], manual: DataFrame,
) -> DataFrame:
    """(mention, person_id, name_match, signals, negatives, rejected) of each candidate.

    units (person_id, unit_id, institutes), site_units (site, unit_id), projects
    (person_id, project_id), context (mention, target_id), manual (mention, person_id, decision).
    """
    m = mentions.select("mention", "name", "url", "site", text.name_key(F.col("name")).alias("key"), text.exact_form(F.col("name")).alias("form"), F.substring_index("site", "_", 1).alias("family"))
    pairs = person_candidates(mentions, names, facts).join(m, "mention").join(facts, "person_id")
    homes = names.join(facts.select("person_id", F.explode("families").alias("family")), "person_id")
    alike = homes.groupBy("key", "family").agg(F.countDistinct("person_id").alias("n_same"), F.min("person_id").alias("one_same"))
    placed = units.groupBy("person_id").agg(F.array_distinct(F.flatten(F.collect_list("institutes"))).alias("institutes"), F.collect_set("unit_id").alias("units"))
    listed = context.join(projects.withColumnRenamed("project_id", "target_id"), "target_id").select("mention", "person_id", F.lit(True).alias("lists")).distinct()
    member = context.join(units.select("person_id", F.col("unit_id").alias("target_id")), "target_id").select("mention", "person_id", F.lit(True).alias("member")).distinct()
    ruled_out = manual.filter("decision = 'not_same_as'").select("mention", "person_id", F.lit(True).alias("rejected")).distinct()
    pairs = (
        pairs.join(alike, ["key", "family"], "left").join(placed, "person_id", "left").join(site_units.withColumnRenamed("unit_id", "page_unit"), "site", "left")
        .join(listed, ["mention", "person_id"], "left").join(member, ["mention", "person_id"], "left").join(ruled_out, ["mention", "person_id"], "left")
    )
    free = lambda c: F.array_join(F.array_sort(F.split(c, " ")), " ")
    key, keys = F.col("key"), F.col("keys")
    label = F.array_contains("label_keys", key)
    match = (
        F.when(F.array_contains("exact", F.col("form")), F.when(label, "NAME_EXACT").otherwise("ALTERNATE_NAME_MATCH")).when(label, "SAME_NORMALIZED_NAME").when(F.array_contains(keys, key), "ALTERNATE_NAME_MATCH")
        .when(F.exists(keys, lambda k: free(k) == free(key)), "NAME_ORDER_VARIANT").when(F.exists(keys, lambda k: text.initials_compatible(key, k)), "NAME_INITIALS_COMPATIBLE").otherwise("SLUG_ONLY")
    )
    pairs = pairs.withColumn("name_match", match)
    full = F.col("name_match").isin(*FULL_NAME)
    slug, host = urls.slug_of(F.col("url")), urls.host(F.col("url"))
    own, family = F.coalesce(F.array_contains("slugs", slug), F.lit(False)), F.array_contains("families", F.col("family"))
    known_host = F.array_contains("hosts", host)
    trusted = host.isin(*trusted_hosts) if trusted_hosts else F.lit(False)
    of_page = F.array_contains("institutes", F.col("page_unit"))
    true = lambda c: F.coalesce(c, F.lit(False))
    signals = strings(
        F.when(F.col("name_match") != "SLUG_ONLY", F.col("name_match")), F.when(family, "SAME_INSTITUTION_FAMILY"),
        F.when(true(own & known_host & ~trusted), "PROFILE_SLUG_INFERRED_ALIAS"), F.when(true(own & ~known_host), "PROFILE_SLUG_FAMILY_HOST"),
        F.when(true(F.col("lists")), "OWN_PROFILE_LISTS_PROJECT"), F.when(true(F.col("member")), "SOURCE_UNIT_MEMBER"), F.when(true(of_page), "SAME_INSTITUTE"),
        F.when(true((F.col("n_same") == 1) & (F.col("one_same") == F.col("person_id"))), "UNIQUE_NAME_IN_FAMILY"),
    )
    negatives = strings(
        F.when(own & ~full, "LINK_NAME_MISMATCH"), F.when(slug.isNotNull() & ~own & (F.size("slugs") > 0), "LINKS_OTHER_PROFILE"), F.when(true(~of_page), "DIFFERENT_INSTITUTE"),
        F.when(true(F.col("n_same") > 1) & F.array_contains(keys, key) & family, "SAME_NAME_MULTIPLE_PERSONS"),
        F.when(F.substring_index(key, " ", 1).isin(*common_surnames) if common_surnames else F.lit(False), "COMMON_SURNAME"), F.when(true(F.col("rejected")), "MANUAL_NOT_SAME_AS"),
    )
    return pairs.select("mention", "person_id", "name_match", signals.alias("signals"), negatives.alias("negatives"), true(F.col("rejected")).alias("rejected"))


def person_viable() -> Column:
    """A full name, a linked profile's slug, or a link whose name does not fit; not rejected."""
    return ~F.col("rejected") & (among(F.col("signals"), FULL_NAME + SLUG_SIGNALS) | F.array_contains("negatives", "LINK_NAME_MISMATCH"))


def project_viable() -> Column:
    """Title or grant evidence and nothing that blocks; not rejected."""
    return ~F.col("rejected") & ~among(F.col("negatives"), PROJECT_BLOCKING) & among(F.col("signals"), [*TITLE_SIGNALS, "GRANT_ID_MATCH"])


def decide(mentions: DataFrame, candidates: DataFrame, target: str, viable: Column, rule: Column, blocking: list[str], manual: DataFrame, nothing: str, weak: str) -> DataFrame:
    """(mention, status, target, method, reason): one row for each mention.

    Manual ``same_as`` first; then the rule of the only viable candidate that
    nothing blocks; otherwise review if some candidate is not rejected, else
    unresolved. Counts per mention are partial aggregates, no mention is gathered
    but for the short list of blocking signals.
    """
    c = candidates.withColumn("viable", viable)
    per = c.groupBy("mention").agg(F.count(F.lit(1)).alias("n"), F.count_if("viable").alias("n_viable"), F.count_if("rejected").alias("n_rejected"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("negatives")))).alias("all_negatives"))
    one = c.filter("viable").select("mention", target, "signals", "negatives", rule.alias("rule"))
    only = one.join(per.filter("n_viable = 1").select("mention"), "mention", "left_semi")
    confirmed = manual.filter("decision = 'same_as'").groupBy("mention").agg(F.min(target).alias("by_hand"))
    j = mentions.select("mention").join(per, "mention", "left").join(only, "mention", "left").join(confirmed, "mention", "left")
    blocked = F.filter("negatives", lambda x: x.isin(*blocking))
    auto = (F.col("n_viable") == 1) & (F.size(blocked) == 0) & F.col("rule").isNotNull()
    open_ = F.coalesce(F.col("n") > F.col("n_rejected"), F.lit(False))
    status = F.when(F.col("by_hand").isNotNull(), "MANUAL_CONFIRMED").when(auto, "HIGH_CONFIDENCE_AUTO").when(open_, "REVIEW_REQUIRED").otherwise("UNRESOLVED")
    reason = (
        F.when(F.col("by_hand").isNotNull() | auto, F.lit(None)).when(F.col("n").isNull(), nothing).when(F.col("n") == F.col("n_rejected"), "every candidate was rejected manually")
        .when(F.col("n_viable") == 0, weak).when(F.col("n_viable") > 1, F.concat(F.col("n_viable").cast("string"), F.lit(" viable candidates")))
        .when(F.size(blocked) > 0, F.concat(F.lit("blocked: "), F.array_join(F.array_sort(blocked), ", "))).otherwise("no rule satisfied")
    )
    return j.select("mention", status.alias("status"), F.coalesce("by_hand", F.when(auto, F.col(target))).alias(target), F.when(F.col("by_hand").isNotNull(), "manual:same_as").when(auto, F.col("rule")).alias("method"), reason.alias("reason"))


def person_rule() -> Column:
    """The first rule that the signals satisfy, null without a full name."""
    out = F.lit(None).cast("string")
    for name, needs, offs in reversed(PERSON_RULES):
        out = F.when(holds(F.col("signals"), needs) & ~among(F.col("negatives"), offs), name).otherwise(out)
    return F.when(among(F.col("signals"), FULL_NAME), out)


def project_rule() -> Column:
    out = F.lit(None).cast("string")
    for name, one, other in reversed(PROJECT_RULES):
        out = F.when(among(F.col("signals"), one) & among(F.col("signals"), other), name).otherwise(out)
    return out


def project_facts(projects: DataFrame) -> DataFrame:
    """(project_id, keys, folded, grants, first_year, last_year, urls, site) of each project; repeated rows united."""
    titles = F.concat(F.array("title"), F.coalesce("alternate_titles", F.array().cast("array<string>")))
    rows = projects.select(F.col("canonical_id").alias("project_id"), F.filter(titles, lambda t: t.isNotNull()).alias("t"), "grant_id", dates.year(F.col("start")).alias("y0"), dates.year(F.col("end")).alias("y1"), "website", F.try_element_at("source_refs", F.lit(1)).alias("ref"))
    flat = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    return rows.groupBy("project_id").agg(
        flat(F.filter(F.transform("t", text.title_key), lambda k: k != "")).alias("keys"), flat(F.transform("t", text.title_fold)).alias("folded"),
        flat(F.concat(F.coalesce(text.grant_keys(F.col("grant_id")), F.array().cast("array<string>")), F.flatten(F.transform("t", text.grant_keys)))).alias("grants"),
        F.min("y0").alias("first_year"), F.max("y1").alias("last_year"), F.collect_set("website").alias("urls"), F.min(F.substring_index("ref", "|", 1)).alias("site"),
    )


def prefix_of(a: Column, b: Column) -> Column:
    """One key goes on where the other ends, at a space, the shorter having MIN_PREFIX characters."""
    longer = lambda s, t: (F.length(s) >= MIN_PREFIX) & F.startswith(t, F.concat(s, F.lit(" ")))
    return longer(a, b) | longer(b, a)


def keyed_titles(mentions: DataFrame) -> DataFrame:
    """Adds k, fold and cues of ``title``. The many patterns run inside a list function:
    as one generated method they would not compile."""
    k = F.transform(F.array("title"), text.title_key)[0]
    return mentions.withColumns({"k": k, "fold": text.title_fold(F.col("title")), "cues": text.activity_cues(F.col("title"))})


def project_candidates(mentions: DataFrame, facts: DataFrame) -> DataFrame:
    """(mention, project_id): equal title key, common grant key, or one key a long prefix of the other."""
    m = mentions.select("mention", "k", "grants")
    keys = facts.select("project_id", F.explode("keys").alias("k"))
    same = block_join(m.select("mention", "k"), keys, ["k"])
    grant = block_join(m.select("mention", F.explode("grants").alias("g")), facts.select("project_id", F.explode("grants").alias("g")), ["g"])
    head = lambda df, who, c: df.filter(F.length("k") >= MIN_PREFIX).select(who, F.col("k").alias(c), F.substring("k", 1, MIN_PREFIX).alias("h"))
    near = block_join(head(m, "mention", "a"), head(keys, "project_id", "b"), ["h"]).filter(prefix_of(F.col("a"), F.col("b")))
    return reduce(lambda a, b: a.unionByName(b), [x.select("mention", "project_id") for x in (same, grant, near)]).distinct()


def project_signals(mentions: DataFrame, facts: DataFrame, owners: DataFrame, manual: DataFrame) -> DataFrame:
    """(mention, project_id, title_match, signals, negatives, rejected) of each candidate.

    mentions (``keyed_titles`` and grants, first_year, last_year, url, site, owner), owners
    (project_id, person_id): who the project's own page names.
    """
    m = mentions.select("mention", "grants", "first_year", "last_year", "url", "site", "owner", "k", "fold", "cues")
    f = facts.select("project_id", "keys", "folded", F.col("grants").alias("p_grants"), F.col("first_year").alias("p0"), F.col("last_year").alias("p1"), "urls", F.col("site").alias("p_site"))
    pairs = project_candidates(mentions, facts).join(m, "mention").join(f, "project_id")
    pairs = pairs.join(owners.select("project_id", F.col("person_id").alias("owner"), F.lit(True).alias("owned")).distinct(), ["project_id", "owner"], "left")
    pairs = pairs.join(manual.filter("decision = 'not_same_as'").select("mention", "project_id", F.lit(True).alias("ruled_out")).distinct(), ["mention", "project_id"], "left")
    k = F.col("k")
    match = F.when(F.array_contains("folded", F.col("fold")), "TITLE_EXACT").when(F.array_contains("keys", k), "TITLE_EQUAL_AFTER_AFFIXES").when(F.exists("keys", lambda x: prefix_of(k, x)), "TITLE_PREFIX")
    shared = F.arrays_overlap("grants", "p_grants")
    lo = lambda a, b: F.coalesce(F.col(a), F.col(b))
    apart = F.coalesce(F.col("last_year") < lo("p0", "p1"), F.lit(False)) | F.coalesce(F.col("p1") < lo("first_year", "last_year"), F.lit(False))
    elsewhere = F.col("url").isNotNull() & ~F.coalesce(F.array_contains("urls", F.col("url")), F.lit(False))
    true = lambda c: F.coalesce(c, F.lit(False))
    signals = strings(match, F.when(shared, "GRANT_ID_MATCH"), F.when(true(F.col("owned")), "PAGE_LINKS_OWNER"), F.when(true(F.col("site") == F.col("p_site")), "SAME_SITE"))
    negatives = strings(
        F.when(~shared & (F.size("grants") > 0) & (F.size("p_grants") > 0), "GRANT_ID_CONFLICT"), F.when(apart, "PERIOD_CONFLICT"), F.when(elsewhere, "LINKS_OTHER_PAGE"),
        F.when(F.size("cues") > 0, "ACTIVITY_CUE"), F.when(true(F.col("ruled_out")), "MANUAL_NOT_SAME_AS"),
    )
    return pairs.select("mention", "project_id", match.alias("title_match"), signals.alias("signals"), negatives.alias("negatives"), true(F.col("ruled_out")).alias("rejected"))
