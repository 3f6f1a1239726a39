"""Rules of resolution on small cases: pairs, mentions, projects, ids, canonical build."""

from datetime import datetime

from pyspark.sql import functions as F

from loomgraph.functions import dates, text
from loomgraph.operators import canonical, discovery, mentions, resolution
from loomgraph.operators import graph

REC = "ref string, keys array<string>, free_keys array<string>, hard_ids array<string>, family string, slug string"


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v"))).first()[0]


def test_pair_verdicts(spark):
    r = lambda ref, name, ids=(), family="s", slug=None: (ref, [name], [" ".join(sorted(name.split()))], list(ids), family, slug)
    rows = [
        r("a", "kovacs anna", ["orcid:1", "mtmt:1"]), r("b", "anna kovacs", ["orcid:1"], "t"), r("c", "kovacs anna", ["orcid:2", "mtmt:1"]),
        r("d", "kovacs anna"), r("e", "szabo bela", ["orcid:1"]), r("f", "kovacs anna", slug="x"), r("g", "kovacs anna", slug="x"), ("h", [], [], [], None, None),
    ]
    v = {(x.a, x.b): (x.status, x.method, x.score) for x in resolution.pair_verdicts(spark.createDataFrame(rows, REC)).collect()}
    assert v["a", "b"] == ("CONFIRMED", "auto:hard_id+name", 1.0)  # turned name
    assert v["a", "c"] == ("REJECTED", "auto:conflicting_hard_id", 0.0)  # one kind agrees, the other conflicts
    assert v["a", "e"] == ("POSSIBLE", "auto:hard_id_name_mismatch", 0.6)
    assert v["a", "d"] == ("POSSIBLE", "auto:same_name", 0.55) and v["b", "d"][2] == 0.4 and v["f", "g"][2] == 0.7
    assert not any("h" in k for k in v)


def test_candidates_of_a_hot_block(spark, monkeypatch):
    monkeypatch.setattr(resolution, "BLOCK_ROWS", 10)
    rows = [(f"r{i:03d}", ["nagy anna"], ["anna nagy"], [], "s", None) for i in range(60)]
    assert resolution.candidate_pairs(spark.createDataFrame(rows, REC)).count() == 60 * 59 // 2


def test_names_and_titles(spark):
    fits = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select(text.initials_compatible(F.col("a"), F.col("b"))).first()[0]
    assert fits("papp z attila", "papp attila") and fits("papp attila", "papp a") and fits("papp a", "papp attila zoltan")
    assert not fits("papp attila", "papp attila") and not fits("papp bela", "papp attila") and not fits("nagy a", "papp attila") and not fits("papp", "papp attila")
    assert not fits("papp b a", "papp attila bela")  # order matters
    key = lambda t: one(spark, t, text.title_key)
    assert key("2019-2023 – Lakhatási szegénység (NKFI K 143593)") == "lakhatasi szegenyseg"
    assert key("OTKA K 143593 - Idősgondozás, résztvevő kutató") == "idosgondozas"
    assert key("Éghajlat és egészség 2021 | TK") == "eghajlat es egeszseg" and key("(2020)") == "2020"
    assert one(spark, "OTKA K 143593 és 108836 jelű; 123456", text.grant_keys) == ["grant:143593", "grant:108836"]
    assert one(spark, "új folyóirat és adatbázis", text.activity_cues) == ["database", "journal"]
    period = lambda t: tuple(one(spark, t, dates.parse_period))
    assert period("2010. 01. 05. – 2012. 3.") == ("2010-01-05", "2012-03") and period("2014 – ") == ("2014", None)
    assert period("2010. szeptember – 2012. május 4.") == ("2010-09", "2012-05-04") and period("tavaly") == (None, None)
    assert one(spark, "Dr. Kovács A.B.", text.exact_form) == "kovács a. b."


MEN = "mention string, name string, url string, site string"
CAND = "mention string, person_id string, name_match string, signals array<string>, negatives array<string>, rejected boolean"


def test_person_mentions(spark):
    people = spark.createDataFrame(
        [("p1", "Kovács Anna", ["Kovácsné Anna"], ["s_a|https://a.hu/kutato/kovacs-anna"], ["https://a.hu/kutato/kovacs-anna"]), ("p2", "Szabó Béla", [], ["s_b|x"], []), ("p3", "Szabó Béla", None, ["s_c|x"], None), ("p4", None, None, None, None)],
        "canonical_id string, label string, alternate_names array<string>, source_refs array<string>, profile_urls array<string>")
    names = mentions.person_names(people)
    facts = mentions.person_facts(people, names)
    m = spark.createDataFrame(
        [("m1", "KOVÁCS Anna", None, "s_a"), ("m2", "Anna Kovács", None, "s_a"), ("m3", "Szabó Béla", None, "s_b"), ("m4", "Kovács A.", None, "s_a"), ("m5", "Nagy Ödön", "https://b.hu/kutato/kovacs-anna", "s_a"), ("m6", "Senki", None, "s_a"), ("m7", "Kovács Anna", None, "s_a")], MEN)
    none = lambda ddl: spark.createDataFrame([], ddl)
    manual = spark.createDataFrame([("m7", "p1", "not_same_as"), ("m2", "p1", "same_as")], "mention string, person_id string, decision string")
    units = spark.createDataFrame([("p1", "u", ["i"])], "person_id string, unit_id string, institutes array<string>")
    s = mentions.person_signals(m, names, facts, units, spark.createDataFrame([("s_a", "i")], "site string, unit_id string"), none("person_id string, project_id string"), none("mention string, target_id string"), ["a.hu"], ["kovacs"], manual)
    got = {(r.mention, r.person_id): (r.name_match, set(r.signals), set(r.negatives)) for r in s.collect()}
    assert got["m1", "p1"][0] == "NAME_EXACT" and {"SAME_INSTITUTE", "UNIQUE_NAME_IN_FAMILY"} <= got["m1", "p1"][1] and "COMMON_SURNAME" in got["m1", "p1"][2]
    assert got["m2", "p1"][0] == "NAME_ORDER_VARIANT" and got["m4", "p1"][0] == "NAME_INITIALS_COMPATIBLE"
    assert got["m5", "p1"] == ("SLUG_ONLY", {"SAME_INSTITUTION_FAMILY", "PROFILE_SLUG_FAMILY_HOST", "SAME_INSTITUTE"}, {"LINK_NAME_MISMATCH"})
    assert "SAME_NAME_MULTIPLE_PERSONS" in got["m3", "p2"][2] and ("m6", "p1") not in got
    dec = mentions.decide(m, s, "person_id", mentions.person_viable(), mentions.person_rule(), mentions.PERSON_BLOCKING, manual, "none", "weak")
    d = {r.mention: (r.status, r.person_id, r.method, r.reason) for r in dec.collect()}
    assert d["m1"] == ("REVIEW_REQUIRED", None, None, "no rule satisfied")  # the common surname switches the institute rule off
    assert d["m2"] == ("MANUAL_CONFIRMED", "p1", "manual:same_as", None) and d["m6"] == ("UNRESOLVED", None, None, "none")
    assert d["m3"][3] == "2 viable candidates" and d["m4"][3] == "weak" and d["m5"][3] == "blocked: LINK_NAME_MISMATCH" and d["m7"] == ("UNRESOLVED", None, None, "every candidate was rejected manually")


def test_rules_in_order(spark):
    full = ["NAME_EXACT"]
    rows = [
        ("a", "p", "x", full + ["PROFILE_SLUG_INFERRED_ALIAS", "OWN_PROFILE_LISTS_PROJECT"], [], False), ("b", "p", "x", full + ["SOURCE_UNIT_MEMBER", "UNIQUE_NAME_IN_FAMILY"], [], False),
        ("c", "p", "x", full + ["SAME_INSTITUTE", "UNIQUE_NAME_IN_FAMILY"], ["COMMON_SURNAME"], False), ("d", "p", "x", ["PROFILE_SLUG_FAMILY_HOST"], [], False),
    ]
    got = {r.mention: r.r for r in spark.createDataFrame(rows, CAND).select("mention", mentions.person_rule().alias("r")).collect()}
    assert got == {"a": "slug_inferred_alias", "b": "unit_member_unique", "c": None, "d": None}


def test_project_mentions(spark):
    p = spark.createDataFrame(
        [("j1", "Lakhatási szegénység és egészség vidéken", None, "OTKA K 143593", "2015", "2018", None, ["s|x"]), ("j2", "Lakhatási szegénység és egészség vidéken és városon", [], None, "2010", "2012", "https://w.hu/a", ["t|x"]), ("j2", None, None, None, None, None, None, None)],
        "canonical_id string, title string, alternate_titles array<string>, grant_id string, start string, end string, website string, source_refs array<string>")
    facts = mentions.project_facts(p)
    m = spark.createDataFrame(
        [("m1", "Lakhatási szegénység és egészség vidéken (K 143593)", ["grant:143593"], 2016, None, None, "s", None), ("m2", "Lakhatási szegénység és egészség vidéken", [], 2020, None, None, "s", "per"), ("m3", "Lakhatási szegénység és egészség vidéken és városon", ["grant:999999"], None, None, "https://other", "t", None)],
        "mention string, title string, grants array<string>, first_year int, last_year int, url string, site string, owner string")
    owners = spark.createDataFrame([("j1", "per")], "project_id string, person_id string")
    manual = spark.createDataFrame([], "mention string, project_id string, decision string")
    m = mentions.keyed_titles(m)
    s = mentions.project_signals(m, facts, owners, manual)
    got = {(r.mention, r.project_id): (r.title_match, set(r.signals), set(r.negatives)) for r in s.collect()}
    assert got["m1", "j1"] == ("TITLE_EQUAL_AFTER_AFFIXES", {"TITLE_EQUAL_AFTER_AFFIXES", "GRANT_ID_MATCH", "SAME_SITE"}, set())
    assert got["m1", "j2"][0] == "TITLE_PREFIX" and "PERIOD_CONFLICT" in got["m1", "j2"][2]
    assert got["m2", "j1"][1] == {"TITLE_EXACT", "PAGE_LINKS_OWNER", "SAME_SITE"} and got["m2", "j1"][2] == {"PERIOD_CONFLICT"}
    assert got["m3", "j2"][2] == {"LINKS_OTHER_PAGE"} and "GRANT_ID_CONFLICT" in got["m3", "j1"][2]
    d = {r.mention: (r.status, r.project_id, r.method) for r in mentions.decide(m, s, "project_id", mentions.project_viable(), mentions.project_rule(), mentions.PROJECT_BLOCKING, manual, "none", "blocked").collect()}
    assert d == {"m1": ("HIGH_CONFIDENCE_AUTO", "j1", "grant_and_title"), "m2": ("REVIEW_REQUIRED", None, None), "m3": ("REVIEW_REQUIRED", None, None)}


def assigned_by_loop(members, known):
    """The ordered assignment as a plain loop."""
    clusters = {}
    for ref, c in members:
        clusters.setdefault(c, []).append(ref)
    taken, out = set(), {}
    for c, refs in sorted(clusters.items(), key=lambda kv: (min((known[r][1] for r in kv[1] if r in known), default=datetime(9999, 1, 1)), min(kv[1]))):
        ids = {}
        for r in refs:
            if r in known:
                ids.setdefault(known[r][0], []).append(known[r][1])
        choice = next((i for i in sorted(ids, key=lambda i: (min(ids[i]), i)) if i not in taken), None)
        taken.add(choice)
        for r in refs:
            out[r] = choice
    return out


def test_assign_ids(spark):
    import random

    rng = random.Random(6)
    members = [(f"r{i}", f"c{rng.randrange(9)}") for i in range(40)]
    known = {f"r{i}": (f"id{rng.randrange(8)}", datetime(2025, 1, 1 + rng.randrange(20))) for i in range(0, 40, 2)}
    m = spark.createDataFrame(members, "ref string, cluster string")
    k = spark.createDataFrame([(r, i, t) for r, (i, t) in known.items()], "ref string, canonical_id string, assigned_at timestamp")
    got = {r.ref: (r.canonical_id, r.previous_id, r.is_new) for r in resolution.assign_ids(m, k).collect()}
    want = assigned_by_loop(members, known)
    assert {r: (None if new else i) for r, (i, _, new) in got.items()} == want
    assert all(p is None or (p == known[r][0] and p != i) for r, (i, p, _) in got.items())
    keep, drop = resolution.anchored_only(m, spark.createDataFrame([("r0",)], "ref string"))
    assert keep.select("cluster").distinct().count() == 1 and keep.count() + drop.count() == 40


def test_canonical_build(spark):
    ref = "struct<entity_type: string, source_ref: string, canonical_id: string>"
    ddl = f"claim_id string, subject {ref}, predicate string, value string, object {ref}, qualifiers map<string,string>, valid_from string, valid_until string, temporal_basis string, observed_at timestamp, document_id string, locator string, epistemic_status string, assertion_type string, derivation_method string, confidence double"
    per, pro, unit = ("Person", "s|a", None), ("Project", None, "j1"), ("OrganisationalUnit", None, "u1")
    t = lambda k: datetime(2025, 1, k)
    claim = lambda i, s, p, v=None, o=None, **kw: (i, s, p, v, o, kw.get("q"), kw.get("f"), kw.get("u"), kw.get("b", "OBSERVED_AT"), t(kw.get("d", 1)), kw.get("doc", "d1"), kw.get("loc"), kw.get("st", "OBSERVED"), kw.get("at"), kw.get("dm"), kw.get("c", 0.5))
    rows = [
        claim("c1", per, "name", "Kovács Anna", doc="d1"), claim("c2", per, "name", "Kovacs Anna", doc="d2"), claim("c3", per, "name", "Kovács Anna", doc="d3"), claim("c4", per, "name", "K. Anna", loc="profile.h1"),
        claim("c5", pro, "title", "T"), claim("c6", pro, "start", "2020"), claim("c7", pro, "start", "2020-05", doc="d2"), claim("c8", pro, "start", "2019", c=0.9),
        claim("c9", per, "MEMBER_OF", None, unit, q={"role": "x"}, d=2, b="EXPLICIT", f="2020", u="2021"), claim("c10", per, "MEMBER_OF", None, unit, q={"role": "y"}, d=1, b="EXPLICIT", f="2019", st="DERIVED", dm="m"), claim("c10", per, "MEMBER_OF", None, unit, q={"role": "y"}, d=1, b="EXPLICIT", f="2019", st="DERIVED", dm="m"),
        claim("c11", per, "shoe_size", "44"), claim("c12", ("Person", "s|unknown", None), "name", "N"), claim("c13", pro, "PART_OF", None, pro), claim("c14", per, "MEMBER_OF", None, ("OrganisationalUnit", "s|none", None)),
    ]
    claims = canonical.latest_claims(spark.createDataFrame(rows, ddl))
    c = canonical.resolve_sides(claims, spark.createDataFrame([("s|a", "p1")], "ref string, canonical_id string"))
    fields = {(r.subject_id, r.field): (r.value, r.conflicts) for r in canonical.entity_fields(c).collect()}
    assert fields["p1", "canonical_name"] == ("K. Anna", None) and fields["p1", "alternate_names"][0] == "Kovács Anna|Kovacs Anna"  # the page's own heading wins
    assert fields["j1", "start"] == ("2020-05", "2019")  # 2020 agrees with 2020-05, two documents beat one
    rel = canonical.build_relations(c).collect()
    assert len(rel) == 1 and rel[0].roles == ["y", "x"] and rel[0].valid_from == "2019" and rel[0].valid_until is None and rel[0].epistemic_status == "OBSERVED" and rel[0].derivation_method == "m" and rel[0].claim_ids == ["c10", "c9"]
    docs = spark.createDataFrame([("d1", "https://x"), ("d2", "repo://y")], "document_id string, url string")
    ents = canonical.build_entities(c, docs)
    issues = {(r.check, r.key) for r in canonical.build_issues(c, ents, canonical.build_relations(c), spark.createDataFrame([], "id string")).collect()}
    assert {r.canonical_id for r in ents.collect()} == {"p1", "j1"}
    assert issues == {("unresolved_subject", "c12"), ("unresolved_object", "c14"), ("self_loop_after_resolution", "c13"), ("unmapped_predicate", "c11"), ("dangling_relation", rel[0].relation_id)}


def test_routing(spark):
    reg = spark.createDataFrame([("a", "a.hu", ["m.a.hu"], ["old.a.hu"], True, True, "a.hu"), ("b", "b.org", [], [], False, True, "b.org"), ("c", "c.org", [], [], True, False, None)], "source_id string, host string, verified array<string>, inferred array<string>, enabled boolean, in_run boolean, suffix string")
    links = spark.createDataFrame(
        [("https://a.hu/p/1", "https://old.a.hu/p/1", "x"), ("https://a.hu/p/2", "https://old.a.hu/p/2", "x"), ("https://a.hu/p/2", "https://m.a.hu/p/2", "y"), ("https://b.org/p/3", "https://b.org/p/3", "x"), ("https://sub.b.org/p", "https://sub.b.org/p", "x"), ("https://z.com/p", "https://z.com/p", "x"), ("https://c.org/p/1", "https://c.org/p/1", "x"), ("https://a.hu/no", "https://a.hu/no", "x"), ("ftp://a.hu/p/9", "ftp://a.hu/p/9", "x"), ("https://a.hu/p/4", "https://a.hu/p/4", "x")],
        "url string, stated string, via string")
    out = discovery.route(links, reg, spark.createDataFrame([("https://a.hu/p/4",)], "url string"), F.col("url").rlike("/p/"))
    got = {r.url: (r.decision, r.reason) for r in out.collect()}
    assert got == {
        "https://a.hu/p/1": ("skipped", "alias_unverified"), "https://a.hu/p/2": ("enqueued", None), "https://b.org/p/3": ("skipped", "source_not_enabled"), "https://sub.b.org/p": ("skipped", "site_not_registered"), "https://z.com/p": ("skipped", "external_host"),
        "https://c.org/p/1": ("skipped", "owner_not_in_run"), "https://a.hu/no": ("skipped", "not_project_path"), "ftp://a.hu/p/9": ("skipped", "not_http"), "https://a.hu/p/4": ("already_fetched", None),
    }


def test_structure(spark):
    hand = {"A": [1, 2, 3], "B": [1, 4], "C": range(1, 9), "D": [11], "E": [9, 10]}
    m = spark.createDataFrame([(p, f"p{x:02d}") for p, xs in hand.items() for x in xs], "project string, person string")
    for w, total in (("unweighted", 29), ("project_count", 33), ("size_discounted", 7.5)):
        nodes, edges = graph.projection(m, w)
        assert nodes.count() == 11 and edges.count() == 29 and abs(edges.agg(F.sum("weight")).first()[0] - total) < 1e-9
    assert graph.projection(m, "unweighted", 8)[1].count() == 5
    same = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "b")], "x int, y string")
    nmi = lambda df: graph.label_agreement(df, "x", "y").first().nmi_millionths
    assert nmi(same) == 1_000_000 and nmi(spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b")], "x int, y string")) == 0
    assert nmi(same.limit(1)) is None and nmi(same.filter("x = 1")) == 1_000_000
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "x"), ("x", "c")], "src string, dst string")
    assert {r.id: r.path for r in graph.shortest_paths(e, spark.createDataFrame([("a",)], "id string"), 8).collect()} == {"a": "a", "b": "a>b", "x": "a>x", "c": "a>b>c", "d": "a>b>c>d"}
