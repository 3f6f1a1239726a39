"""Training-data operators on small tables with odd rows, and against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from loomgraph.llm import bpe, boilerplate, groups, linkage, mixing, names, sentences

VOCAB = bpe.default_vocabulary()


# 1 groups
def grouped(spark, rows, **kw):
    df = spark.createDataFrame(rows, "left string, right string, status string, method map<string,string>")
    return {r.record_ref: r.group_ref for r in groups.match_groups(df, **kw).collect()}


def test_groups_small(spark):
    rows = [("b", "a", " Confirmed_Match ", None), ("b", "c", "CONFIRMED_MATCH", None), ("c", "b", "rejected_match", None), ("d", "d", "confirmed_match", None), ("e", None, "confirmed_match", None), (None, None, None, None), ("f", "g", "possible_match", None), ("h", "a", None, None)]
    assert grouped(spark, rows + rows) == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e", "f": "f", "g": "g", "h": "h"}
    assert grouped(spark, []) == {}


def test_groups_chain_star_and_brute_force(spark):
    rng = random.Random(2)
    pairs = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(300)] + [("hub", f"s{i}") for i in range(200)] + [(f"r{rng.randrange(150)}", f"r{rng.randrange(150)}") for _ in range(110)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {x: find(x) for x in list(root)}
    assert grouped(spark, [(a, b, "confirmed_match", None) for a, b in pairs], rows_limit=50) == want


# 4 main body
PAGE = """PK Minta Intézet
Kutatók | Hírek | Kapcsolat
HU | EN

Ön itt áll: Kutatók › Cím
Cím
Utolsó frissítés: 2024. 01. 17
Az első bekezdés hosszabb, és több mondatból áll. Ez a második mondata.
- egy elem
Kapcsolódó tartalmak
Más Oldal
Kutatási területek
Még egy bekezdés. Két mondat.

Legfrissebb híreink
2024-03-01
Egy hír rövid mondata.
Tovább »
Megosztás
© PK Minta Intézet, 2024"""


def test_body_lines(spark):
    assert boilerplate.body_lines(PAGE, "Cím | PK Minta Intézet") == [6, 8, 9, 12, 13]
    assert boilerplate.body_lines(PAGE, None) == [6, 8, 9, 12, 13]
    assert boilerplate.body_lines(PAGE.replace("\n", "\r\n"), "Cím | PK Minta Intézet") == [6, 8, 9, 12, 13]
    assert boilerplate.body_lines(None, "x") == boilerplate.body_lines(" \n ", None) == []
    assert boilerplate.body_lines("PK Minta Intézet\nKeresés…\nA keresett oldal nem található.\nLegfrissebb híreink\nHír.", "Más") == []
    assert len(boilerplate.body_lines("Cím\n" + "Egy mondat. Még egy.\n" * 20000, "Cím")) == 20001
    assert boilerplate.body_lines("<h1>Cím</h1>\n<p>Egy <b>mondat</b>. Még egy mondat.</p>", "Cím") == [1, 2]
    df = spark.createDataFrame([(1, PAGE, "Cím", 5), (2, None, None, 5)], "doc_id bigint, text string, page_title string, line_no int")
    assert {r.line_no for r in boilerplate.main_body(df).collect()} == {6, 8, 9, 12, 13}
    assert boilerplate.main_body(df.limit(0)).count() == 0


def test_templates_are_learned(spark):
    """Furniture in words that no list holds, on pages of very different bodies."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(rng.randrange(3, 9)))
    sentence = lambda: " ".join(word() for _ in range(14)).capitalize() + "."
    rows, truth = [], set()
    for i in range(120):
        title, body = f"{word()} {word()}", [f"{sentence()} {sentence()} {sentence()}" for _ in range(rng.randrange(1, 4))]
        lines = ["Zur Blorg", "Quux", f"Plims seit {rng.randrange(99)}", "", title, *body, "", "Nochmal Blorg", word(), word(), "", f"Grumpf {i}", "Xyzzy Plugh"]
        rows.append((i, "\n".join(lines), f"{title} | Blorgheim"))
        truth |= {(i, k) for k in range(5, 6 + len(body))}
    df = spark.createDataFrame(rows, "doc_id bigint, text string, page_title string")
    got = {(r.doc_id, r.line_no) for r in boilerplate.main_body(df).collect()}
    assert truth <= got and len(got) <= 1.02 * len(truth)


# 5 names
def clustered(spark, people, labels=()):
    person = spark.createDataFrame([(f"p{i}", n, 1) for i, n in enumerate(people)], "canonical_id string, canonical_name string, name int")
    matches = spark.createDataFrame([(a, b) for a, b in labels], "left_label string, right_label string")
    return {(r.name_a, r.name_b) for r in names.variant_pairs(names.variant_clusters(person, matches)).collect()}


def test_name_variants(spark):
    got = clustered(spark, ["Kodvavás Sarolta", "KODVAVÁS Sarolta", "Kodvasvás, Sarolta", "S. Kodvavas", "Kodvavás Dániel", None, " ", "Drantémó Kisebbségkutató Kutatócsoport", "Drantémó Kisebbségkutató Kcs."] + ["Bebödur Noémi"] * 3, [("Bebödur Nóra", None), ("Bebödur Noémi", "Kodvavás Sarolta")])
    family = sorted(["Kodvavás Sarolta", "KODVAVÁS Sarolta", "Kodvasvás, Sarolta", "S. Kodvavas"])
    assert got == {(a, b) for a in family for b in family if a < b} | {("Drantémó Kisebbségkutató Kcs.", "Drantémó Kisebbségkutató Kutatócsoport")}
    assert clustered(spark, []) == set()


def test_name_similarity_and_curve():
    none: dict[str, int] = {}
    sim = lambda a, b, k=none: names.monge_elkan(" ".join(names.fold(a)), " ".join(names.fold(b)), k, k)
    assert sim("Dri1mogossy Julianna", "Drilmogossy Juli") > 0.9
    assert sim("Gezsucófi Mária", "Gezsucófi Márta", {"maria": 9, "marta": 8}) == 0.0
    assert sim("Drantémó Kisebbségkutató Kcs.", "Drantémó Kisebbségkutató Kutatócsoport", {"kutatocsoport": 80, "kcs.": 20}) > 0.9
    assert sim("Drantémó Kisebbségkutató Osztálya", "Drantémó Kisebbségkutató Osztály", {"osztaly": 80, "osztalya": 20}) > 0.9
    assert sim("Nagykovács Zotlan", "Nagykovács Zoltan", {"zotlan": 3, "zoltan": 90}) > 0.9
    assert sim("B. Rirsehur", "Bebehas R.") == 0.0
    b = names.bands_for(0.5, 0.99, 4)
    assert 1 - (1 - 0.5**4) ** b >= 0.99 > 1 - (1 - 0.5**4) ** (b - 1)


def test_possible_holds_for_every_verified_pair(spark):
    pairs = [(f"kodvavas {s}", f"kodvavas {n}") for s, n in sorted(names.SHORT)]
    pairs += [("badcefgh tibor", "abdcfegh tibor"), ("rnakarn tibor", "makam tibor"), ("kopasy kut.", "kopasy kutatocsoport"), ("abcdefg. tibor", "bacdegfhi tibor"), ("k tibor", "kopasy tibor")]
    rng = random.Random(8)
    for _ in range(300):  # swaps and changes of letters, at the front too
        w = [rng.choice("abcdefrnm") for _ in range(rng.randrange(6, 10))]
        v = list(w)
        for i in rng.sample(range(len(v) - 1), 2):
            v[i], v[i + 1] = (v[i + 1], v[i]) if rng.random() < 0.7 else (rng.choice("xyz"), v[i + 1])
        pairs.append((f"{''.join(w)} tibor", f"{''.join(v)} tibor"))
    pairs = [tuple(" ".join(sorted(k.split(" "))) for k in p) for p in pairs]
    met = {(r.a, r.b) for r in spark.createDataFrame(pairs, "a string, b string").filter(names.possible(names.bare_words(F.col("a")), names.bare_words(F.col("b")))).collect()}
    sure = {p for p in pairs if names.monge_elkan(*p, {}, {}) >= names.ACCEPT}
    assert len(sure) > 300 and sure <= met
    assert clustered(spark, ["Sirbürófi Pista", "Sirbürófi István"]) == {("Sirbürófi István", "Sirbürófi Pista")}


def test_name_search_against_brute_force(spark):
    """The whole path, buckets split or not: of the pairs that Monge-Elkan accepts among all, at the similarity the bands are tuned for."""
    rng = random.Random(4)
    base = ["".join(rng.choice(["ba", "ke", "zo", "mi", "tu", "ra", "ne"]) for _ in range(5)) + " " + rng.choice(["anna", "tibor", "sandor"]) for _ in range(150)]
    keys = sorted({*base, *(b[:3] + "x" + b[3:] for b in base), *(b[:2] + b[3] + b[2] + b[4:] for b in base)})
    table = spark.createDataFrame([(k, i, 1) for i, k in enumerate(keys)], "key string, k bigint, weight bigint")
    known = {r.key: dict(zip(r.known, r.counts)) for r in names.attested(table).collect()}
    grams = {k: names.qgrams(k) for k in keys}
    near = {
        (a, b) for a in keys for b in keys
        if a < b and len(grams[a] & grams[b]) >= 0.5 * len(grams[a] | grams[b]) and names.monge_elkan(a, b, known[a], known[b]) >= names.ACCEPT
    }
    found = {tuple(sorted((r.a, r.b))) for r in names.verified(table, names.bands_for()).collect()}
    assert len(near) > 100 and len(found & near) >= 0.99 * len(near)
    rows = names.band_rows(table, names.bands_for())
    assert names.collisions(rows, 5).count() == names.collisions(rows).count()


def mixed_names(n, seed):
    """Names of two to five words with the ways in which words may be alike: errors, initials, words cut short or left out, everyday forms."""
    rng = random.Random(seed)
    last = ["".join(rng.choice(["ba", "ker", "zo", "mi", "tur", "ra", "nem"]) for _ in range(rng.randrange(2, 5))) for _ in range(n // 6)]
    given, kinds = ["anna", "tibor", "sandor", "istvan", "katalin", "bea"], ["intezet", "kutatocsoport", "osztaly", "muhely"]
    keys = set()
    for _ in range(n):
        words = [rng.choice(last), rng.choice(given)] if rng.random() < 0.7 else [*rng.sample(last, rng.randrange(1, 4)), *rng.sample(kinds, rng.randrange(1, 3))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            i = rng.randrange(len(words))
            w, j = words[i], rng.randrange(len(words[i]))
            words[i] = rng.choice([w[:j] + w[j + 1 :], w[:j] + "x" + w[j:], w[:j] + w[j : j + 2][::-1] + w[j + 2 :], w[0], w[:3] + ".", w[0] + w[2:4] + ".", w[:4], w.replace("m", "rn"), w + "ja", "kati", "pista", words[0]]) or w
        if len(words) > 2 and rng.random() < 0.2:
            words.pop(rng.randrange(len(words)))
        keys.add(" ".join(sorted(words)))
    return sorted(keys)


def test_name_search_finds_all_that_verification_accepts(spark, monkeypatch):
    """Against all pairs: whatever words differ and wherever hubs begin, with a band in common or not."""
    long = [f"w{chr(97 + i)}lorum{chr(110 + i)}is" for i in range(9)]
    keys = sorted({*mixed_names(900, 3), *(" ".join(sorted(x)) for x in (long, long[1:], [*long[:8], "w"], ["xwalorumnis", *long[1:]], [long[0][:5] + ".", *long[1:]]))})
    table = spark.createDataFrame([(k, i, 1) for i, k in enumerate(keys)], "key string, k bigint, weight bigint")
    known = {r.key: dict(zip(r.known, r.counts)) for r in names.attested(table).collect()}
    sure = {(i, j): sim for j, b in enumerate(keys) for i, a in enumerate(keys[:j]) if (sim := names.monge_elkan(a, b, known[a], known[b])) >= names.ACCEPT}
    words = [(len(keys[i].split()), len(keys[j].split())) for i, j in sure]
    assert len(sure) > 300 and {x - y for x, y in words} == {-1, 0, 1} and max(map(max, words)) > names.MEET
    for hub in (names.HUB, 3):
        monkeypatch.setattr(names, "HUB", hub)
        met = {(r.l, r.r) for r in names.collisions(names.meeting_rows(names.described(table))).collect()}
        assert sure.keys() <= met and len(met) < 5 * len(sure)
    marks = [names.signer(names.bands_for())(k) for k in keys]
    want = {frozenset((keys[i], keys[j])): sim for (i, j), sim in sure.items() if (marks[i] == marks[j]).any()}
    assert {frozenset((r.a, r.b)): r.sim for r in names.verified(table, names.bands_for()).collect()} == want


def test_name_search_holds_few_rows_a_name(spark, monkeypatch):
    """Nearly all pairs of names with the same given name share a band; the search holds none of those."""
    rng = random.Random(6)
    last = sorted({"".join(rng.choice(["ba", "ke", "zo", "mi", "tu", "ra", "ne"]) for _ in range(3)) for _ in range(400)})
    keys = [" ".join(sorted((s, g))) for s in last for g in ("szilveszter", "krisztina", "bernadett", "alexandra")]
    table = spark.createDataFrame([(k, i, 1) for i, k in enumerate(keys)], "key string, k bigint, weight bigint")
    held, search = [], names.collisions

    def counted(rows, *limit):
        pairs = search(rows, *limit)
        held.append(rows.count() + pairs.count())
        return pairs

    monkeypatch.setattr(names, "collisions", counted)
    names.verified(table, names.bands_for()).collect()
    assert held and sum(held) < 10 * len(keys)
    assert search(names.band_rows(table, names.bands_for())).count() > 20 * len(keys)


# 6 projects
def test_projects(spark):
    rows = [
        ("a", "Baráti hálózatok és fiatalok – Kodvuvölgy és környéke", [], "2010", "K-100100"),
        ("b", "BARATI HALOZATOK ES FIATALOK – KODVUVOLGY ES KORNYEKE (kutatás)", None, "2010-05", "OKA K100100"),
        ("c", "Baráti hálózatokk és fiatalok – Kodvuvölgy és környéke", [], "2011", None),
        ("d", "Családi gondoskodás és fiatalok – Kodvuvölgy és környéke", [], "2010", "100100"),  # a sub-project
        ("e", "Baráti hálózatok és fiatalok – Kodvuvölgy és környéke II.", [], "2014", "K 100107"),  # a later wave
        ("f", None, None, None, None),
        (None, "Baráti hálózatok és fiatalok – Kodvuvölgy és környéke", [], "2010", "K-100100"),
    ]
    df = spark.createDataFrame(rows + rows[:2], "canonical_id string, title string, alternate_titles array<string>, start string, grant_id string").withColumn("key", F.lit(1))
    out = linkage.match_projects(df).collect()
    assert {(r.id_a, r.id_b) for r in out} == {("a", "b"), ("a", "c"), ("b", "c")}
    assert all(0 < r.confidence < 1 for r in out)


def test_projects_of_common_words(spark):
    """A title of a common subject meets the one title that adds a place, and none where several places are added."""
    subject = lambda k: f"Választói magatartás és munkanélküliek{k}"
    row = lambda i, t, g=None, s="2012": (i, t, None, s, g)
    rows = [row("a1", subject("")), row("a2", subject(" – Drulmukút és környéke")), row("b1", subject(""), s="2001"), row("b2", subject(" – Egyfalva"), s="2001"), row("b3", subject(" – Kétfalva"), s="2001")]
    rows += [row("c1", "Lakhatási szegénység Drulmukút térségében", s="1999"), row("c2", "Lakhatási szegénység Drulmkút térségében", s="1999")]
    df = spark.createDataFrame(rows, "canonical_id string, title string, alternate_titles array<string>, start string, grant_id string")
    got = {(r.id_a, r.id_b) for r in linkage.match_projects(df).collect()}
    assert got == {("a1", "a2"), ("c1", "c2")}


def test_comparison_goes_both_ways(spark):
    few, more = [["child", "poverty"]], [["alsofalva", "child", "poverty"]]
    df = spark.createDataFrame([(few, more), (more, few)], "a array<array<string>>, b array<array<string>>")
    assert [r.v for r in df.select(linkage._alike(F.col("a"), F.col("b")).alias("v")).collect()] == [True, True]


def test_key_search_against_all_pairs(spark):
    """Candidates of the grantless rules hold every pair that comparison word by word accepts within one year, for titles with one typing error or one word less."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuvz") for _ in range(rng.randrange(6, 10)))
    common = [word() for _ in range(6)]
    forms = []
    for _ in range(60):
        w = rng.sample(common, 3) + [word()]
        forms.append(w)
        k = rng.randrange(4)
        forms.append(w[:k] + [w[k][:2] + w[k][3:]] + w[k + 1 :] if rng.random() < 0.6 else w[: k % 3] + w[k % 3 + 1 :])
    rows = [(f"r{i:03d}", " ".join(f), None, "2010", None) for i, f in enumerate(forms)]
    df = spark.createDataFrame(rows, "canonical_id string, title string, alternate_titles array<string>, start string, grant_id string")
    recs, members = linkage.classes(linkage.with_concepts(linkage.records(df)))
    recs = recs.withColumn("open", F.lit(True)).withColumn("asked", F.lit(False)).cache()
    all_pairs = recs.alias("a").join(recs.alias("b"), F.col("a.n") < F.col("b.n")).filter(linkage._alike(F.col("a.forms"), F.col("b.forms")))
    want = {(r[0], r[1]) for r in all_pairs.select("a.n", "b.n").collect()}
    planted = {tuple(sorted((2 * i, 2 * i + 1))) for i in range(60)}
    found = {(r.a.n, r.b.n) for r in linkage.rule_pairs(recs, "title_part_start").select("a", "b").collect()}
    number = {int(r.id[1:]): r.n for r in members.collect()}
    planted = {tuple(sorted((number[a], number[b]))) for a, b in planted} & want
    assert len(planted) > 30 and len(planted & found) >= 0.97 * len(planted)


def test_projects_empty(spark):
    assert linkage.match_projects(spark.createDataFrame([], "canonical_id string, title string, alternate_titles array<string>, start string, grant_id string")).count() == 0


# 8 tokens
def test_encoding_equals_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(VOCAB)
    t.encode_special_tokens = True
    e = bpe.encoder(VOCAB)
    rng = random.Random(9)
    texts = ["", " ", "a", "<|endoftext|> x", "it's 12.5% ok\n\n  ﬁ", "aaaaaaaaaaaaaaaaaaaaaa", "ő̋ 人人 👩‍👧 ​\u0000é", "x" * 50000, "ab " * 20000]
    texts += ["".join(rng.choice("abcdeőű .,'\n1人") for _ in range(rng.randrange(80))) for _ in range(1500)]
    for x in texts:
        assert e.encode(x) == t.encode(x, add_special_tokens=False).ids, x[:80]
    assert e.encode(None) == []


def test_encode_column(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "Hello", "k")], "doc_id bigint, text string, ids string")
    assert {r.doc_id: r.ids for r in bpe.encode_column(df, "doc_id", "text").collect()} == {1: [], 2: [], 3: [15496]}
    assert bpe.encode_column(df.limit(0), "doc_id", "text").count() == 0


# 9 mixing
def test_flow_prefers_fresh_text():
    flow = mixing.min_cost_flow({("a",): 10, ("a", "b"): 10, ("b",): 10}, {"a": 15, "b": 25}, {"a": 2, "b": 2})
    assert sum(v for (_, s), v in flow.items() if s == "a") == 15 and sum(v for (_, s), v in flow.items() if s == "b") == 25
    assert mixing.min_cost_flow({("a",): 5}, {"a": 100}, {"a": 3}) == {(("a",), "a"): 15}
    assert mixing.min_cost_flow({}, {"a": 1}, {"a": 1}) == {}


def test_mix(spark):
    docs = [(i, f"text number {i} " * (i % 7 + 1), "big" if i % 3 else "small") for i in range(300)] + [(900, None, "big"), (901, "", "small"), (902, "x y", None), (903, "unlisted", "other"), (904, docs_text(1), "big")]
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 3), ("absent", 0.1, 2)], "source string, target_share double, max_repeats int")
    m = mixing.Mix(spark.createDataFrame(docs, "doc_id bigint, text string, source string"), targets)
    rows = m.rows().collect()
    assert len({(r.doc_id, r.source) for r in rows}) == len(rows) and all(1 <= r.repeats <= {"big": 1, "small": 3}[r.source] for r in rows)
    shares = {r.source: r for r in m.shares().collect()}
    assert shares["absent"].state == "no text" and abs(shares["big"].share_of_plan - 0.5) < 0.01 and abs(shares["small"].share_of_plan - 0.4) < 0.01
    assert {r.doc_id for r in rows}.isdisjoint({900, 901, 902, 903})
    again = mixing.Mix(spark.createDataFrame(docs[::-1], "doc_id bigint, text string, source string"), targets)
    assert sorted(map(tuple, again.rows().collect())) == sorted(map(tuple, rows))
    none = mixing.Mix(spark.createDataFrame([], "doc_id bigint, text string, source string"), targets)
    assert none.rows().count() == 0 and none.shares().count() == 3


def docs_text(i):
    return f"text number {i} " * (i % 7 + 1)


# 10 sentences
ABBR = {"Dr", "pl", "Fig", "vs", "kb"}
CASES = [
    (False, ["Dr. Kis Anna pl. Pesten élt.", "A 2010. évi jelentés szerint 3,5 pont.", "Vége!"], " "),
    (False, ["„Nekünk már nincs mire várni. A bolt bezárt” – mondta Kis.", "Új mondat."], " "),
    (False, ["(See the tables in Section 2.3.)", "It rose (see Fig. 2).", "Why?", "eSurvey data do not show it."], " "),
    (False, ["店は閉まった……若者も去った。", "「どうするのか。」と住民は尋ねた。", "誰が負担するのか？"], ""),
    (False, ["她说：“店关了。”", "“怎么办？”一位村民问道。", "谁来承担？"], ""),
    (False, ["यह पहला है।", "“क्या करें?” एक निवासी ने पूछा।"], " "),
    (False, ["من يتحمل التكلفة؟", "«ماذا نفعل؟» سألت إحدى الساكنات."], " "),
    (False, ["รายงานนี้ยืนยัน", "ใครเป็นผู้รับภาระ"], " "),
    (True, ["Keresés…", "1. Bemutatás", "- egy elem", "Copyright © 2020"], "\n"),
    (False, ["Cím pont nélkül", "Bekezdés egy\ntört sorral."], "\n \n"),
]


@pytest.mark.parametrize("by_line,units,gap", CASES)
def test_units(by_line, units, gap):
    text = gap.join(units)
    got = [text[a:b] for a, b in sentences.Splitter(ABBR, ABBR).split(text, by_line)]
    assert got == units


def test_units_of_odd_texts_and_documents(spark):
    s = sentences.Splitter(set(), set())
    assert s.split(None, False) == s.split("", True) == s.split(" \n\t", False) == []
    assert len(s.split("Egy mondat van itt. " * 20000, False)) == 20000
    # the document itself shows that "kt." is an abbreviation
    assert len(s.split("A kt. szerint jó. A kt. Kovács írta.", False)) == 2
    df = spark.createDataFrame([(1, "Egy. Kettő.", None, 0), (2, "Egy\nKettő", "x", 0), (3, None, None, 0)], "doc_id bigint, text string, raw_path string, sent_start int")
    assert sorted(map(tuple, sentences.sentence_units(df).collect())) == [(1, 0, 4), (1, 5, 11), (2, 0, 3), (2, 4, 9)]
    assert sentences.sentence_units(df.limit(0)).count() == 0
