"""Matching project records across sources by a cascade of exact joins.

Each rule joins on an exact combination of attributes, from strong to weak:
grant number with title, title with start, then title parts with one or two
words left out. A rule only looks at records that no earlier rule resolved (they
are anti-joined, all but the least of each group, which stands for its group)
against all records, so weak evidence hardly touches what strong evidence has
settled. Grant numbers or wave numbers that contradict, or starts too far apart,
veto a pair; a record without a grant whose candidates belong to different
projects stays open. A rule's confidence is the smoothed share of true pairs
among those it emits, vetoes included, for records whose grant number (title
rules) or start (grant rules) is hidden from it and serves as the label.

Records with equal attributes form one class and meet as one. Only hashes of
keys and numbers of records are shuffled; the attributes of a pair are fetched
once, after repeated pairs are united.

Titles are compared as sets of concepts. Words that translate each other come
from the corpus itself: records that carry a title in two languages show which
words always occur together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.components import components, labelled
from loomgraph.operators.skew import salted_join
from loomgraph.session import cut

# Words of titles that say nothing about the project.
STOP = set(
    "a az egy es of the and in its to for with among case area peldaja kornyeke kornyezete tersegeben teruleten koreben"
    " surroundings region kutatas kutatasi projekt project research program c lezart completed".split()
)
WAVES = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8}
ACCENTS = ("áéíóöőúüűäàâèêëîïôùûçñ", "aeiooouuuaaaeeeiiouucn")
#: Translations: seen together at least so often, with at least this Dice coefficient.
PAIR_SEEN, PAIR_DICE = 3, 0.8
#: Share of records from which on a word is common.
COMMON = 0.002
#: Labelled precision: prior hits and trials, and the greatest number of labelled records that are asked.
PRIOR_HITS, PRIOR_TRIALS, LABELLED = 1.0, 2.0, 20_000
#: Rules of a lesser labelled precision give no pairs.
FLOOR = 0.5
RULES = ["grant_title", "grant_title_part", "title_start", "title_year", "title_part_start", "title_only"]


def folded(c: Column) -> Column:
    """Lower case without accents, letters and digits only, single spaces."""
    return F.trim(F.regexp_replace(F.translate(F.regexp_replace(F.lower(c), r"\p{M}+", ""), *ACCENTS), "[^a-z0-9]+", " "))


def grant_number(c: Column) -> Column:
    """The digits of a grant id written in any form; null if there are fewer than four."""
    return F.nullif(F.regexp_extract(F.regexp_replace(c, r"[\s.]", ""), r"(\d{4,})", 1), F.lit(""))


def records(projects: DataFrame) -> DataFrame:
    """(id, number, start, year, wave, forms): one row for each canonical_id.

    Repeated rows are united. forms: the word sets of the title and of each
    alternate title. Null ids are left out; a null title leaves the alternates.
    """
    flat = projects.filter("canonical_id IS NOT NULL").select(
        F.col("canonical_id").alias("id"), grant_number(F.col("grant_id")).alias("number"), F.col("start"),
        F.explode(F.concat(F.array("title"), F.coalesce("alternate_titles", F.array().cast("array<string>")))).alias("t"),
    )
    words = F.filter(F.split(folded(F.col("t")), " "), lambda x: x != "")
    waves = F.map_from_arrays(F.array(*map(F.lit, WAVES)), F.array(*map(F.lit, WAVES.values())))
    shown = flat.withColumn("w", words).select(
        "id", "number", "start",
        F.array_sort(F.array_distinct(F.filter("w", lambda x: ~x.isin(*STOP) & ~x.isin(*WAVES)))).alias("form"),
        F.array_max(F.transform(F.filter("w", lambda x: x.isin(*WAVES)), lambda x: F.try_element_at(waves, x))).alias("wave"),
        F.col("t").rlike("…").alias("cut"),
    )
    shown = shown.withColumn("form", F.when(F.col("cut"), _without_stump(F.col("form"))).otherwise(F.col("form")))
    return shown.groupBy("id").agg(
        F.max("number").alias("number"), F.max("start").alias("start"), F.max("wave").alias("wave"),
        F.array_sort(F.collect_set(F.when(F.size("form") > 1, F.col("form")))).alias("forms"),
    ).withColumn("year", F.substring("start", 1, 4).cast("int"))


def _without_stump(form: Column) -> Column:
    """Stumps of the few framing words a cut title may end in are left out."""
    return F.filter(form, lambda x: ~F.lit(" tersegeben kornyeke peldaja koreben surroundings projekt kutatasi").contains(F.concat(F.lit(" "), x)))


def translations(recs: DataFrame) -> DataFrame:
    """(w, c): words that translate each other with their concept, learned from all
    records with several titles, two by two. The concept is the least word of the group."""
    two = F.flatten(F.transform("forms", lambda x, i: F.transform(F.slice("forms", i + 2, F.size("forms")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    sides = recs.filter(F.size("forms") > 1).select(F.explode(two).alias("p"))
    sides = sides.select(F.array_except("p.a", "p.b").alias("a"), F.array_except("p.b", "p.a").alias("b")).filter("size(a) > 0 AND size(b) > 0")
    sides = cut(sides)
    alone = sides.select(F.explode(F.concat("a", "b")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= PAIR_SEEN)
    both = sides.select(F.explode("a").alias("a"), "b").select("a", F.explode("b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    both = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= PAIR_SEEN)
    na, nb = alone.select(F.col("w").alias("a"), F.col("n").alias("na")), alone.select(F.col("w").alias("b"), F.col("n").alias("nb"))
    strong = both.join(na, "a").join(nb, "b").filter(2 * F.col("n") >= PAIR_DICE * (F.col("na") + F.col("nb"))).select("a", "b")
    return labelled(cut(strong)).select(F.col("ref").alias("w"), F.col("label").alias("c"))


def with_concepts(recs: DataFrame) -> DataFrame:
    """Forms as sets of concepts, and ``rare``: the concepts that less than COMMON of all records hold."""
    words = recs.select("id", F.posexplode("forms").alias("f", "form")).select("id", "f", F.explode("form").alias("w"))
    words = cut(salted_join(words, translations(recs), "w", "left").select("id", "f", F.coalesce("c", "w").alias("w")).distinct())
    total = recs.count()
    # with w words a record at most w / COMMON words are common, so their list may be broadcast
    usual = words.select("id", "w").distinct().groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= COMMON * total).select("w", F.lit(True).alias("usual"))
    flagged = words.join(F.broadcast(usual), "w", "left")
    shown = flagged.groupBy("id", "f").agg(F.array_sort(F.collect_set("w")).alias("form"), F.collect_set(F.when(F.col("usual").isNull(), F.col("w"))).alias("r"))
    forms = shown.groupBy("id").agg(F.array_sort(F.collect_set("form")).alias("forms"), F.array_distinct(F.flatten(F.collect_list("r"))).alias("rare"))
    return recs.drop("forms").join(forms, "id")


def classes(recs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of equal attributes as one class.

    (n, number, start, year, wave, forms, rare) of each class, n its number, and
    (id, n): the members.
    """
    same = F.sha2(F.to_json(F.struct("number", "start", "wave", "forms")), 256)
    marked = recs.withColumn("same", same)
    firsts = marked.groupBy("same").agg(*[F.min(c).alias(c) for c in ("number", "start", "year", "wave")], F.first("forms").alias("forms"), F.first("rare").alias("rare"))
    numbered = cut(firsts.withColumn("n", F.monotonically_increasing_id()))
    members = cut(marked.select("id", "same").join(numbered.select("same", "n"), "same").select("id", "n"))
    return numbered.drop("same"), members


def _alike(a: Column, b: Column) -> Column:
    """Some form of one record equals some form of the other up to words that are
    spelled alike (two edits), left out on one side only, or not at all."""

    def near(x: Column, ys: Column) -> Column:
        return F.exists(ys, lambda y: (F.levenshtein(x, y) <= 2) & (F.length(x) > 3) | (F.startswith(y, x) | F.startswith(x, y)) & (F.least(F.length(x), F.length(y)) > 2))

    def pair(x: Column, y: Column) -> Column:
        only_x, only_y = F.array_except(x, y), F.array_except(y, x)
        return (F.size(F.array_intersect(x, y)) >= 1) & F.forall(only_x, lambda w: near(w, only_y)) & (F.least(F.size(only_x), F.size(only_y)) <= 2)

    # both directions from outside: inside one lambda the optimizer takes fits(x, y) and fits(y, x) for the same
    return F.exists(a, lambda x: F.exists(b, lambda y: pair(x, y))) | F.exists(b, lambda y: F.exists(a, lambda x: pair(y, x)))


def key_rows(recs: DataFrame, rule: str) -> DataFrame:
    """(k, n, whole, added, open): the hashed keys of a rule; records without the rule's attributes have none.

    whole: the words of a form. Less: one word left out (with a grant number
    also two). ``added`` is set where what remains holds no rare word: such a
    key would gather all projects of a common subject, so it only serves whole
    titles, and only if all its less rows left out the same word. Where a word's
    absence leaves no rare one, the forms with one letter of that word left out
    are keys too, so a typing error in it is still met.
    """
    number, start, year = F.col("number"), F.col("start"), F.col("year")
    form = recs.withColumn("form", F.explode("forms"))
    join = lambda x: F.array_join(x, " ")
    less = lambda x: F.transform(x, lambda w: F.array_remove(x, w))
    row = lambda key, whole, added=None: F.struct(key.alias("key"), F.lit(whole).alias("whole"), (F.lit(None).cast("string") if added is None else added).alias("added"))
    none = F.array().cast("array<struct<key:string,whole:boolean,added:string>>")
    f, rare = F.col("form"), F.col("rare")
    full = F.array(row(join(f), True))
    if rule == "grant_title_part":
        one = F.when(F.size(f) > 2, less(f)).otherwise(F.array())
        two = F.when(F.size(f) > 3, F.flatten(F.transform(less(f), less))).otherwise(F.array())
        keys = F.concat(full, F.transform(F.filter(F.array_distinct(F.transform(F.concat(one, two), join)), lambda k: F.length(k) > 3), lambda k: row(k, False)))
    elif rule in ("title_part_start", "title_only"):
        seen = lambda w: F.arrays_overlap(F.array_remove(f, w), rare)
        one = F.transform(f, lambda w: row(join(F.array_remove(f, w)), False, F.when(~seen(w), w)))
        letters = lambda w: F.transform(F.sequence(F.lit(0), F.length(w)), lambda k: F.when(k == 0, w).otherwise(F.concat(F.substr(w, F.lit(1), k - 1), F.substr(w, k + 1))))
        typed = F.flatten(F.transform(F.filter(f, lambda w: (F.length(w) > 3) & ~seen(w)), lambda w: F.transform(F.array_distinct(letters(w)), lambda v: row(F.concat(join(F.array_remove(f, w)), F.lit(" #"), v), False))))
        keys = F.concat(full, F.when(F.size(f) > 2, F.concat(one, typed)).otherwise(none))
    else:
        keys = full
    if rule.startswith("grant"):
        form, prefix = form.filter(number.isNotNull()), number
    elif rule == "title_start":
        form, prefix = form.filter(F.length(start) >= 7), start
    elif rule == "title_only":
        prefix = F.lit("")
    else:
        form, prefix = form.filter(year.isNotNull()).withColumn("y", F.explode(F.array(year, year + 1))), F.col("y").cast("string")
    rows = form.select("n", "open", prefix.alias("prefix"), F.explode(keys).alias("e"))
    return rows.select(F.xxhash64(F.lit(rule), "prefix", "e.key").alias("k"), "n", "e.whole", F.xxhash64("e.added").alias("a"), F.col("e.added").isNotNull().alias("common"), "open").select(
        "k", "n", "whole", F.when(F.col("common"), F.col("a")).alias("added"), "open"
    )


def key_pairs(rows: DataFrame) -> DataFrame:
    """(l, r), l smaller: pairs of classes that share a key, at least one of them open."""
    shared = rows.groupBy("k").agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.bool_or("open").alias("o"), F.min("added").alias("a0"), F.max("added").alias("a1"))
    shared = shared.filter("n0 < n1 AND o").select("k", (F.col("a0") == F.col("a1")).alias("one"))
    live = rows.join(shared, "k").filter("added IS NULL OR one").select("k", "n", "open", "whole", F.col("added").isNotNull().alias("common")).distinct()
    live = cut(live)
    fits = F.col("l.open") | F.col("r.open")
    meets = ~(F.col("l.common") & F.col("r.common"))
    pairs = live.alias("l").join(live.alias("r"), (F.col("l.k") == F.col("r.k")) & (F.col("l.n") < F.col("r.n")) & fits & meets)
    return pairs.select(F.col("l.n").alias("l"), F.col("r.n").alias("r")).distinct()


def _agree(a: str, b: str, numbers: bool = True, years: bool = True) -> Column:
    """No veto: grants, waves and starts do not contradict."""
    x = lambda c: F.col(f"{a}.{c}")
    y = lambda c: F.col(f"{b}.{c}")
    same = F.coalesce(x("number") == y("number"), F.lit(False))
    out = (F.coalesce(x("wave"), F.lit(1)) == F.coalesce(y("wave"), F.lit(1))) | (same if numbers else F.lit(False))
    if numbers:
        out = out & F.coalesce(x("number") == y("number"), F.lit(True))
    if years:
        out = out & F.coalesce(F.abs(x("year") - y("year")) <= 1, F.lit(True))
    return out


def rule_pairs(recs: DataFrame, rule: str) -> DataFrame:
    """(a, b): the classes of each pair that a rule's keys bring together and comparison
    word by word accepts, the label of asked classes (``asked``) hidden from the veto.

    recs bears ``open`` and ``asked``; at least one class of a pair is one of them.
    Title rules hide the grant number, grant rules the start.
    """
    grant = rule.startswith("grant")
    active = recs.withColumn("active", F.col("open") | F.col("asked"))
    pairs = key_pairs(key_rows(active.drop("open").withColumnRenamed("active", "open"), rule))
    of = lambda side, c: recs.select(F.col("n").alias(side), F.struct("n", "number", "start", "year", "wave", "forms", "open", "asked").alias(c))
    full = pairs.join(of("l", "a"), "l").join(of("r", "b"), "r").select("a", "b")
    hidden = (F.col("a.asked") | F.col("b.asked")) & _agree("a", "b", numbers=grant, years=not grant)
    return full.filter(_agree("a", "b") | hidden).filter(_alike(F.col("a.forms"), F.col("b.forms")))


def unambiguous(pairs: DataFrame, numbers: bool = True) -> DataFrame:
    """(l, r): leaves out pairs in which one record fits candidates that contradict each other.

    A record without a grant must not meet two grants, two waves or starts far
    apart; a title that leaves words out must not fit titles that add different ones.
    ``numbers`` = False treats the records as if they had no grant.
    """
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    more = F.array_join(F.array_sort(F.array_except(F.flatten("b.forms"), F.flatten("a.forms"))), " ")
    whole = F.size(F.array_except(F.flatten("a.forms"), F.flatten("b.forms"))) == 0
    wave, added = F.coalesce("b.wave", F.lit(1)), F.when(whole & (F.size(F.split(more, " ")) > 1), more)
    spans = [F.min("b.number").eqNullSafe(F.max("b.number")), F.coalesce(F.max("b.year") - F.min("b.year"), F.lit(0)) <= 1, F.min(wave) == F.max(wave)]
    own = F.first("a.number").isNotNull() if numbers else F.lit(False)
    clear = (own | reduce(lambda x, y: x & y, spans)) & F.min(added).eqNullSafe(F.max(added))
    judged = both.groupBy(F.col("a.n").alias("n")).agg(clear.alias("clear")).filter("clear").select("n")
    ends = pairs.select(F.col("a.n").alias("l"), F.col("b.n").alias("r"))
    return ends.join(judged.withColumnRenamed("n", "l"), "l", "left_semi").join(judged.withColumnRenamed("n", "r"), "r", "left_semi")


def rule_precision(pairs: DataFrame, rule: str) -> float:
    """Smoothed share of true pairs among those that a rule emits for the asked classes,
    whose label is hidden: numbers are equal (title rules) or years at most one apart (grant rules)."""
    grant = rule.startswith("grant")
    shown = pairs.filter("a.asked OR b.asked").filter(_agree("a", "b", numbers=grant, years=not grant))
    ends = shown.select(F.col("a.n").alias("l"), F.col("b.n").alias("r"), "a", "b").join(unambiguous(shown, numbers=grant), ["l", "r"], "left_semi")
    judged = ends.filter("a.number IS NOT NULL AND b.number IS NOT NULL AND a.year IS NOT NULL AND b.year IS NOT NULL")
    true = F.abs(F.col("a.year") - F.col("b.year")) <= 1 if grant else F.col("a.number") == F.col("b.number")
    got = judged.agg(F.count_if(true).alias("hits"), F.count(F.lit(1)).alias("trials")).first()
    return (got["hits"] + PRIOR_HITS) / (got["trials"] + PRIOR_TRIALS)


def match_projects(projects: DataFrame, floor: float = FLOOR) -> DataFrame:
    """(id_a, id_b, rule, confidence): pairs of ids of one project, id_a smaller.

    Pairs that follow only by chains carry rule ``chain`` and the least
    confidence of the group; records of equal attributes carry ``equal`` and the
    confidence of the strongest rule that their attributes allow. Rules below
    ``floor`` give none. Up to LABELLED classes with a grant number and a start,
    chosen by hash, are asked for the confidence; everything else covers all
    records. Empty tables and records without titles give none.
    """
    recs, members = classes(cut(with_concepts(cut(records(projects)))))
    asked = recs.filter("number IS NOT NULL AND year IS NOT NULL").orderBy(F.xxhash64("n")).limit(LABELLED).select("n", F.lit(True).alias("asked"))
    recs = cut(recs.join(asked, "n", "left").withColumn("asked", F.coalesce("asked", F.lit(False))))
    found, trust = None, {}
    for rule in RULES:
        open_recs = recs.withColumn("open", F.lit(True))
        if found is not None:  # the least of each group goes on, for the others
            resolved = found.select(F.col("r").alias("n"), F.lit(True).alias("met")).distinct()
            open_recs = cut(recs.join(resolved, "n", "left").withColumn("open", F.col("met").isNull()).drop("met"))
        pairs = cut(rule_pairs(open_recs, rule))
        trust[rule] = rule_precision(pairs, rule)
        if trust[rule] < floor:
            continue
        step = unambiguous(pairs.filter(_agree("a", "b")).filter("a.open OR b.open"))
        step = step.select(F.least("l", "r").alias("l"), F.greatest("l", "r").alias("r"), F.lit(rule).alias("rule"), F.lit(trust[rule]).alias("confidence"))
        found = cut(step if found is None else found.unionByName(step))
    return close_groups(recs, members, found, trust)


def close_groups(recs: DataFrame, members: DataFrame, found: DataFrame | None, trust: dict[str, float]) -> DataFrame:
    """Adds the pairs of equal records and those that follow by chains. Groups hold the
    records of one project, one for each site and delivery, so their pairs are few."""
    if found is None:
        found = recs.sparkSession.createDataFrame([], "l bigint, r bigint, rule string, confidence double")
    edges = found.select(F.col("l").alias("a"), F.col("r").alias("b"))
    labels = recs.select("n", "number", "wave", "year", "start").join(components(edges).withColumnRenamed("v", "n"), "n", "left").withColumn("label", F.coalesce("label", "n"))
    least = found.join(labels.select(F.col("n").alias("l"), "label"), "l").groupBy("label").agg(F.min("confidence").alias("least"))
    own = F.when(F.col("number").isNotNull(), "grant_title").when(F.length("start") >= 7, "title_start").when(F.col("year").isNotNull(), "title_year").otherwise("title_only")
    named = cut(members.join(labels.withColumn("own", own), "n").join(least, "label", "left"))
    pairs = named.alias("l").join(named.alias("r"), (F.col("l.label") == F.col("r.label")) & (F.col("l.id") < F.col("r.id"))).filter(_agree("l", "r"))
    first = F.array_position(F.array(*map(F.lit, RULES)), F.col("rule"))
    best = found.groupBy("l", "r").agg(F.min_by("rule", first).alias("rule"), F.min_by("confidence", first).alias("confidence"))
    equal = F.col("l.n") == F.col("r.n")
    given = reduce(lambda c, k: F.when(F.col("l.own") == k, trust.get(k, 0.0)).otherwise(c), RULES, F.lit(None).cast("double"))
    shown = pairs.select(
        F.col("l.id").alias("id_a"), F.col("r.id").alias("id_b"), F.least("l.n", "r.n").alias("l"), F.greatest("l.n", "r.n").alias("r"),
        equal.alias("equal"), given.alias("given"), F.col("l.least").alias("least"),
    )
    out = shown.join(best, ["l", "r"], "left").select(
        "id_a", "id_b", F.when(F.col("equal"), "equal").otherwise(F.coalesce("rule", F.lit("chain"))).alias("rule"),
        F.when(F.col("equal"), F.col("given")).otherwise(F.coalesce("confidence", "least")).alias("confidence"),
    )
    return out
