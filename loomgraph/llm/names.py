"""Variant spellings of names of people and organisations.

Spellings that fold to the same word set (case, spaces, accents, order, commas,
academic titles) form a class. Two classes are candidates if they share a MinHash band
over the padded q-grams of their words; the number of bands follows from the
collision curve for a wished recall at a given similarity. Candidates are
verified by Monge-Elkan similarity: the mean, over the words of the shorter
name, of the best likeness to a word of the longer one. Two words that are both
well attested, that is seen beside several different words, and neither far
rarer than the other, are never typing errors of each other. Verified classes are clustered as stars: heavy classes
become centres, and lighter ones join the likest centre next to them.

Bands of common given names hold most pairs of names, nearly all of which fail
verification; their number grows with the square of the names. So the pairs are
searched from the other end: the like words of the vocabulary first
(``like_words``), then the names that meet when words are replaced by like ones
(``meeting_rows``). Every pair that verification accepts meets so; the pairs
that it accepts are then tested for a common band.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations, product
from unicodedata import combining, normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.skew import salted_join
from loomgraph.session import cut, cut_measured, spread

Q, ROWS = 2, 4
#: Wished recall of the candidate search at this Jaccard similarity of q-grams.
SIMILARITY, RECALL = 0.5, 0.99
#: A word is attested if it stands beside so many different words.
PARTNERS = 3
#: and beside at least this share of the other word's partners.
RELATIVE = 0.08
#: Names meet in their so many rarest words, long names in one.
MEET = 3
#: A word with more like words is met by them, however rare it is.
HUB = 64
#: A bucket with more rows is split.
BUCKET_ROWS = 20_000
#: Least likeness of two words that stand for each other.
LIKE = 0.8
#: Least Monge-Elkan similarity of two spellings of one name.
ACCEPT = 0.85

# Academic titles and forms of address.
TITLES = set("dr prof phd csc dsc habil ifj id ozv mr mrs ms emeritus professor".split())
# Short forms of kinds of organisations, in words.
KINDS = {"kut. csop.": "kutatocsoport", "kut. kp.": "kutatokozpont", "kut. int.": "kutatointezet", "inst.": "intezet", "dept.": "tanszek"}
# Hungarian given names and their everyday forms (folded).
NICKNAMES = {
    "zoltan": "zoli", "katalin": "kati kata kato", "julianna": "juli julcsi", "julia": "juli julcsi", "erzsebet": "erzsi bozsi zsoka", "istvan": "pista isti",
    "jozsef": "joska jozsi", "laszlo": "laci", "ferenc": "feri", "gabor": "gabi", "maria": "mari marika", "margit": "manci", "sandor": "sanyi", "janos": "jancsi jani",
    "mihaly": "misi", "tamas": "tomi", "peter": "peti", "andras": "bandi andris", "attila": "ati", "tibor": "tibi", "agnes": "agi", "eva": "evi", "ildiko": "ildi",
    "zsuzsanna": "zsuzsa zsuzsi", "judit": "jutka", "gyorgy": "gyuri", "imre": "imi", "karoly": "karcsi", "lajos": "lali", "miklos": "miki", "pal": "pali", "rozalia": "rozi",
    "terez": "terka teri", "viktoria": "viki", "veronika": "vera veri", "krisztina": "kriszti", "anna": "anni panni", "anita": "ani", "balint": "bali", "bela": "belus",
    "csaba": "csabi", "daniel": "dani", "david": "davidka", "dorottya": "dori", "erika": "eri", "eszter": "eszti", "henrik": "henri", "ibolya": "ibi", "ilona": "ili ica ilus",
    "magdolna": "magdi", "piroska": "piri", "rebeka": "rebi", "robert": "robi", "sarolta": "sari", "szilvia": "szilvi", "tivadar": "tivi", "valeria": "vali", "vilmos": "vili",
    "borbala": "bori", "beata": "bea", "aniko": "ani", "adel": "adi", "gergely": "gergo geri", "matyas": "matyi", "kristof": "kristof", "gizella": "gizi", "hajnalka": "hajni",
    "nikoletta": "niki", "norbert": "norbi", "szabolcs": "szabi", "barbara": "barbi", "timea": "timi", "monika": "moni", "tunde": "tundi", "bernadett": "detti berni",
}
SHORT = {(short, name) for name, shorts in NICKNAMES.items() for short in shorts.split()}


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands so that 1 - (1 - s**rows)**bands reaches the recall at similarity s."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def fold(name: str) -> list[str]:
    """Sorted words without case, accents, titles, and with digits read as letters; a
    word cut short by a point keeps the point."""
    s = "".join(c for c in normalize("NFKD", name) if not combining(c)).lower()
    for short, kind in KINDS.items():
        if short in s:
            s = re.sub(rf"(?<!\w){re.escape(short)}", f"{kind} ", s)
    words = re.findall(r"[^\W_]+\.?", s)
    words = [w if len(w) > 2 else w.rstrip(".") for w in words]  # an initial needs no point
    words = [re.sub(r"(?<=[a-z])1|1(?=[a-z])", "l", re.sub(r"(?<=[a-z])0|0(?=[a-z])", "o", w)) for w in words]
    kept = [w for w in words if w.rstrip(".") not in TITLES] or words
    return sorted(kept)


def spellings(person: DataFrame, matches: DataFrame) -> DataFrame:
    """(name, weight): the distinct spellings; weight = persons and match ends that use one.

    Null and blank names are left out; only the named columns are read.
    """
    ids = person.select(F.col("canonical_name").alias("name"), F.col("canonical_id").alias("u")).distinct().select("name")
    ends = matches.select(F.explode(F.array("left_label", "right_label")).alias("name"))
    names = ids.unionByName(ends).filter(F.trim("name") != "")
    return names.groupBy("name").agg(F.count(F.lit(1)).alias("weight"))


def classes(names: DataFrame) -> DataFrame:
    """(name, weight, key): key = the folded words, the same for all spellings of a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [" ".join(fold(n)) for n in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.string())], names=["name", "weight", "key"])

    return names.mapInArrow(run, "name string, weight bigint, key string").filter("key <> ''")


def qgrams(key: str) -> set[str]:
    out = set()
    for w in key.split(" "):
        padded = f"^{w}$"
        out |= {padded[i : i + Q] for i in range(len(padded) - Q + 1)}
    return out


def signer(bands: int) -> Callable[[str], np.ndarray]:
    """Function of a key: for each band of its MinHash signature the hash of band and signature."""
    import xxhash

    rng = np.random.default_rng(20)
    a = rng.integers(1, 2**61, bands * ROWS, dtype=np.uint64) | np.uint64(1)
    c = rng.integers(0, 2**63, bands * ROWS, dtype=np.uint64)
    hashed = lru_cache(100_000)(lambda g: xxhash.xxh64_intdigest(g))
    mix = rng.integers(1, 2**61, ROWS, dtype=np.uint64) | np.uint64(1)
    turn = rng.integers(0, 2**63, bands, dtype=np.uint64)

    def sign(key: str) -> np.ndarray:
        grams = np.array([hashed(g) for g in qgrams(key)], dtype=np.uint64)
        x = grams[:, None] * a[None, :] + c[None, :]
        x ^= x >> np.uint64(31)
        least = x.min(axis=0).reshape(bands, ROWS)
        return (((least * mix).sum(axis=1) ^ turn) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)

    return sign


def band_rows(keys: DataFrame, bands: int) -> DataFrame:
    """(h, k): a row for each band of a key's MinHash signature; h = hash of band and signature.
    With ``collisions`` all pairs that share a band, which are too many for large tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = signer(bands)
        for b in batches:
            ids, hs = b.column(0).to_numpy(), [sign(k) for k in b.column(1).to_pylist()]
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs)), pa.array(np.repeat(ids, bands))], names=["h", "k"])

    return spread(keys.select("k", "key"), "k").mapInArrow(run, "h bigint, k bigint")


def partners(keys: DataFrame) -> DataFrame:
    """(w, n): the words that stand beside at least PARTNERS different words, and beside how many."""
    words = F.filter(F.split("key", " "), lambda w: F.length(w) > 1)
    pairs = keys.select(F.explode(words).alias("w"), words.alias("all")).select("w", F.explode("all").alias("o")).filter("w <> o").distinct()
    return pairs.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= PARTNERS)


def attested(keys: DataFrame) -> DataFrame:
    """(key, known, counts): the words of each key that stand beside at least PARTNERS
    different words, and beside how many."""
    each = salted_join(keys.select("key", F.explode(F.split("key", " ")).alias("w")).distinct(), partners(keys), "w", "left")
    met = F.collect_list(F.when(F.col("n").isNotNull(), F.struct("w", "n")))
    return each.groupBy("key").agg(met.alias("m")).select("key", F.col("m.w").alias("known"), F.col("m.n").alias("counts"))


@lru_cache(200_000)
def edits(a: str, b: str) -> int:
    """Edit distance with neighbour swaps; 3 stands for three and more."""
    if abs(len(a) - len(b)) > 2:
        return 3
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        if min(row) > 2:
            return 3
        two, one = one, row
    return min(one[-1], 3)


def _in_order(short: str, long: str) -> bool:
    rest = iter(long)
    return short[0] == long[0] and all(c in rest for c in short)


@lru_cache(200_000)
def likeness(a: str, b: str, both_known: bool) -> float:
    """How alike two words are, 0 to 1."""
    if a == b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 1:
        return 0.95 if b[0] == a else 0.0
    if a[-1] == "." or b[-1] == ".":  # a word cut short
        short, long = (a, b) if a[-1] == "." else (b, a)
        short, long = short.rstrip("."), long.rstrip(".")
        if long.startswith(short) or (len(short) <= 4 and _in_order(short, long)):
            return 0.93
        a, b = sorted((short, long), key=len)
    if len(a) >= 6 and b[len(a) :] in ("a", "e", "ja", "je") and b.startswith(a):  # possessive endings
        return 0.95
    if (a, b) in SHORT:
        return 0.93
    if both_known:
        return 0.0
    if a.replace("rn", "m") == b.replace("rn", "m"):
        return 0.97
    d = edits(a, b)
    if d == 1 and len(b) >= 4:
        return 0.93
    if d == 2 and len(a) >= 6:
        return 0.88
    if len(a) >= 3 and b.startswith(a):
        return 0.88
    if len(a) <= 4 and len(b) >= 6 and len(a) >= 3 and _in_order(a, b):
        return 0.86
    return 0.0


def both_attested(s: str, t: str, known_a: dict[str, int], known_b: dict[str, int]) -> bool:
    low, high = sorted((known_a.get(s, 0), known_b.get(t, 0)))
    return low >= PARTNERS and low >= RELATIVE * high


def monge_elkan(a: str, b: str, known_a: dict[str, int], known_b: dict[str, int]) -> float:
    """Similarity of two keys; 0 unless every word of the shorter one finds a partner of
    its own and the longest words are among them. At most one word may stay alone, and an
    initial needs the other words to be spelled alike but for one edit of a long word."""
    x, y = a.split(" "), b.split(" ")
    if (len(x), x) > (len(y), y):  # the result does not depend on the order of the two
        x, y, known_a, known_b = y, x, known_b, known_a
    if len(y) - len(x) > 1 or len(x) < 2:
        return 0.0
    scores = sorted(((likeness(s, t, both_attested(s, t, known_a, known_b)), i, j) for i, s in enumerate(x) for j, t in enumerate(y)), reverse=True)
    left, right, total, weakest = {}, set(), 0.0, 1.0
    initial = False
    for score, i, j in scores:
        if i in left or j in right or score < LIKE:
            continue
        if len(y[j]) == 1 and len(y) > len(x):
            continue  # a middle initial stands for no word of the shorter name
        left[i] = len(y[j])
        right.add(j)
        total += score
        if min(len(x[i]), len(y[j])) == 1:
            initial = True
        else:
            weakest = min(weakest, 1.0 if score > 0.96 else score if len(x[i]) < 7 else score + 0.02)
    longest = max(range(len(x)), key=lambda i: len(x[i])), max(range(len(y)), key=lambda j: len(y[j]))
    if len(left) < len(x) or longest[1] not in right or min(len(x[longest[0]]), left[longest[0]]) < 3 or (initial and weakest < 0.94):
        return 0.0
    return total / len(x) - 0.02 * (len(y) - len(x))


def bare_words(key: Column) -> Column:
    """The words of a key without the points of words cut short."""
    return F.transform(F.split(key, " "), lambda w: F.rtrim(w, F.lit(".")))


def possible(x: Column, y: Column) -> Column:
    """A bound that every verified pair meets, for pairs that share a band; ``meeting_rows`` needs none.
    x, y: bare_words of the two keys.

    Each word of the shorter name has one in the longer that ``likeness`` may accept: one
    that begins it or that it begins, one with the same first letter where either is short
    (initials, words cut short), one within two edits (a neighbour swap is one, but two
    here), its everyday form, or one that differs by rn for m. With as many words in both,
    the same holds the other way round, else for the longest word of the longer name.
    """
    either = [f"{v} {w}" for pair in sorted(SHORT) for v, w in (pair, pair[::-1])]

    def near(s: Column, t: Column) -> Column:
        short = F.least(F.length(s), F.length(t))
        apart = F.abs(F.length(s) - F.length(t))
        begins = (s == t) | F.startswith(s, t) | F.startswith(t, s) | ((short <= 4) & (F.substring(s, 1, 1) == F.substring(t, 1, 1)))
        edits = (apart <= 4) & (F.levenshtein(s, t, 4) >= 0) & ((short >= 6) | (F.levenshtein(s, t, 2) >= 0))
        rnm = (F.instr(s, "rn") > 0) | (F.instr(t, "rn") > 0)
        return begins | edits | (rnm & (F.replace(s, F.lit("rn"), F.lit("m")) == F.replace(t, F.lit("rn"), F.lit("m")))) | F.concat_ws(" ", s, t).isin(either)

    met = lambda p, q: F.forall(p, lambda v: F.exists(q, lambda w: near(v, w)))
    headed = lambda p, q: F.exists(F.filter(p, lambda v: F.length(v) == F.array_max(F.transform(p, F.length))), lambda v: F.exists(q, lambda w: near(v, w)))
    few = (F.abs(F.size(x) - F.size(y)) <= 1) & (F.least(F.size(x), F.size(y)) >= 2)
    return few & F.when(F.size(x) == F.size(y), met(x, y) & met(y, x)).when(F.size(x) < F.size(y), met(x, y) & headed(y, x)).otherwise(met(y, x) & headed(x, y))


def word_blocks(word: str) -> Iterator[tuple[str, int]]:
    """(block, side) of a word. Any two words of which ``likeness`` can be above 0 share a block,
    with both sides 0, or 1 for the first and 2 for the second."""
    u, cut_short = word.rstrip("."), word[-1] == "."
    if len(u) == 1:
        yield f"i{u}", 1
        return
    yield f"i{u[0]}", 2
    # edits and neighbour swaps: the words agree after as many deletions in each
    for n in range((len(u) >= 3) + (len(u) >= 6) + 1):
        yield from ((f"d{x}", 0) for x in {"".join(c) for c in combinations(u, len(u) - n)})
    if "m" in u or "rn" in u:
        yield f"m{u.replace('rn', 'm')}", 0
    # one begins the other
    if cut_short or len(u) >= 3:
        yield f"p{u}", 1
    yield from ((f"p{u[:n]}", 2) for n in range(2, len(u) + 1))
    # letters of the other in order, from its first
    if 3 <= len(u) <= 4 or (cut_short and len(u) == 2):
        yield f"o{u[:3]}", 1
    yield from ((f"o{u[0]}{x}", 2) for x in {*u[1:], *map("".join, combinations(u[1:], 2))})
    for short, name in _everyday().get(u, ()):
        yield f"n{short} {name}", 0


@lru_cache(1)
def _everyday() -> dict[str, list[tuple[str, str]]]:
    out: dict[str, list[tuple[str, str]]] = {}
    for pair in SHORT:
        for w in pair:
            out.setdefault(w, []).append(pair)
    return out


def like_words(words: DataFrame) -> DataFrame:
    """(w, uw, uc): the words that w may be replaced by, and their counts; of two words that
    ``likeness`` accepts, one is among those of the other: an initial before a HUB before the more frequent.

    words (w, c, n), w unique: the keys that hold a word; its partners, null if not attested."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            for at in range(0, b.num_rows, 500):
                rows = [(xxhash.xxh64_intdigest(x), s, w) for w in b.column(0).slice(at, 500).to_pylist() for x, s in word_blocks(w)]
                h = np.array([r[0] for r in rows], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array([r[1] for r in rows], pa.int8()), pa.array([r[2] for r in rows], pa.string())], names=["h", "s", "w"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = []
            for v, w, n, m in zip(*(c.to_pylist() for c in b.columns)):
                known = both_attested(v, w, {v: n or 0}, {w: m or 0})
                near.append(max(likeness(v, w, known), likeness(w, v, known)) >= LIKE)
            yield b.select(["v", "w"]).filter(pa.array(near, pa.bool_()))

    rows = cut(spread(words.select("w"), "w").mapInArrow(blocks, "h bigint, s tinyint, w string"))
    of = lambda side, names: rows.filter(side).select("h", F.col("w").alias(names))
    # only words that share a block are ever beside each other
    sides = of("s = 0", "v").join(of("s = 0", "w"), "h").filter("v < w").unionByName(of("s = 1", "v").join(of("s = 2", "w"), "h").filter("v <> w"))
    met = sides.select(F.least("v", "w").alias("v"), F.greatest("v", "w").alias("w")).distinct()
    first = words.select(F.col("w").alias("v"), F.col("n").alias("v_n"))
    near = cut(met.join(first, "v").join(words.select("w", F.col("n").alias("w_n")), "w").select("v", "w", "v_n", "w_n").mapInArrow(score, "v string, w string"))
    ends = near.unionByName(near.select(F.col("w").alias("v"), F.col("v").alias("w")))
    hubs = ends.groupBy("v").agg(F.count(F.lit(1)).alias("d")).join(words.select(F.col("w").alias("v"), "c"), "v")
    rank = hubs.select("v", "c", F.struct(F.length("v") == 1, F.col("d") > HUB, F.col("c"), F.col("v")).alias("rank"))
    up = near.join(rank, "v").join(rank.select(F.col("v").alias("w"), F.col("c").alias("w_c"), F.col("rank").alias("w_rank")), "w")
    low, high = F.struct("v", "c"), F.struct(F.col("w").alias("v"), F.col("w_c").alias("c"))
    up = up.select(F.when(F.col("rank") < F.col("w_rank"), F.struct(low.alias("a"), high.alias("b"))).otherwise(F.struct(high.alias("a"), low.alias("b"))).alias("e"))
    return up.groupBy(F.col("e.a.v").alias("w")).agg(F.collect_list("e.b").alias("u")).select("w", F.col("u.v").alias("uw"), F.col("u.c").alias("uc"))


def described(keys: DataFrame) -> DataFrame:
    """(k, key, w, c, n, uw, uc): each key with its words, the keys that hold each, its partners (null
    if not attested) and what it may be replaced by."""
    each = cut(keys.select("k", "key", F.explode(F.array_distinct(F.split("key", " "))).alias("w")))
    words = cut(each.groupBy("w").agg(F.count(F.lit(1)).alias("c")).join(partners(keys), "w", "left"))
    full = salted_join(each, words.join(like_words(words), "w", "left"), "w", "inner")
    met = full.groupBy("k", "key").agg(F.collect_list(F.struct("w", "c", "n", "uw", "uc")).alias("m"))
    return met.select("k", "key", *[F.col(f"m.{x}").alias(x) for x in ("w", "c", "n", "uw", "uc")])


def meetings(options: list[list[tuple[int, str]]]) -> set[tuple[tuple[tuple[int, str], ...], int]]:
    """(words, mask): the MEET rarest words (of more than 2 * MEET words the rarest) that a name can have
    with any of the options of each word taken, as sorted (count, word), and bits of those that were replaced.
    The first option is the word itself."""
    out = set()
    top = [max(o) for o in options]
    size = min(len(options), MEET if len(options) <= 2 * MEET else 1)
    least = sorted(range(len(options)), key=lambda i: top[i])[: size + 1]
    for at in combinations(range(len(options)), size):
        rest = next((top[i] for i in least if i not in at), None)
        for taken in product(*(enumerate(options[i]) for i in at)):
            chosen = sorted((o, j > 0) for j, o in taken)
            if rest is not None and rest < chosen[-1][0]:
                continue  # another word would be among the rarest
            if rest is None and max(len(o[1]) for o, _ in chosen) < 3:
                continue  # the longest words of the shorter name and its partner have three letters
            words = tuple(o for o, _ in chosen)
            mask = sum(1 << i for i, (o, new) in enumerate(chosen) if new and words.count(o) == 1)
            out.add((words, mask))
    return out


def meeting_rows(names: DataFrame) -> DataFrame:
    """(h, k, m): the buckets of each key. Of any two keys that ``monge_elkan`` accepts each word of the
    shorter one is like a word of the longer one, so they meet in a bucket: if of each two
    such words that differ one is replaced by the other, and the longer key's word without partner
    (never its longest) left out. m: bits of the words replaced and of leaving out; rows with a common bit need not be compared.

    names: ``described``."""
    left_out = 1 << MEET

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def of_key(key: str, options: dict[str, list[tuple[int, str]]]) -> set[tuple]:
            words = key.split(" ")
            if len(words) < 2:
                return set()
            each = [options[w] for w in words]
            rows = {(len(words), x, m) for x, m in meetings(each)}
            if len(words) > 2:
                longest = max(range(len(words)), key=lambda j: len(words[j]))
                for i in range(len(words)):
                    if i != longest:
                        rows |= {(len(words) - 1, x, m | left_out) for x, m in meetings(each[:i] + each[i + 1 :])}
            return rows

        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                ids, hs, masks = [], [], []
                for k, key, ws, cs, uws, ucs in zip(*(c.to_pylist() for c in whole.slice(at, 500).columns)):
                    for n, x, m in of_key(key, {w: [(c, w), *zip(uc or (), uw or ())] for w, c, uw, uc in zip(ws, cs, uws, ucs)}):
                        ids.append(k)
                        hs.append(xxhash.xxh64_intdigest(f"{n} {' '.join(w for _, w in x)}"))
                        masks.append(m)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(hs, dtype=np.uint64).view(np.int64)), pa.array(ids, pa.int64()), pa.array(masks, pa.int32())], names=["h", "k", "m"])

    return spread(names.select("k", "key", "w", "c", "uw", "uc"), "k").mapInArrow(run, "h bigint, k bigint, m int")


def collisions(rows: DataFrame, rows_limit: int = BUCKET_ROWS) -> DataFrame:
    """(l, r), l smaller, distinct: ids that share a bucket and, if rows have masks m, no bit there. Buckets
    without two such rows go first; a bucket of more than ``rows_limit`` rows is split, and each part meets the
    whole bucket in a task of its own."""
    if "m" not in rows.columns:
        rows = rows.withColumn("m", F.lit(0))
    shared, seen = cut_measured(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.bit_and("m").alias("m")).filter("n > 1 AND m = 0"), top=F.max("n"))
    live = rows.join(shared.select("h"), "h")
    left, right = live.select("h", F.col("k").alias("l"), F.col("m").alias("l_m")), live.select("h", F.col("k").alias("r"), F.col("m").alias("r_m"))
    met = salted_join(left, right, "h", "inner", rows_limit) if (seen["top"] or 0) > rows_limit else left.join(right, "h")
    return met.filter("l < r AND l_m & r_m = 0").select("l", "r").distinct()


def verified(keys: DataFrame, bands: int) -> DataFrame:
    """(a, b, sim): classes that share a band and whose Monge-Elkan similarity is at least ACCEPT.

    keys (k, key, weight), k unique."""
    names = cut(described(keys))
    pairs = collisions(cut(meeting_rows(names)))
    of = lambda side, c: names.select(F.col("k").alias(side), F.col("key").alias(c), F.col("w").alias(f"{c}_w"), F.col("n").alias(f"{c}_n"))
    full = pairs.join(of("l", "a"), "l").join(of("r", "b"), "r").select("a", "b", "a_w", "a_n", "b_w", "b_n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = lru_cache(20_000)(signer(bands))
        known = lambda words, counts: {w: n for w, n in zip(words, counts) if n}
        for b in batches:
            out = []
            for x, y, p, m, q, n in zip(*(c.to_pylist() for c in b.columns)):
                sim = monge_elkan(x, y, known(p, m), known(q, n))
                if sim >= ACCEPT and (sign(x) == sign(y)).any():
                    out.append((x, y, sim))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.float64())], names=["a", "b", "sim"])

    return full.mapInArrow(run, "a string, b string, sim double")


def star_clusters(keys: DataFrame, links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(key, centre): greedy stars. In a round every open class that outweighs all open
    neighbours (ties: more words, then the smaller key) is a centre; open neighbours of
    centres join the likest (ties: the heavier) one. Ends when no class is open."""
    rank = F.struct(F.col("weight"), F.size(F.split("key", " ")).alias("n"), -F.xxhash64("key"), F.col("key"))
    nodes = keys.select("key", rank.alias("rank"))
    both = links.select(F.explode(F.array(F.struct(F.col("a").alias("key"), F.col("b").alias("o"), "sim"), F.struct(F.col("b").alias("key"), F.col("a").alias("o"), "sim"))).alias("e")).select("e.*")
    edges = cut(both.join(nodes, "key").join(nodes.select(F.col("key").alias("o"), F.col("rank").alias("o_rank")), "o"))
    done, open_edges = [], edges
    for _ in range(max_rounds):
        if open_edges.isEmpty():
            break
        centres = open_edges.groupBy("key").agg(F.max("o_rank").alias("m"), F.first("rank").alias("rank")).filter("rank > m").select(F.col("key").alias("o"))
        joined = open_edges.join(centres, "o").groupBy("key").agg(F.max_by("o", F.struct("sim", "o_rank")).alias("centre"))
        step = cut(joined.unionByName(centres.select(F.col("o").alias("key"), F.col("o").alias("centre"))))
        done.append(step)
        settled = step.select("key")
        open_edges = cut(open_edges.join(settled, "key", "left_anti").join(settled.withColumnRenamed("key", "o"), "o", "left_anti"))
    else:
        raise RuntimeError("no fixpoint within max_rounds")
    stars = None
    for step in done:
        stars = step if stars is None else stars.unionByName(step)
    if stars is None:
        return keys.select("key", F.col("key").alias("centre"))
    return keys.select("key").join(stars, "key", "left").select("key", F.coalesce("centre", "key").alias("centre"))


def variant_clusters(person: DataFrame, matches: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(name, weight, centre): every spelling with the centre of its cluster."""
    named = cut(classes(spellings(person, matches)))
    keys = cut(named.groupBy("key").agg(F.sum("weight").alias("weight")).withColumn("k", F.monotonically_increasing_id()))
    links = cut(verified(keys, bands_for(similarity, recall)))
    return named.join(star_clusters(keys, links), "key").select("name", "weight", "centre")


def variant_pairs(clusters: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a smaller: the pairs of spellings of one cluster; a
    cluster holds the spellings of one name, which are few."""
    smaller: Column = F.col("l.name") < F.col("r.name")
    pairs = clusters.alias("l").join(clusters.alias("r"), (F.col("l.centre") == F.col("r.centre")) & smaller)
    return pairs.select(F.col("l.name").alias("name_a"), F.col("r.name").alias("name_b"))
