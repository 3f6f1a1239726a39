"""Text functions as Column expressions: folding, names, titles, scrubbing, search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin letters and their base letters.
ACCENTED = "áàâäãåçéèêëíìîïñóòôöõőúùûüűýÿÁÀÂÄÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕŐÚÙÛÜŰÝ"
PLAIN = "aaaaaaceeeeiiiinoooooouuuuuyyAAAAAACEEEEIIIINOOOOOOUUUUUY"
# Degrees that are no part of a name.
DEGREES = [
    "dr", "dr.", "prof", "prof.", "phd", "phd.", "ph.d.", "habil", "habil.", "dsc", "dsc.", "d.sc.", "csc", "csc.", "c.sc.", "mta", "rendes",
    "tag", "levelező", "emeritus", "emerita", "ifj.", "id.", "özv.",
]
# Hungarian month names and their short forms.
MONTHS = {
    "január": 1, "február": 2, "március": 3, "április": 4, "május": 5, "június": 6, "július": 7, "augusztus": 8, "szeptember": 9,
    "október": 10, "november": 11, "december": 12, "jan": 1, "febr": 2, "márc": 3, "ápr": 4, "máj": 5, "jún": 6, "júl": 7, "aug": 8,
    "szept": 9, "okt": 10, "nov": 11, "dec": 12,
}


def strip_accents(c: Column) -> Column:
    """Base letters; combining marks go. Stays in code generation."""
    return F.translate(F.regexp_replace(c, r"\p{Mn}+", ""), ACCENTED, PLAIN)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[\s ]+", " "))


def name_words(c: Column) -> Column:
    """Words of a display name without degrees."""
    words = F.split(squeeze(F.regexp_replace(c, ",", " ")), " ")
    return F.filter(words, lambda w: ~F.lower(w).isin(*DEGREES) & (w != ""))


def name_titles(c: Column) -> Column:
    """The degrees of a display name, in order."""
    return F.filter(F.split(squeeze(F.regexp_replace(c, ",", " ")), " "), lambda w: F.lower(w).isin(*DEGREES))


def name_key(c: Column) -> Column:
    """Comparison key: no degrees, no accents, lower case, words of letters; a hyphen parts words."""
    return squeeze(F.regexp_replace(F.lower(strip_accents(F.array_join(name_words(c), " "))), r"[^a-z\s]", " "))


def order_free_key(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(name_key(c), " ")), " ")


def slug(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]+", "-"), F.lit("-"))


def exact_form(c: Column) -> Column:
    """A name with its accents, without degrees, lower case, a space behind each point."""
    return F.lower(squeeze(F.replace(F.array_join(name_words(c), " "), F.lit("."), F.lit(". "))))


def title_fold(c: Column) -> Column:
    """Lower case, no accents, letters and digits only, single spaces."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]+", " "))


# What a title may carry besides the title itself (period, grant, funder, role, kind, site, year, address).
FUNDER = r"(?:NKFIH|NKFI|OTKA)"
ROLE = (
    r"(?:vezető kutató|kutatásvezető|projektvezető|témavezető|szakmai vezető|résztvevő(?: kutató)?|kutató|részvétel|participating researcher"
    r"|researcher|principal investigator|koordinátor)"
)
AFFIXES = [
    r"^\s*\d{4}\s*[-–]\s*(?:\d{4}|jelenleg|folyamatban)?\s*[-–—:.]?\s+",
    rf"^\s*(?:[A-Z]{{1,4}}\s+)?(?:{FUNDER}\s*)?[A-Z]{{0,4}}[\s_-]*\d{{5,6}}\s*[-–—:.,]\s+",
    r"(?iu)\s*\([^()]*(?:\d|NKFI|OTKA|PI:|ERC|H2020|Horizon|kutató|vezető|résztvevő|program)[^()]*\)\s*\.?$",
    rf"\s*[,;]\s*(?:{FUNDER}\b|(?:PD|FK|KKP|K)[\s_-]*\d{{5,6}}).*$",
    rf"(?iu)\s*[-–—,]\s*{ROLE}\.?\s*$",
    r"(?iu)\s+című\s+(?:kutatás|projekt|program)\.?\s*$",
    r"\s*\|.*$",
    r"\s+(?:19|20)\d{2}\.?$",
    r"(?iu)\s*(?:https?://|www\.)\S+\s*$",
]
# Forms of grant numbers.
GRANT = rf"(?:\b{FUNDER}\b[\s.:_-]*(?:[A-Z]{{1,4}}[\s_:-]*)?|\b(?:PD|FK|KKP|KH|NN|SNN|ANN|K)[\s_:-]*)(\d{{5,6}})\b"
GRANT_BEHIND = r"\b(\d{5,6})\s+jelű"
# Words that suggest what kind of activity a title names.
CUES = {
    "journal": r"(?iu)\bJournal\b|folyóirat", "network": r"\bNetwork\b|kutatóhálózat", "programme": r"\bProgram(?:me)?\b|Kiválósági Program|Nemzeti Laboratórium",
    "infrastructure": r"(?iu)infrastruktúr|infrastructure", "consortium": r"(?iu)konzorci|consorti", "newsletter": r"(?iu)hírlevél|newsletter",
    "research_group": r"(?iu)kutatócsoport|research group|Lendület", "database": r"(?iu)adatbázis|database|adatrepozitórium",
}
QUOTES = "„”\"'"


def strip_affixes(c: Column, passes: int = 4) -> Column:
    """The title itself: affixes are taken off in at most ``passes`` passes; what would be empty stays as it was."""
    bare = lambda x: F.trim(F.btrim(F.trim(x), F.lit(QUOTES)))
    t = bare(c)
    for _ in range(passes):
        for rule in AFFIXES:
            t = bare(F.regexp_replace(t, rule, ""))
    return F.when(t == "", c).otherwise(t)


def title_key(c: Column) -> Column:
    """Comparison key of a title without its affixes."""
    return title_fold(strip_affixes(c))


def grant_keys(c: Column) -> Column:
    """Distinct grant numbers in their context as ``grant:<digits>``: behind a funder or programme, or before "jelű"."""
    both = F.concat(F.regexp_extract_all(c, F.lit(GRANT), F.lit(1)), F.regexp_extract_all(c, F.lit(GRANT_BEHIND), F.lit(1)))
    return F.array_distinct(F.transform(both, lambda x: F.concat(F.lit("grant:"), x)))


def activity_cues(c: Column) -> Column:
    """Sorted kinds of activity whose words the text holds."""
    return F.array_sort(F.array_compact(F.array(*[F.when(c.rlike(rule), k) for k, rule in CUES.items()])))


def snippet(c: Column, limit: int = 600) -> Column:
    """Squeezed, cut to ``limit`` characters with an ellipsis."""
    s = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(F.length(s) > limit, F.concat(F.substring(s, 1, limit - 1), F.lit("…"))).otherwise(s)


# E-mail addresses, phone numbers with a prefix, behind a label, and with an area code.
EMAIL = r"[A-Za-z0-9._%+-]+@([A-Za-z0-9.-]+\.[A-Za-z]{2,})"
PHONE = r"(?:\(?\+\s?36\)?|\b0036|\b06)[0-9 ()/-]{6,}[0-9]"
LABELLED = r"(?iu)(\b(?:telefonszám|telefon|tel|mobil|fax)\b\.?\s*:?\s*)[+(]?[0-9][0-9 ()/.–-]{3,}[0-9]"
AREA = r"\([0-9]{1,2}\)\s?[0-9]{3}\s[0-9]{4}\b|\b[0-9]{1,2}/[0-9]{3}[\s-][0-9]{3,4}\b"


def scrub(c: Column) -> Column:
    """Masks the name of e-mail addresses and phone numbers in their four forms."""
    s = F.regexp_replace(F.regexp_replace(c, EMAIL, "xxx@$1"), PHONE, "XXX")
    return F.regexp_replace(F.regexp_replace(s, LABELLED, "$1XXX"), AREA, "XXX")


def trigrams(c: Column) -> Column:
    p = F.concat(F.lit("  "), c, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substr(p, i, F.lit(3))))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two sets; null if both are empty."""
    return F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


def search_score(query: str, name: Column) -> Column:
    """0 to 1: every word of the query must be met by an equal word (1), a word it
    begins (.85) or a similar one (.8 of the trigram similarity from .45 on)."""
    key = title_fold(name)
    words = F.split(key, " ")

    def word(q: str) -> Column:
        like = lambda w: jaccard(trigrams(w), trigrams(F.lit(q)))
        near = F.transform(words, lambda w: F.when(w == q, 1.0).when(F.startswith(w, F.lit(q)), 0.85).when((F.lit(len(q)) >= 4) & (like(w) >= 0.45), 0.8 * like(w)).otherwise(0.0))
        return F.array_max(near)

    scores = [word(q) for q in query.split(" ")]
    total = reduce(lambda a, b: a + b, scores) / len(scores)
    met = reduce(lambda a, b: a & b, [s > 0 for s in scores])
    return F.when(~met, 0.0).when(F.instr(key, query) > 0, total).otherwise(total * 0.9)


def initials_compatible(a: Column, b: Column) -> Column:
    """Two name keys with the same surname: each other word of the shorter one fits, in
    order, a word of the longer one, as the whole word or by its initial. Equal keys do not count."""
    x, y = F.split(a, " "), F.split(b, " ")
    rest = lambda w: F.slice(w, F.lit(2), F.size(w))
    turn = F.size(x) <= F.size(y)
    short, long = F.when(turn, rest(x)).otherwise(rest(y)), F.when(turn, rest(y)).otherwise(rest(x))
    # the index behind the last fitted word; null once a word found none
    fits = lambda s, t: (s == t) | ((F.length(s) == 1) & F.startswith(t, s)) | ((F.length(t) == 1) & F.startswith(s, t))
    place = lambda at, s: F.array_min(F.filter(F.transform(long, lambda t, i: F.when((i >= at) & fits(s, t), i + 1)), lambda v: v.isNotNull()))
    end = F.aggregate(short, F.lit(0), lambda at, s: place(at, s))
    return (a != b) & (x[0] == y[0]) & (F.size(x) > 1) & (F.size(y) > 1) & end.isNotNull()
