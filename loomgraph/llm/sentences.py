"""Sentence boundaries across languages and scripts, disambiguated by document.

A period may end a sentence, an abbreviation or both. What a word does is read
from its unambiguous occurrences elsewhere in the same document: before a lower
case word or a comma its period is an abbreviation's, at the end of a block it
ends a sentence. Where the document is silent, counts over the whole corpus
decide: a short word whose period never closes a block is an abbreviation. A
capitalised word met inside sentences is a proper name and no sign of a start.
Scripts bring their own terminators: full-width ones need no space, the danda
and the Arabic question mark always end, and in Thai a space ends a unit.

Quotations are closed units of text: nothing ends inside them, and a clause that
reports them belongs to them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from unicodedata import combining as unicombining
from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.skew import salted_join
from loomgraph.session import cut, spread

#: Longest word that may be an abbreviation.
LONGEST = 6
#: A corpus abbreviation: at least so often seen, and of so many periods at most one closes a block.
SEEN, RARE_END = 15, 200
#: Up to so many corpus abbreviations go to every task as one list (about 30 MB); more are joined to the documents that use them.
LIST_LIMIT = 1_000_000

# Abbreviations assumed where document and corpus are silent.
SEED = set(
    "dr prof özv ifj id ún kb ld pl vö sz old fej kiad szerk mr mrs ms st no fig vol ed eds al vs cf pp ch eg ie vgl abb bzw ges nr hrsg sog ca"
    " chap см рис гл стр тел ул डॉ श्री د".split()
)

FULL = "。！？"
ENDS = re.compile(r"[.!?…。！？।؟]+")
PAIRS = {"„": "“”\"", "“": "”", "«": "»", "「": "」", "『": "』", "‚": "‘"}
QUOTED = re.compile(r"[„“”«»「」『』\"()（）\[\]]")
CLOSERS = set("\"”“»」』)）]’'")
DASHES = set("–—-,;:·|›/")
LETTER = r"[^\W\d_][\u0300-\u036f\u00ad\u0900-\u0903\u093a-\u094f\u200d]*"
WORD = re.compile(rf"(?:{LETTER})+$")
PERIOD = re.compile(r"\.(?![.…\w])(\s*)")
MARKS = "\u00ad\u200d\u093e\u0940\u0949\u094b\u094c"
QUOTATION = re.compile(r"[„“«\"][^„“”«»\"\n]*(?:\n(?!\s*\n)[^„“”«»\"\n]*)*[“”»\"]")
NUMBER = re.compile(r"(?<![^\s(])[\d.,/–-]*\d$")
ROMAN = re.compile(r"[IVXLC]+$")
ORDINAL = re.compile(r"(?:^|[\s(])(?:[Ii]m|[Aa]m|[Vv]om|[Zz]um|[Zz]ur|[Bb]eim|[Ii]ns|[Dd]er|[Dd]ie|[Dd]as|[Dd]en|[Dd]em|[Dd]es|[Aa]z?)\s+\d{1,3}$")
BLANK = re.compile(r"\n[^\S\n]*\n\s*")
BULLET = re.compile(r"\n(?=[^\S\n]*[•*▪]\s)")
THAI_GAP = re.compile(r"(?<=[฀-๿\d)”\"])\s+(?=[฀-๿])")
THAI = re.compile(r"[฀-๿]")
NO_SPACE = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]")


def blocks(text: str, by_line: bool) -> Iterator[tuple[int, int]]:
    """Spans that no sentence leaves: lines of pages, else stretches between blank lines.
    A lone carriage return counts as a line break, one before a line feed as a space."""
    if "\r" in text:
        text = re.sub(r"\r(?!\n)", "\n", text).replace("\r", " ")
    at = 0
    if by_line:
        while True:
            to = text.find("\n", at)
            if to < 0:
                break
            yield at, to
            at = to + 1
        yield at, len(text)
        return
    cuts = [(m.start(), m.end()) for m in BLANK.finditer(text)]
    if "•" in text or "*" in text or "▪" in text:
        cuts = sorted(cuts + [(m.start(), m.end()) for m in BULLET.finditer(text)])
    for a, b in cuts:
        if a >= at:
            yield at, a
            at = b
    yield at, len(text)


def spans(s: str) -> dict[int, int]:
    """close -> open of the quotations and brackets of a block; unpaired marks are ignored."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    for m in QUOTED.finditer(s):
        c, i = m.group(), m.start()
        k = next((k for k in range(len(stack) - 1, -1, -1) if c in stack[k][0]), None)
        if k is not None and not (c == '"' and stack[k][0] != '"' and i + 1 < len(s) and s[i + 1].isalnum()):
            out[i] = stack[k][1]
            del stack[k:]
        elif c == '"':
            stack.append(('"', i))
        elif c in PAIRS:
            stack.append((PAIRS[c], i))
        elif c in "(（[":
            stack.append((")）" if c != "[" else "]", i))
    if stack and s.endswith("…"):  # cut off inside a quotation
        out[len(s)] = stack[0][1]
    return out


def follower(s: str, k: int) -> str:
    """What starts at k: cont, lower, digit, start or end."""
    n, j = len(s), k
    while j < n:
        c = s[j]
        if c.isalpha():
            if c.islower() and not (j + 1 < n and s[j + 1].isupper()):
                return "lower"
            return "start"
        if c.isdigit():
            return "digit"
        if j == k and c in DASHES:
            return "cont"
        j += 1
    return "end" if k >= n else "cont"


def plain(word: str) -> str:
    """A word with composed accents and without soft hyphens."""
    return word if word.isascii() else normalize("NFC", word).replace("\u00ad", "")


def word_counts(text: str, by_line: bool) -> Counter:
    """(word, kind) counts: inner (abbreviation for certain), final (sentence end for certain), open.

    Periods inside quotations count for nothing: no unit ends there.
    """
    out: Counter = Counter()
    if "." not in text:
        return out
    if "\r" in text:
        text = re.sub(r"\r(?!\n)", "\n", text).replace("\r", " ")
    text = QUOTATION.sub("X", text)
    for m in PERIOD.finditer(text):
        a = m.start()
        i, letters = a, 0
        while i and letters <= LONGEST:
            c = text[i - 1]
            if c.isalpha():
                letters += 1
            elif not (c in MARKS or unicombining(c)):
                break
            i -= 1
        if 0 < letters <= LONGEST:
            kind = period_kind(text, m, by_line)
            if kind:
                out[plain(text[i:a]), kind] += 1
    return out


def period_kind(text: str, m: re.Match, by_line: bool) -> str:
    """What the period matched by PERIOD says: inner, final or open; "" before a closing mark."""
    k, gap = m.end(), m.group(1)
    if k >= len(text) or (("\n" in gap) if by_line else gap.count("\n") > 1):
        return "final"
    if text[k] in ")”“\"»":
        return ""
    f = follower(text, k)
    return "inner" if f == "lower" or f == "cont" else "open"


class Splitter:
    """Splits texts, given the abbreviations of the corpus and the words on which it is not silent."""

    def __init__(self, abbreviations: set[str], heard: set[str]):
        self.abbreviations, self.heard = abbreviations, heard

    def split(self, text: str | None, by_line: bool) -> list[tuple[int, int]]:
        """Code-point spans of the sentence units; [] for null, empty and blank texts."""
        if not text or text.isspace():
            return []
        self.text, self.by_line, self.own = text, by_line, {}
        quoted, thai = QUOTED.search(text) is not None, THAI.search(text) is not None
        out: list[tuple[int, int]] = []
        for a, b in blocks(text, by_line):
            s = text[a:b]
            stripped = s.strip()
            if not stripped:
                continue
            a += len(s) - len(s.lstrip())
            s = stripped
            cuts = self.cuts(s, quoted)
            if thai:
                cuts = sorted({*cuts, *(m.start() for m in THAI_GAP.finditer(s))})
            at = 0
            for c in [*cuts, len(s)]:
                while at < c and s[at].isspace():
                    at += 1
                to = c
                while to > at and s[to - 1].isspace():
                    to -= 1
                if to > at:
                    out.append((a + at, a + to))
                at = c
        return out

    def cuts(self, s: str, quoted: bool) -> list[int]:
        """Positions in the block behind which a new unit begins."""
        closes = None
        n, start, out, last = len(s), 0, [], 0
        for m in ENDS.finditer(s):
            a, e = m.span()
            if a < last or e >= n:
                continue
            if closes is None:
                closes = spans(s) if quoted else {}
                inside = [(o, c) for c, o in closes.items()]
            quote = None
            if closes:
                while e < n:
                    k = e + 1 if s[e].isspace() and e + 1 < n and s[e + 1] == "»" else e
                    if k in closes:
                        quote, e = closes[k], k + 1
                    else:
                        break
                if any(o < a and e <= c for o, c in inside):
                    continue
            k = e
            while k < n and s[k].isspace():
                k += 1
            if k >= n:
                break
            if self.ends(s, a, m.end(), e, k, quote, start):
                out.append(e)
                start, last = k, e
        return out

    def ends(self, s: str, a: int, b: int, e: int, k: int, quote: int | None, start: int) -> bool:
        """Does the terminator at [a, b), with closing marks up to e, end the unit that began at start?"""
        mark, spaced, kind = s[b - 1], k > e, follower(s, k)
        if kind == "cont":
            return False
        if quote is not None and s[quote] not in "(（[":
            return self.quote_ends(s, quote, k, spaced, kind, start)
        if quote is not None:  # a bracket: by itself, or at the end of its sentence
            return kind in ("start", "digit") and (not any(map(str.isalnum, s[start:quote])) or mark not in ".") and (spaced or mark in FULL)
        if mark in FULL or mark in "।":
            return True
        if mark == "؟":
            return True
        if mark in "!?":
            if spaced:
                return kind != "lower"
            return s[k].isupper() or s[k] in PAIRS or bool(NO_SPACE.match(s[k]))
        if mark == "…" or b - a > 1:
            return spaced and kind == "start"
        if not spaced:  # a missing space: a word in lower case, a period, a capitalised word
            return a >= 2 and s[a - 1].islower() and s[a - 2].islower() and s[k].isupper() and k + 1 < len(s) and s[k + 1].islower()
        if kind == "lower":
            return False
        head = s[max(start, a - 24) : a]
        number = NUMBER.search(head)
        if number:
            if kind == "digit" or not s[start : a - len(number.group())].strip("([„“\"«"):
                return False
            return not ORDINAL.search(head)
        word = WORD.search(head)
        if word is None:
            return True
        w = plain(word.group())
        if len(w) > LONGEST:
            return True
        if len(w) == 1 and w.isupper() or ROMAN.match(w):
            return False
        return not self.is_abbreviation(word.group(), s, k)

    def quote_ends(self, s: str, quote: int, k: int, spaced: bool, kind: str, start: int) -> bool:
        """A quotation that ends with its own terminator: does a reporting clause follow?"""
        if kind == "lower":
            return False
        c = s[k]
        if c.isalpha() and not c.isupper() and not c.islower():  # scripts without case
            return quote != start and (s[:quote].rstrip()[-1:] in ":：，," or c not in "とっ")
        return True

    def evidence(self, raw: str) -> tuple[int, int]:
        """How often the document shows the word as abbreviation and as sentence end for certain."""
        if raw not in self.own:
            inner = final = 0
            at, text, dotted = 0, self.text, raw + "."
            while (at := text.find(dotted, at)) >= 0:
                m = PERIOD.match(text, at + len(raw)) if not at or not (text[at - 1].isalpha() or unicombining(text[at - 1])) else None
                kind = period_kind(text, m, self.by_line) if m else ""
                inner += kind == "inner"
                final += kind == "final"
                at += len(dotted)
            self.own[raw] = inner, final
        return self.own[raw]

    def is_abbreviation(self, raw: str, s: str, k: int) -> bool:
        w = plain(raw)
        inner, final = self.evidence(raw)
        if inner and not final:
            return True
        if final and not inner:
            return False
        if not final:
            return w in self.abbreviations or (w not in self.heard and w.casefold() in SEED)
        follows = re.match(r"[^\W\d_]+", s[k:])  # both: a proper name behind it is no start of a sentence
        if follows and w in self.abbreviations:
            name = follows.group()
            return bool(re.search(r"[^\W\d_A-Z][,]? " + re.escape(name) + r"\b", self.text)) and name.lower() not in self.text
        return False


def corpus_words(texts: DataFrame, text: str = "text", path: str = "raw_path") -> DataFrame:
    """(word, n_inner, n_final, n_all) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for t, p in zip(batch.column(0), batch.column(1)):
                t = t.as_py()
                if t:
                    counts.update(word_counts(t, p.as_py()))
            if len(counts) > 200_000:  # what a task holds stays bounded
                yield _counted(counts)
                counts = Counter()
        yield _counted(counts)

    src = texts.select(F.col(text).alias("t"), F.col(path).isNotNull().alias("p"))
    parts = spread(src, "t").mapInArrow(run, "word string, i bigint, f bigint, o bigint")
    return parts.groupBy("word").agg(F.sum("i").alias("n_inner"), F.sum("f").alias("n_final"), F.sum(F.col("i") + F.col("f") + F.col("o")).alias("n_all"))


def _counted(counts: Counter) -> pa.RecordBatch:
    words = sorted({w for w, _ in counts})
    kinds = [pa.array([counts[w, k] for w in words], pa.int64()) for k in ("inner", "final", "open")]
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *kinds], names=["word", "i", "f", "o"])


def corpus_abbreviations(words: DataFrame) -> tuple[DataFrame, set[str]]:
    """(word) of the corpus abbreviations, cut, and the case forms of SEED on which the corpus is not silent.

    The evidence is absolute: a word seen at least SEEN times counts, however
    large the corpus. What was seen less often is left to SEED.
    """
    judged = cut(words.filter(F.col("n_all") >= SEEN).select("word", (F.col("n_final") * RARE_END < F.col("n_all")).alias("abbreviation")))
    heard = {r["word"] for r in judged.filter(F.lower("word").isin(*sorted(SEED))).collect()}  # case forms of SEED only
    return judged.filter("abbreviation").select("word"), heard


def dotted_words(text: str) -> set[str]:
    """The short words of a text that stand before a period."""
    out = set()
    for m in PERIOD.finditer(text):
        word = WORD.search(text[max(0, m.start() - 24) : m.start()])
        if word and len(w := plain(word.group())) <= LONGEST:
            out.add(w)
    return out


def own_abbreviations(texts: DataFrame, abbreviations: DataFrame, key: str, text: str) -> DataFrame:
    """(key, _own): the corpus abbreviations that each text uses, by a join on the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, words = [], []
            for i, t in enumerate(batch.column(1)):
                found = sorted(dotted_words(t.as_py() or ""))
                rows += [i] * len(found)
                words += found
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(words, pa.string())], names=[key, "word"])

    src = texts.select(f"`{key}`", f"`{text}`")
    used = spread(src, key).mapInArrow(run, f"`{key}` {src.schema[0].dataType.simpleString()}, word string")
    return salted_join(used, abbreviations, "word", "left_semi").groupBy(key).agg(F.collect_set("word").alias("_own"))


def sentence_units(texts: DataFrame, key: str = "doc_id", text: str = "text", path: str = "raw_path", list_limit: int = LIST_LIMIT) -> DataFrame:
    """(key, sent_start int, sent_end int): the sentence units of every whole text.

    Where ``path`` is not null each line break ends a unit, elsewhere a blank
    line does. Offsets count code points from 0, end exclusive. Null, empty and
    blank texts have none; repeated rows repeat theirs. Only three columns are
    read. More than ``list_limit`` corpus abbreviations are joined by ``key``,
    which must be unique then; the result is the same.
    """
    abbreviations, heard = corpus_abbreviations(corpus_words(texts, text, path))
    src = texts.select(f"`{key}`", f"`{text}`", F.col(path).isNotNull().alias("_web"))
    common: set[str] | None = None
    if abbreviations.count() <= list_limit:
        common = {r["word"] for r in abbreviations.collect()}
    else:
        src = src.join(own_abbreviations(texts, abbreviations, key, text), key, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(common or set(), heard)
        for batch in batches:
            ids = batch.column(0)
            for at in range(0, batch.num_rows, 1024):
                rows, starts, ends = [], [], []
                for i in range(at, min(at + 1024, batch.num_rows)):
                    if common is None:
                        splitter.abbreviations = set(batch.column(3)[i].as_py() or ())
                    found = splitter.split(batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
                    rows += [i] * len(found)
                    starts += [x for x, _ in found]
                    ends += [x for _, x in found]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=[key, "sent_start", "sent_end"])

    return spread(src, key).mapInArrow(run, f"`{key}` {src.schema[0].dataType.simpleString()}, sent_start int, sent_end int")
