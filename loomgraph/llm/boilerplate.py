"""Main body of web pages.

A page streams through the standard library's HTML parser, whose events give
each line its text and its tags. Text of a page that was flattened before has no
tags left; there the traces of links count in their place: separators of menus
and paths. The text-to-tag ratio per line is smoothed by a Gaussian, and a
two-means threshold over the page's own ratios splits lines into dense content
and the rest.

The ratio alone cannot keep a heading, a list or the entries of a listing, nor
drop a teaser that is a full sentence. So the dense regions of all pages teach
which lines belong to the site's template (``templates``): those that recur
outside of them. A page's own title anchors the body's start, template lines end
blocks, and the ratio decides how far a block of teasers reaches into the body
and, on pages without title or path, where the body begins. A fixed vocabulary
of common furniture stands in where the corpus has seen a line too seldom.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping
from functools import lru_cache
from html.parser import HTMLParser
from unicodedata import is_normalized, normalize

import pyarrow as pa
from pyspark.sql import DataFrame

from loomgraph.llm.templates import HEADER_FLAG, with_flags

# Furniture vocabulary of research sites in Hungarian, English and German.
MENU = {
    "Adatbázisok", "Belépés", "Bemutatkozás", "Doktori képzés", "Események", "Futó kutatások", "Hírek", "Igazgatóság", "Intézet",
    "Kapcsolat", "Kezdőlap", "Kutatások", "Kutatók", "Könyvtár", "Közérdekű adatok", "Lezárt kutatások", "Oldaltérkép", "Projektek",
    "Publikációk", "Pályázatok", "Sajtó",
    "About us", "Completed research", "Contact", "Databases", "Doctoral training", "Events", "Grants", "Home", "Library", "Log in",
    "Management", "News", "Ongoing research", "Press", "Projects", "Public information", "Publications", "Research", "Researchers", "Sitemap",
    "Aktuelles", "Anmelden", "Bibliothek", "Forschende", "Impressum", "Institut", "Kontakt", "Presse", "Projekte", "Publikationen",
    "Startseite", "Veranstaltungen", "Datenschutz", "Forschung",
}
CONTROLS = {
    "Keresés…", "Search…", "Suche…", "HU", "EN", "DE", "HU | EN", "Magyar / English", "Deutsch / English", "DE | EN", "Megosztás", "Share", "Teilen",
    "Elfogadom", "Rendben", "Beállítások", "Csak a szükségesek", "Accept all", "Only necessary", "Settings", "OK", "Akzeptieren", "Ablehnen", "Einstellungen",
    "Nur notwendige", "Alle akzeptieren", "Tovább »", "Read more »", "Mehr »", "Nyomtatóbarát változat", "Printer-friendly version", "Druckversion",
    "Vissza a lap tetejére", "Back to top", "Nach oben", "Iratkozzon fel hírlevelünkre!", "Subscribe to our newsletter!", "Abonnieren Sie unseren Newsletter!",
}
NOTICES = {
    "404", "A keresett oldal nem található.", "Hiba történt.", "Page not found.", "An error occurred.", "Seite nicht gefunden.", "Ein Fehler ist aufgetreten.",
}
MORE = {"Tovább »", "Read more »", "Mehr »"}
RELATED = {"Kapcsolódó tartalmak", "Related content", "Ähnliche Inhalte"}
LATEST = {"Legfrissebb híreink", "Latest news", "Neuigkeiten"}
FURNITURE = re.compile(
    r"(?:Utolsó frissítés|Last updated|Zuletzt geändert|Frissítve|Aktualisiert): ?[\d./ -]+$"
    r"|(?:Megtekintések száma|Views|Aufrufe): ?\d+$"
    r"|(?:Címkék|Tags|Schlagwörter|Schlagworte): "
    r"|(?:Megosztás|Share|Teilen): "
    r"|(?:Ön itt áll|You are here|Sie sind hier): "
    r"|(?:Cím|Address|Adresse): ?\d{4} .*\d+\.$"
    r"|(?:Telefon|Phone|Tel\.?): ?[+\d]"
    r"|Copyright ©|©"
    r"|(?:Ez az oldal|Weboldalunk|A honlap) .*\b(?:sütiket|cookie-kat).* (?:használ|alkalmaz)\b.*(?:érdekében|céljából|működéshez és statisztikához)\."
    r"|(?:This page|This site|Our website) (?:uses|stores) cookies\b"
    r"|(?:Unsere Website|Diese Seite) (?:verwendet|speichert) Cookies\b"
    r"|A böngészés folytatásával Ön elfogadja ezt\.$|A beállításokat bármikor módosíthatja\.$|További részletek az Adatkezelési tájékoztatóban\.$"
    r"|By continuing you agree to this\.$|You may change your settings at any time\.$|Read more in our privacy notice\.$"
    r"|Mit der Nutzung stimmen Sie zu\.$|Mehr dazu in der Datenschutzerklärung\.$|Sie können die Einstellungen jederzeit ändern\.$"
)
ADDRESS = re.compile(r".* · \d{4} .* · \S+@\S+$")
SITE = re.compile(r"[A-Z]{2,4} \S.* (?:Intézet|Institute|Institut)$")
DAY = re.compile(r"\d{4}-\d{2}-\d{2}$")
SUBHEAD = re.compile(
    r"(?:\d+(?:\.\d+)*\.? )?(?:Bemutatás|Kutatási területek|Válogatott publikációk|Introduction|Research areas|Selected publications"
    r"|Vorstellung|Arbeitsgebiete|Ausgewählte Publikationen)$"
)
ITEM = re.compile(r"(?:[-–—•*·▪]|\d{1,3}[.)]|[a-z]\))\s")
SENTENCE_END = re.compile(r"[.!?…。！？।؟][\"'”’»)\]）」』]*$")
INNER_END = re.compile(r"[.!?…][\"'”’»)\]]*\s+[^\sa-záéíóöőúüű\d]|[。！？।؟]")
ARROW = re.compile(r"[»›→]$")
SEPARATORS = re.compile(r" [|·›»/] |\s{2,}")

#: Gaussian smoothing of the ratios: standard deviation in lines and its reach.
SIGMA, REACH = 1.0, 2
KERNEL = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-REACH, REACH + 1)]


class LineEvents(HTMLParser):
    """Text length and tag count of each line, from parser events."""

    SKIP = {"script", "style"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.texts: list[list[str]] = [[]]
        self.tags: list[int] = [0]
        self.skipping = 0

    def handle_starttag(self, tag, attrs):
        self.tags[-1] += 1
        self.skipping += tag in self.SKIP

    def handle_endtag(self, tag):
        self.tags[-1] += 1
        self.skipping -= tag in self.SKIP and self.skipping > 0

    def handle_data(self, data):
        first, *rest = data.split("\n")
        if not self.skipping:
            self.texts[-1].append(first)
        for part in rest:
            self.texts.append([] if self.skipping else [part])
            self.tags.append(0)

    def handle_entityref(self, name):
        self.texts[-1].append(f"&{name};")

    def handle_charref(self, name):
        self.texts[-1].append(f"&#{name};")


def page_lines(text: str) -> tuple[list[str], list[int]]:
    """Lines of the text and their tag counts; markup is streamed, plain text split."""
    if "<" not in text:
        lines = text.split("\n")
        return lines, [0] * len(lines)
    parser = LineEvents()
    parser.feed(text)
    parser.close()
    lines = ["".join(p) for p in parser.texts]
    if len(lines) != text.count("\n") + 1:  # line breaks inside a tag or comment
        lines = text.split("\n")
        return lines, [len(re.findall(r"<[a-zA-Z/!][^>]*>", x)) for x in lines]
    return lines, parser.tags


def density(ratio: list[float]) -> tuple[list[float], float]:
    """Smoothed text-to-tag ratio of each line and the page's threshold."""
    n = len(ratio)
    smooth = []
    for i in range(n):
        lo, hi = max(0, i - REACH), min(n, i + REACH + 1)
        weights = KERNEL[lo - i + REACH : hi - i + REACH]
        smooth.append(sum(w * r for w, r in zip(weights, ratio[lo:hi])) / sum(weights))
    low, high = 0.0, max(smooth, default=0.0)
    for _ in range(8):  # two-means on one axis
        mid = (low + high) / 2
        below, above = [x for x in smooth if x <= mid], [x for x in smooth if x > mid]
        if not below or not above:
            break
        low, high = sum(below) / len(below), sum(above) / len(above)
    return smooth, (low + high) / 2


def is_menu(line: str) -> bool:
    if line in MENU:
        return True
    parts = [p for p in re.split(r" [|·] |\s{2,}", line) if p]
    return len(parts) > 1 and all(p in MENU for p in parts)


@lru_cache(maxsize=65_536)
def is_furniture(line: str) -> bool:
    """Furniture by vocabulary alone, wherever it stands (teaser blocks aside)."""
    return (
        line in CONTROLS or line in NOTICES or line in RELATED or line in LATEST or is_menu(line) or bool(SITE.match(line))
        or bool(FURNITURE.match(line)) or (" · " in line and bool(ADDRESS.match(line)))
    )


def compose(s: str) -> str:
    """Composed accents, no soft hyphens."""
    return s if s.isascii() else (s if is_normalized("NFC", s) else normalize("NFC", s)).replace("\u00ad", "")


def _squeeze(s: str) -> str:
    """Composed, with single spaces."""
    return re.sub(r"\s+", " ", compose(s)).strip()


def title_forms(page_title: str | None) -> set[str]:
    """What the title may say about the page itself, with site names cut off."""
    if not page_title or not page_title.strip():
        return set()
    t = _squeeze(page_title)
    forms = {t}
    for sep in (" | ", " – ", " - ", " — ", " :: ", " · ", " » "):
        if sep in t:
            forms |= {t.rsplit(sep, 1)[0], t.split(sep, 1)[1]}
    return {f.casefold() for f in forms if f and not SITE.match(f)}


def path_lines(lines: list[str], folded: list[str]) -> dict[int, str]:
    """index -> tail of the lines that show the way to the page: parts parted by › or /,
    the last of which begins one of the next lines, or the first of which is a menu's."""
    out: dict[int, str] = {}
    for i, x in enumerate(lines):
        if "›" in x or " / " in x:
            tail = re.split(r"›| / ", x)[-1].strip().rstrip("….").casefold()
            near = [y for y in folded[i + 1 : i + 8] if y]
            if len(tail) > 2 and (any(y.startswith(tail) for y in near[:5]) or x.split(" / ")[0] in MENU):
                out[i] = tail
    return out


class Page:
    """One page with what is known of its lines: ``template`` has the learned flag of a line index;
    None while it is being learned, when the bare text-to-tag ratio speaks alone."""

    def __init__(self, text: str, page_title: str | None, template: Mapping[int, int] | None = None):
        raw, tags = page_lines(compose(text))
        self.lines = [" ".join(x.split()) if "  " not in (y := x.strip()) else y for x in raw]
        self.folded = [(x if "  " not in x else " ".join(x.split())).casefold() for x in self.lines]
        self.template = {} if template is None else template
        self.title = title_forms(page_title)
        self.paths = path_lines(self.lines, self.folded)
        self.links = [t + len(SEPARATORS.findall(x)) for x, t in zip(self.lines, tags)]
        links = lambda i: i in self.template or (template is not None and is_furniture(self.lines[i]))
        self.smooth, self.threshold = density([0.0 if links(i) else len(x) / max(1, k) for i, (x, k) in enumerate(zip(self.lines, self.links))])

    def furniture(self, i: int) -> bool:
        return i in self.template or i in self.paths or is_furniture(self.lines[i])

    def header(self, i: int) -> bool:
        """Does the line head a block of teasers?"""
        return bool(self.template.get(i, 0) & HEADER_FLAG) or self.lines[i] in RELATED or self.lines[i] in LATEST

    def more(self, i: int) -> bool:
        """A link to the rest of a teaser."""
        return self.lines[i] in MORE or (i in self.template and bool(ARROW.search(self.lines[i])))

    def titled(self) -> int | None:
        """Index of the line that repeats the page's title. Where several parts of the title
        are met, the lowest: the page's own part stands below the site's."""
        first: dict[str, int] = {}
        if self.title:
            for i, x in enumerate(self.folded):
                if x in self.title:
                    first.setdefault(x, i)
        return max((i for i in first.values() if i not in self.template), default=None)

    def heading(self) -> int | None:
        """Index of the page's own heading, or of the first body line; None if there is no body."""
        at = self.titled()
        if at is not None:
            return at
        for tail in self.paths.values():
            for i, x in enumerate(self.folded):
                if x.startswith(tail) and not self.furniture(i):
                    return i
        if any(x in NOTICES for x in self.lines):
            return None
        block = False
        for i, x in enumerate(self.lines):
            if not x:
                block = False
            elif self.header(i):
                block = True
            elif not self.furniture(i) and (not block or (self.smooth[i] > self.threshold and SENTENCE_END.search(x))):
                return i
        return None

    def latest(self, i: int) -> bool:
        """Are the teasers below header i dated or linked news, not bare titles?"""
        if self.lines[i] in LATEST:
            return True
        if self.lines[i] in RELATED:
            return False
        below = range(i + 1, min(i + 4, len(self.lines)))
        return any(DAY.match(self.lines[j]) or self.more(j) for j in below)

    def teaser_end(self, i: int) -> int:
        """First line behind the block of teasers whose header is line i."""
        lines, n, j = self.lines, len(self.lines), i + 1
        ends = lambda k: self.furniture(k) or SUBHEAD.match(lines[k]) or ITEM.match(lines[k])
        if not self.latest(i):
            while j < n and lines[j] and not ends(j):
                if SENTENCE_END.search(lines[j]) or (self.smooth[j] > self.threshold and len(lines[j]) > 150):
                    break
                j += 1
            return j
        while j < n and lines[j]:
            if self.more(j) or DAY.match(lines[j]):
                j += 1
            elif ends(j):
                break
            elif (j + 1 < n and self.more(j + 1)) or DAY.match(lines[j - 1]) or j == i + 1 or (lines[j].endswith("…") and len(lines[j]) <= 60):
                j += 1
            else:  # neither date nor link: a teaser if nothing of the body follows before the block's end
                k = j
                while k < n and lines[k] and (self.more(k) or not self.furniture(k)):
                    if SUBHEAD.match(lines[k]) or ITEM.match(lines[k]) or (INNER_END.search(lines[k]) and not lines[k].endswith("…")):
                        return j
                    k += 1
                j += 1
        return j

    def body(self) -> list[int]:
        """Numbers (from 1) of the main body's lines."""
        start = self.heading()
        if start is None:
            return []
        out, i = [], start
        while i < len(self.lines):
            if i > start and self.header(i):
                i = self.teaser_end(i)
                continue
            if self.lines[i] and (i == start or not self.furniture(i)):
                out.append(i + 1)
            i += 1
        return out


def body_lines(text: str | None, page_title: str | None, template: Mapping[int, int] | None = None) -> list[int]:
    """Numbers (from 1) of the main body's lines; [] for null, empty and blank texts.

    Blank lines count but are never in the result. A page that holds an error
    notice in place of a body has no lines. Very long pages take time linear in
    their length. ``template``: line index -> flag of lines the corpus shows to be furniture.
    """
    if not text or not text.strip():
        return []
    return Page(text, page_title, template or {}).body()


def read_page(text: str, page_title: str | None) -> tuple:
    """What ``templates`` asks of a page."""
    page = Page(text, page_title)
    return page.lines, page.folded, page.smooth, page.threshold, page.titled(), page.paths, page.links


def main_body(pages: DataFrame, key: str = "doc_id", text: str = "text", title: str = "page_title") -> DataFrame:
    """(key, line_no int): a row for each main-body line of each page.

    Only the three columns are read. Repeated rows give repeated results; pages
    without a body and empty tables give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, numbers = [], []
            ids, texts, titles, flags = batch.columns
            for k, t, p, f in zip(ids.to_pylist(), texts, titles, flags):
                template = {x["i"]: x["flag"] for x in f.as_py() or ()}
                found = body_lines(t.as_py(), p.as_py(), template)
                keys += [k] * len(found)
                numbers += found
            yield pa.RecordBatch.from_arrays([pa.array(keys, ids.type), pa.array(numbers, pa.int32())], names=[key, "line_no"])

    src = pages.select(f"`{key}`", f"`{text}`", f"`{title}`")
    known = with_flags(src, key, text, title, read_page)
    return known.mapInArrow(run, f"`{key}` {src.schema[0].dataType.simpleString()}, line_no int")
