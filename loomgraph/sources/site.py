"""Pages of research sites to records and claims.

One streaming parser pass gives a row for each line of text and each link, with
the heading it stands under and whether it lies in the page's main region. What
follows is relational: sections, header lines, listings, labelled values, and
the claims that profiles, units and projects state.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import dates, text, urls
from loomgraph.operators.canonical import stable_key
from loomgraph.sources.stores import Adapter, adapter

# Headings of profile, project and unit pages in Hungarian and English, words of leaders, links to further pages, labels of project fields.
AREAS = "(?iu)kutatási terület|research area"
PROJECTS = "(?iu)^(futó |lezárt )?(projektek|kutatások)|^projects"
LEADER = "(?iu)vezető|igazgató|head|director"
FURTHER = "(?iu)^(következő|tovább|next|older|›|»|>)"
LABELS = {"vezető": "lead", "kutatásvezető": "lead", "principal investigator": "lead", "időtartam": "period", "period": "period", "támogató": "funding_body", "funder": "funding_body", "azonosító": "grant_id", "grant": "grant_id", "státusz": "status_label", "status": "status_label"}
# How far a stated fact is trusted by what states it.
CONFIDENCE = {"name": 0.95, "degree": 0.9, "external_profile": 0.8, "listing": 0.85, "participation": 0.85, "member": 0.85, "field": 0.95}
CONTACT = r"(?is)<(script|noscript|iframe)\b.*?</\1\s*>|<!--.*?-->"

BREAKS = {"p", "li", "td", "th", "tr", "div", "section", "article", "ul", "ol", "table", "dd", "dt", "br", "main", "nav", "header", "footer", "aside", "body"}
HEADS = {"h1", "h2", "h3", "h4"}
SKIP = {"script", "style", "noscript"}
LINES = "kind string, level int, section string, main boolean, position int, content string, href string"


class _Lines(HTMLParser):
    """(kind, level, section, main, content, href): kind title, heading, line or link; broken markup never fails."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple] = []
        self.buffer: list[str] = []
        self.section: str | None = None
        self.head, self.muted, self.main, self.depth, self.title = None, 0, 0, 0, False
        self.link: list | None = None

    def flush(self) -> None:
        content = " ".join("".join(self.buffer).split())
        self.buffer = []
        if not content:
            return
        if self.title:
            self.rows.append(("title", None, None, False, content, None))
        elif self.head:
            self.section = content if self.head != "h1" else self.section
            self.rows.append(("heading", int(self.head[1]), self.section, self.main > 0, content, None))
        else:
            self.rows.append(("line", None, self.section, self.main > 0, content, None))

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in SKIP:
            self.muted += 1
        if tag in BREAKS or tag in HEADS or tag == "title":
            self.flush()
        if self.main or tag == "main" or a.get("role") == "main" or a.get("id") in ("content", "main"):
            self.main += tag not in ("br", "img", "input", "hr", "meta", "link")
        if tag in HEADS:
            self.head = tag
        self.title = self.title or tag == "title"
        if tag == "a":
            self.link = [a.get("href"), a.get("rel"), len(self.buffer)]

    def handle_endtag(self, tag):
        if tag in SKIP:
            self.muted = max(0, self.muted - 1)
        if tag == "a" and self.link:
            href, rel, at = self.link
            words = " ".join("".join(self.buffer[at:]).split())
            self.rows.append(("next" if rel == "next" else "link", None, self.section, self.main > 0, words, href))
            self.link = None
        if tag in BREAKS or tag in HEADS or tag == "title":
            self.flush()
        if tag in HEADS:
            self.head = None
        if tag == "title":
            self.title = False
        if self.main and tag not in ("br", "img", "input", "hr", "meta", "link"):
            self.main -= 1

    def handle_data(self, data):
        if not self.muted:
            self.buffer.append(data)


def page_lines(pages: DataFrame, key: str = "url", html: str = "body") -> DataFrame:
    """(key, LINES) of every page; a page without a main region counts as all main. Null pages have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "kind", "level", "section", "main", "position", "content", "href"]
        types = [pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.string()]
        for b in batches:
            keys, rows = [], []
            for k, h in zip(b.column(0).to_pylist(), b.column(1)):
                parser = _Lines()
                parser.feed(h.as_py() or "")
                parser.close()
                parser.flush()
                whole = not any(r[3] for r in parser.rows)
                for i, (kind, level, section, main, content, href) in enumerate(parser.rows):
                    keys.append(k)
                    rows.append((kind, level, section, main or whole, i, content, href))
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.column(0).type), *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    src = pages.select(f"`{key}`", f"`{html}`")
    return src.mapInArrow(run, f"`{key}` {src.schema[0].dataType.simpleString()}, {LINES}")


def links(lines: DataFrame, key: str = "url", aliases: Column | None = None) -> DataFrame:
    """(key, section, main, position, content, stated, address): links as written and as canonical address."""
    rows = lines.filter("kind IN ('link', 'next') AND href IS NOT NULL AND NOT startswith(href, '#') AND NOT href RLIKE '(?i)^(mailto|tel|javascript):'")
    absolute = urls.join_url(F.col(key), F.col("href"))
    return rows.select(key, "kind", "section", "main", "position", "content", F.col("href").alias("stated"), urls.canonical_url(absolute, aliases).alias("address"))


def header_lines(lines: DataFrame, key: str = "url", longest: int = 150) -> DataFrame:
    """Lines of the main region ahead of the first section heading and of the first line longer than ``longest``."""
    so_far = Window.partitionBy(key).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    over = (F.col("kind") == "heading") & (F.col("level") > 1) | (F.length("content") > longest)
    return lines.filter("main AND kind IN ('line', 'heading')").withColumn("over", F.max(over).over(so_far)).filter("NOT over AND kind = 'line'").drop("over")


def listing(lines: DataFrame, key: str = "url") -> tuple[DataFrame, DataFrame]:
    """Entries of a listing (key, address, content, place) and the further pages (key, address)."""
    all_links = links(lines, key).filter("main AND content <> ''")
    further = (F.col("kind") == "next") | F.col("content").rlike(FURTHER)
    first = all_links.filter(~further).groupBy(key, "address").agg(F.min(F.struct("position", "content")).alias("f"))
    place = F.row_number().over(Window.partitionBy(key).orderBy("f.position"))
    entries = first.select(key, "address", F.col("f.content").alias("content"), place.alias("place"))
    return entries, all_links.filter(further).select(key, "address").distinct()


def labelled(lines: DataFrame, key: str = "url") -> DataFrame:
    """(key, field, value) of lines ``Label: value`` whose label is known."""
    known = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])
    rows = lines.filter("main AND kind = 'line' AND content RLIKE '^[^:]{2,40}: .'")
    field = F.try_element_at(known, F.lower(F.trim(F.split_part("content", F.lit(":"), F.lit(1)))))
    return rows.select(key, field.alias("field"), F.trim(F.regexp_replace("content", "^[^:]+:", "")).alias("value")).filter("field IS NOT NULL")


def scrub_html(c: Column) -> Column:
    """HTML without scripts, frames and comments, with contacts masked in text and in mailto and tel links."""
    bare = F.regexp_replace(F.regexp_replace(c, CONTACT, ""), r'(?i)href="tel:[^"]*"', 'href="tel:XXX"')
    return text.scrub(bare)


@adapter("site")
class SiteAdapter(Adapter):
    """Profiles (``/kutato/``), projects (``/projekt/``) and units of one site.

    pages (url, body, document_id, source_id, retrieved_at, source_type)."""

    version = "1"

    def parse(self, pages: DataFrame) -> dict[str, DataFrame]:
        lines = page_lines(pages).persist()
        meta = pages.select("url", "document_id", "source_id", "retrieved_at", "source_type")
        own = F.concat("source_id", F.lit("|"), "url")
        h1 = lines.filter("kind = 'heading' AND level = 1").groupBy("url").agg(F.min_by("content", "position").alias("head"))
        named = meta.filter("source_type IN ('institutional_profile', 'project_page', 'unit_page')").join(h1, "url")
        person, project, unit = (named.filter(F.col("source_type") == t) for t in ("institutional_profile", "project_page", "unit_page"))

        def claim(df: DataFrame, kind: str, predicate: Column | str, value: Column | None, locator: str, confidence: float, target: tuple[str, Column] | None = None) -> DataFrame:
            p = F.lit(predicate) if isinstance(predicate, str) else predicate
            none = F.lit(None).cast("string")
            ref = lambda t, r: F.struct(F.lit(t).alias("entity_type"), r.alias("source_ref"), none.alias("canonical_id"))
            obj = ref(*target) if target else F.lit(None).cast("struct<entity_type: string, source_ref: string, canonical_id: string>")
            v = value if value is not None else none
            return df.select(
                stable_key("clm_", own, p, F.coalesce(v, F.lit("")), F.coalesce(target[1], F.lit("")) if target else F.lit(""), F.col("document_id"), F.lit(locator)).alias("claim_id"), ref(kind, own).alias("subject"), p.alias("predicate"), v.alias("value"), obj.alias("object"),
                F.lit("OBSERVED_AT").alias("temporal_basis"), F.col("retrieved_at").alias("observed_at"), "document_id", F.lit(locator).alias("locator"), F.lit("html_parser").alias("extraction_method"), F.lit("site").alias("parser"), F.lit(self.version).alias("parser_version"),
                F.lit("OBSERVED").alias("epistemic_status"), F.lit("INSTITUTIONAL").alias("assertion_type"), F.lit(confidence).alias("confidence"), F.lit("UNREVIEWED").alias("review_status"))

        out = links(lines)
        mine = person.join(out, "url")
        ids = mine.select(*person.columns, F.explode(F.array(*[F.struct(F.lit(n).alias("n"), f(F.col("stated")).alias("v")) for n, f in (("mtmt_id", urls.mtmt_id), ("orcid", urls.orcid_id), ("google_scholar_id", urls.scholar_id))])).alias("i")).filter("i.v IS NOT NULL")
        areas = person.join(lines.filter("kind = 'line'").filter(F.col("section").rlike(AREAS)).select("url", "content"), "url")
        took = mine.filter(F.col("section").rlike(PROJECTS) & F.contains("address", F.lit("/projekt/")))
        there = lambda df: F.concat(df["source_id"], F.lit("|"), "address")
        members = unit.join(out.filter(F.contains("address", F.lit("/kutato/"))), "url")
        lead = F.col("section").rlike(LEADER) | F.col("content").rlike(LEADER)
        fields = project.join(labelled(lines), "url").withColumn("period", dates.parse_period(F.col("value")))
        claims = [
            claim(person, "Person", "name", F.array_join(text.name_words(F.col("head")), " "), "profile.h1", CONFIDENCE["name"]), claim(person.withColumn("degree", F.explode(text.name_titles(F.col("head")))), "Person", "title", F.col("degree"), "profile.h1", CONFIDENCE["degree"]),
            claim(person, "Person", "profile_url", F.col("url"), "profile.url", CONFIDENCE["name"]), claim(ids, "Person", F.col("i.n"), F.col("i.v"), "profile.links", CONFIDENCE["external_profile"]),
            claim(areas, "Person", "research_area", F.col("content"), "profile.research_area", CONFIDENCE["field"]), claim(took, "Person", "PARTICIPATES_IN", None, "profile.projects", CONFIDENCE["participation"], ("Project", there(took))),
            claim(members, "OrganisationalUnit", F.when(lead, "LED_BY").otherwise("HAS_MEMBER"), None, "unit.members", CONFIDENCE["member"], ("Person", there(members))),
            claim(project, "Project", "title", F.col("head"), "project.h1", CONFIDENCE["field"]), claim(fields.filter("field NOT IN ('period', 'lead')"), "Project", F.col("field"), F.col("value"), "project.fields", CONFIDENCE["field"]),
            claim(fields.filter("field = 'period' AND period.from IS NOT NULL"), "Project", "start", F.col("period.from"), "project.fields", CONFIDENCE["field"]), claim(fields.filter("field = 'period' AND period.until IS NOT NULL"), "Project", "end", F.col("period.until"), "project.fields", CONFIDENCE["field"]),
        ]
        everything = claims[0]
        for c in claims[1:]:
            everything = everything.unionByName(c)
        kinds = F.when(F.col("source_type") == "institutional_profile", "Person").when(F.col("source_type") == "project_page", "Project").otherwise("OrganisationalUnit")
        anchor = F.when(F.col("source_type") == "institutional_profile", "institutional_profile").when(F.col("source_type") == "project_page", "project_page")
        records = named.select(F.struct(kinds.alias("entity_type"), own.alias("source_ref"), F.lit(None).cast("string").alias("canonical_id")).alias("ref"), F.col("head").alias("label"), "document_id", F.lit(None).cast("map<string,string>").alias("hints"), anchor.alias("identity_anchor"))
        found = lines.groupBy("url").agg(F.count_if(F.col("kind") == "line").alias("n"))
        status = F.when(F.coalesce("n", F.lit(0)) > 0, "ok").otherwise("empty")
        diagnostics = meta.join(found, "url", "left").select("document_id", "url", "source_id", F.col("source_type").alias("page_type"), F.lit("site").alias("parser"), status.alias("status"), F.create_map(F.lit("lines"), F.coalesce("n", F.lit(0)).cast("int")).alias("fields"))
        return {"records": records, "claims": everything, "diagnostics": diagnostics}
