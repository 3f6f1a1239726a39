"""Page parsing on small pages: regions, sections, links, listings, labelled values, claims."""

from datetime import datetime

from pyspark.sql import functions as F

from loomgraph.sources import site, stores

PROFILE = """<html><head><title>x</title><script>var a=1</script></head><body><nav><a href="/">Home</a></nav><main>
<h1>Dr. Kovács Anna</h1><p>tudományos munkatárs<br>második sor</p><p><a href="https://orcid.org/0000-0001-2345-6789">ORCID</a></p>
<h2>Kutatási területek</h2><ul><li>idősgondozás</li><li>emlékezet</li></ul><h2>Projektek</h2><p><a href="../projekt/p1?utm_source=z">P1</a> (kutató)</p></main><footer>© <p>lábléc</body>"""
PROJECT = "<main><h1>Lakhatás</h1><p>Időtartam: 2019. 01 – 2021</p><p>Azonosító: K 143593</p><p>Egyéb: semmi</p></main>"
LISTING = "<h1>Lista</h1><a href='/kutato/a'>A</a><a href='/kutato/b'>B</a><a href='/kutato/a'>A megint</a><a href='?p=2' rel='next'>Következő</a><a href='mailto:x@y.hu'>írj</a>"
UNIT = "<h1>Osztály</h1><h2>Vezető</h2><a href='/kutato/a'>A</a><h2>Tagok</h2><a href='/kutato/b'>B</a>"


def pages(spark):
    rows = [("https://s.hu/kutato/ka", PROFILE, "institutional_profile"), ("https://s.hu/projekt/p1", PROJECT, "project_page"), ("https://s.hu/lista", LISTING, "institutional_listing"), ("https://s.hu/u", UNIT, "unit_page"), ("https://s.hu/none", None, "project_page")]
    df = spark.createDataFrame(rows, "url string, body string, source_type string")
    return df.select("*", F.concat(F.lit("doc_"), "url").alias("document_id"), F.lit("s").alias("source_id"), F.lit(datetime(2025, 1, 1)).alias("retrieved_at"))


def test_lines_and_links(spark):
    lines = site.page_lines(pages(spark)).cache()
    of = lambda url: [(r.kind, r.section, r.main, r.content) for r in lines.filter(F.col("url") == url).orderBy("position").collect()]
    got = of("https://s.hu/kutato/ka")
    assert ("line", None, True, "második sor") in got and ("line", "Kutatási területek", True, "emlékezet") in got and ("line", "Projektek", False, "lábléc") in got and not any("var a" in r[3] for r in got)
    assert of("https://s.hu/none") == []
    assert [r.content for r in site.header_lines(lines).filter("url = 'https://s.hu/kutato/ka'").orderBy("position").collect()] == ["tudományos munkatárs", "második sor", "ORCID"]
    found = {(r.stated, r.address) for r in site.links(lines).collect()}
    assert ("?p=2", "https://s.hu/lista?p=2") in found and not any(s.startswith("mailto") for s, _ in found)
    entries, further = site.listing(lines.filter("url = 'https://s.hu/lista'"))
    assert [(r.place, r.content) for r in entries.orderBy("place").collect()] == [(1, "A"), (2, "B")] and [r.address for r in further.collect()] == ["https://s.hu/lista?p=2"]
    assert {(r.field, r.value) for r in site.labelled(lines).collect()} == {("period", "2019. 01 – 2021"), ("grant_id", "K 143593")}
    html = "<p>a.b@c.hu <a href=\"tel:+361\">x</a><!-- y --><script>z</script>"
    assert spark.createDataFrame([(html,)], "h string").select(site.scrub_html(F.col("h"))).first()[0] == '<p>xxx@c.hu <a href="tel:XXX">x</a>'


def test_pages_to_claims(spark, tmp_path):
    out = site.SiteAdapter().parse(pages(spark))
    claims = {(r.subject.source_ref.split("|")[1][13:], r.predicate, r.value or r.object.source_ref) for r in out["claims"].collect()}
    assert {("kutato/ka", "name", "Kovács Anna"), ("kutato/ka", "title", "Dr."), ("kutato/ka", "orcid", "0000-0001-2345-6789"), ("kutato/ka", "research_area", "emlékezet"), ("kutato/ka", "PARTICIPATES_IN", "s|https://s.hu/projekt/p1"), ("projekt/p1", "title", "Lakhatás"), ("projekt/p1", "start", "2019-01"), ("projekt/p1", "end", "2021"), ("projekt/p1", "grant_id", "K 143593"), ("u", "LED_BY", "s|https://s.hu/kutato/a"), ("u", "HAS_MEMBER", "s|https://s.hu/kutato/b")} <= claims
    assert stores.ingest(spark, pages(spark), "site", str(tmp_path), "s")["records"] == 3
    assert {r.status for r in out["diagnostics"].filter("url = 'https://s.hu/none'").collect()} == {"empty"}
