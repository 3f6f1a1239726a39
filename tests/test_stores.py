"""Staged folders, raw content, releases, adapters and the command line."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loomgraph import __main__ as cli
from loomgraph.sources import schemas, stores


def documents(spark):
    rows = [("d1", "s", "https://a.hu/1", datetime(2025, 1, 1), 200), ("d1", "s", "https://a.hu/1", datetime(2025, 1, 2), 200), ("d2", "s", "https://a.hu/2", None, 404)]
    return spark.createDataFrame(rows, "document_id string, source_id string, canonical_url string, retrieved_at timestamp, http_status int")


def test_staged(spark, tmp_path):
    docs = documents(spark).withColumn("ordinal", F.monotonically_increasing_id())
    claims = spark.createDataFrame([("c1", "name", "A"), ("c1", "name", "A")], "claim_id string, predicate string, value string")
    counts = stores.write_staged({"documents": docs, "claims": claims, "errors": spark.createDataFrame([("u", "e")], "url string, error string")}, str(tmp_path), "s")
    assert counts == {"documents": 2, "claims": 1, "errors": 1}
    stores.write_staged({"documents": docs}, str(tmp_path), "without_claims")
    assert stores.staged_sources(spark, str(tmp_path)) == ["s"] and stores.staged_sources(spark, str(tmp_path), ["t"]) == []
    back = stores.read_staged(spark, str(tmp_path), "s")
    assert back["documents"].filter("document_id = 'd1'").first().retrieved_at == datetime(2025, 1, 2) and back["frontier"].count() == 0
    assert back["claims"].schema == schemas.schema("claims") and stores.union_staged(spark, str(tmp_path), "documents").count() == 2
    assert stores.staged_sources(spark, f"{tmp_path}/none") == []
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "claims.jsonl").write_text("no json\n")
    with pytest.raises(Exception):
        stores.read_jsonl(spark, f"{tmp_path}/bad/claims.jsonl", schemas.schema("claims")).collect()


def test_documents_and_raw_store(spark, tmp_path):
    pages = spark.createDataFrame([("u", "http://a.hu/x/?utm_source=1", "<title> A\n b </title>x"), ("v", "http://a.hu/x", "<title> A\n b </title>x"), ("w", "http://a.hu/y", None)], "url string, final_url string, body string")
    d = {r.url: r for r in stores.make_documents(pages).collect()}
    assert d["u"].document_id == d["v"].document_id and d["u"].page_title == "A b" and d["w"].document_id is None and d["u"].canonical_url == "https://a.hu/x"
    for _ in range(2):
        stores.write_raw(pages, f"{tmp_path}/raw")
    raw = stores.read_raw(spark, f"{tmp_path}/raw")
    assert raw.count() == 1 and stores.read_raw(spark, f"{tmp_path}/raw", [d["u"].content_sha256]).first().body.decode().endswith("x")
    assert [r.document_id for r in stores.replay(documents(spark)).collect()] == ["d1"]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.html").write_text("<p>x")
    files = stores.file_documents(spark, f"{tmp_path}/f/*", "cur").first()
    assert files.url == "repo://a.html" and files.document_id.startswith("doc_")
    manifest = spark.createDataFrame([("a.html", "https://x"), ("none.html", "https://y")], "file string, url string")
    assert {r.file: r.body for r in stores.fixture_pages(spark, f"{tmp_path}/f/*", manifest).collect()} == {"a.html": "<p>x", "none.html": None}


def test_releases(spark, tmp_path, capsys):
    t = spark.createDataFrame([("b", [1], {"k": "v"}), ("a", None, None)], "id string, n array<int>, m map<string,string>")
    folder = f"{tmp_path}/r"
    stores.write_release({"t": t, "old": t}, folder, {"t": ["id"], "old": ["id"]})
    manifest = stores.write_release({"t": t}, folder, {"t": ["id"]}, {"report.md": "# x"})
    assert manifest["tables"]["t"]["rows"] == 2 and not (tmp_path / "r" / "old").exists() and (tmp_path / "r" / "report.md").read_text() == "# x"
    assert stores.verify_release(spark, folder) == [] and stores.load_release(spark, folder, views=True)["t"].count() == 2 and spark.table("t").count() == 2
    assert cli.main(["verify", folder]) == 0
    t.withColumn("id", F.lit("z")).write.mode("overwrite").parquet(f"{folder}/t")
    assert stores.verify_release(spark, folder) == ["t"] and cli.main(["verify", folder]) == 1
    assert cli.main(["queries"]) == 0 and "canonical_entities" in capsys.readouterr().out
    flat = stores.flatten_props(t)
    assert dict(flat.dtypes) == {"id": "string", "n": "array<int>", "m": "string"}
    assert stores.in_batches(spark.range(1000).select(F.col("id").cast("string").alias("id")), "id", 100).select("batch").distinct().count() <= 10


def test_graph_load_and_export(spark, tmp_path):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int")
    new = spark.createDataFrame([("b", 2), ("b", 3), ("c", 2)], "id string, v int")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(stores.load_graph(old, new, ["id"], order=["v"])) == [("a", 1), ("b", 3), ("c", 2)] and rows(stores.load_graph(old, new, ["id"], prune=True, order=["v"])) == [("b", 3), ("c", 2)]
    nodes = spark.createDataFrame([("a",), ("b",)], "canonical_id string")
    edges = spark.createDataFrame([("X", "a", "b", "OBSERVED"), ("X", "a", "b", "DERIVED"), ("Y", "a", "b", "OBSERVED"), ("X", "a", "gone", "OBSERVED")], "type string, source_id string, target_id string, epistemic_status string")
    assert stores.export_graph(nodes, edges, True, ["X"])[1].count() == 1
    pairs = spark.createDataFrame([("r", "s", 0.5), ("r", "t", 0.9)], "left string, right string, score double")
    stores.write_review_queue(pairs, f"{tmp_path}/q", spark.createDataFrame([("r",), ("t",)], "ref string"))
    assert spark.read.json(f"{tmp_path}/q").count() == 1
    stores.save_identity_map(spark.createDataFrame([("r", "id")], "source_ref string, canonical_id string"), f"{tmp_path}/m")
    (tmp_path / "c.json").write_text('{"seeds": [{"name": "A"}]}')
    cfg = stores.read_config(f"{tmp_path}/c.json")
    assert stores.config_table(spark, cfg["seeds"], "name string, unit string").first().unit is None and stores.read_config(f"{tmp_path}/none") == {}
    assert stores.render_table(old.orderBy("id"), "T").splitlines()[-1] == "| b | 1 |"


def test_adapters(spark, tmp_path):
    @stores.adapter("titles")
    class Titles(stores.Adapter):
        def parse(self, pages):
            return {"claims": pages.select(F.col("url").alias("claim_id"), F.lit("title").alias("predicate"), F.col("body").alias("value"))}

    pages = spark.createDataFrame([("u", "x"), ("u", "x")], "url string, body string")
    assert stores.ingest(spark, pages, "titles", str(tmp_path), "s") == {"claims": 1}
