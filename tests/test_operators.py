"""Claims, graph, resolution, sources and streams on hand-counted fixtures."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.functions import dates, text, urls
from loomgraph.operators import graph, resolution
from loomgraph.operators.claims import merge_partial_dates
from loomgraph.operators.windows import average_rank, top_share
from loomgraph.plans import graphs
from loomgraph.sources import files
from loomgraph.sources.pages import page_elements
from loomgraph.streaming import observations

HAND = {"A": [1, 2, 3], "B": [1, 4], "C": range(1, 9), "D": [11], "E": [9, 10]}


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v"))).first()[0]


def test_hand_graph(spark):
    m = spark.createDataFrame([(p, x) for p, xs in HAND.items() for x in xs], "project string, person int")
    t = graph.ties(m).collect()
    assert len(t) == 29 and sum(r.shared for r in t) == 33 and abs(sum(r.weight for r in t) - 7.5) < 1e-9
    sizes = sorted(r.n for r in graph.components(graph.ties(m).select(F.col("a").alias("src"), F.col("b").alias("dst"))).groupBy("component").agg(F.count("*").alias("n")).collect())
    assert sizes == [2, 8]
    s = {r.person: (r.projects, r.tied_projects) for r in graph.strength(m).collect()}
    assert s[11] == (1, 0) and s[1] == (3, 3)


def test_closure_ends_on_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("x", "x"), (None, "a")], "src string, dst string")
    got = {(r.node, r.ancestor): r.depth for r in graph.closure(e).collect()}
    assert got == {("a", "b"): 1, ("b", "c"): 1, ("c", "a"): 1, ("d", "a"): 1, ("a", "c"): 2, ("b", "a"): 2, ("c", "b"): 2, ("d", "b"): 2, ("d", "c"): 3}
    assert {(r.id, r.hop) for r in graph.hops(e.dropna(), spark.createDataFrame([("d",)], "id string"), 2).collect()} == {("d", 0), ("a", 1), ("b", 2), ("c", 2)}


def test_closure_has_no_depth_limit(spark):
    e = spark.createDataFrame([(f"u{i:02d}", f"u{i + 1:02d}") for i in range(20)], "src string, dst string")
    got = {(r.node, r.ancestor): r.depth for r in graph.closure(e).collect()}
    assert got == {(f"u{i:02d}", f"u{j:02d}"): j - i for i in range(21) for j in range(i + 1, 21)}
    with pytest.raises(RuntimeError):
        graph.closure(e, max_rounds=2)


def related(spark, folder, rows):
    spark.createDataFrame(rows, "type string, source_id string, target_id string").write.parquet(f"{folder}/relations.parquet")
    return str(folder)


def test_unit_tree_counts_go_all_the_way_down(spark, tmp_path):
    chain = [("PART_OF", f"u{i}", f"u{i + 1}") for i in range(4)]
    d = related(spark, tmp_path, [*chain, ("PART_OF", "u4", "u4"), ("AFFILIATED_WITH", "p", "u0"), ("AFFILIATED_WITH", "p", "u2"), ("AFFILIATED_WITH", "q", "u3")])
    assert {r.top: r.people for r in graphs.unit_tree_counts(spark, d).collect()} == {"u0": 1, "u1": 1, "u2": 1, "u3": 2, "u4": 2}


def test_cycles_of_any_length(spark, tmp_path):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("c", "y"), ("s", "s"), ("m", "n"), ("n", "m"), ("y", None)]
    d = related(spark, tmp_path, [("PART_OF", *e) for e in edges] + [("AFFILIATED_WITH", "y", "c")])
    assert sorted(graphs.cycle_check(spark, d).collect()) == [("a", "b"), ("b", "c"), ("c", "a"), ("m", "n"), ("n", "m"), ("s", "s")]


def test_ranks_and_top_share(spark):
    v = spark.createDataFrame([(i, x) for i, x in enumerate([5, 1, 1, 9])], "i int, v int")
    assert [r.avg_rank for r in average_rank(v, "v").orderBy("i").collect()] == [3, 1.5, 1.5, 4]
    w = spark.createDataFrame([(x,) for x in [3, 2, 2, 1, 0, 0, 0, 0, 0, 0]], "v int")
    assert top_share(w, "v", 20).count() == 3
    assert top_share(w.filter("v = 0"), "v", 20).count() == 0


def test_partial_dates(spark):
    d = spark.createDataFrame([("a", "2020"), ("a", "2020-05"), ("b", "2020"), ("b", "2020-05"), ("b", "2020-06"), ("c", None)], "k string, v string")
    assert {(r.k, r.v): r.merged for r in merge_partial_dates(d, "k", "v").collect()} == {("a", "2020"): "2020-05", ("a", "2020-05"): "2020-05", ("b", "2020"): "2020", ("b", "2020-05"): "2020-05", ("b", "2020-06"): "2020-06"}
    assert one(spark, "2020-5", dates.is_partial_date) is False and one(spark, "2020-05", dates.year) == 2020


def test_text_and_urls(spark):
    assert one(spark, "Dr. Őry-Kovács, Ádám PhD", text.name_key) == "ory kovacs adam"
    assert one(spark, "Őry Ádám", text.order_free_key) == "adam ory"
    assert one(spark, "x" * 700, text.snippet) == "x" * 599 + "…"
    assert one(spark, "írj: a.b@c.hu vagy +36 1 234 5678", text.scrub) == "írj: xxx@c.hu vagy XXX"
    assert one(spark, "Telefon: (1) 224-6700, Fax 1/224-6700; 2019/123 és (2) 400-422", text.scrub) == "Telefon: XXX, Fax XXX; 2019/123 és (2) 400-422"
    assert one(spark, "HTTP://www.Site.hu//a//b/?utm_source=x&b=2&a=1#f", urls.canonical_url) == "https://www.site.hu/a/b?a=1&b=2"
    assert one(spark, "http://m.site.hu", lambda c: urls.canonical_url(c, F.create_map(F.lit("m.site.hu"), F.lit("site.hu")))) == "https://site.hu/"
    assert one(spark, "../x?y=1", lambda c: urls.join_url(F.lit("https://a.hu/b/c.html"), c)) == "https://a.hu/x?y=1"
    assert one(spark, "../../x", lambda c: urls.join_url(F.lit("https://a.hu/b/c"), c)) == "https://a.hu/x" and one(spark, "./q", lambda c: urls.join_url(F.lit("https://a.hu"), c)) == "https://a.hu/q"
    assert one(spark, "no url", urls.canonical_url) is None
    score = lambda n: one(spark, n, lambda c: text.search_score("kovacs anna", c))
    assert score("Kovács Anna") == 1.0 and score("Szabó Béla") == 0.0 and 0 < score("Anna Kovácsné") < 1


def test_blocked_clusters(spark):
    links = spark.createDataFrame([("a", "b", "CONFIRMED", 1.0), ("b", "c", "CONFIRMED", 0.9), ("a", "c", "REJECTED", 0.0), ("x", "y", "CONFIRMED", 1.0)], "a string, b string, status string, score double")
    assert {r.ref: r.cluster for r in resolution.blocked_clusters(links).collect()} == {"a": "a", "b": "a", "c": "c", "x": "x", "y": "x"}


def test_files(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])
    assert files.read_jsonl(spark, f"{tmp_path}/none.jsonl", schema).count() == 0
    df = spark.createDataFrame([("b", 2), ("a", 1)], schema)
    files.write_jsonl(df, f"{tmp_path}/x", ["id"])
    assert files.read_jsonl(spark, f"{tmp_path}/x", schema).count() == 2
    once = files.merge(df, spark.createDataFrame([("a", 9), ("c", 3)], schema), ["id"])
    assert sorted(map(tuple, once.collect())) == [("a", 9), ("b", 2), ("c", 3)]
    several = spark.createDataFrame([("a", 5), ("a", 7), ("a", 6)], schema)
    assert [tuple(r) for r in files.merge(df.limit(0), several, ["id"], ["n"]).collect()] == [("a", 7)]
    assert "| n | bigint | yes |" in files.data_dictionary({"t": schema})


def test_page_elements(spark):
    html = "<title>T</title><h1>Head<script>x</script></h1><p>one <a href='/u'>link</a> two<p>open"
    got = [(r.tag, r.href, r.content) for r in page_elements(spark.createDataFrame([(1, html), (2, None)], "id int, html string"), "id", "html").orderBy("position").collect()]
    assert ("title", None, "T") in got and ("h1", None, "Head") in got and ("a", "/u", "link") in got


def test_streams(spark, tmp_path):
    rows = [(1, "a", datetime(2025, 1, 1, 10)), (1, "a", datetime(2025, 1, 1, 10)), (2, "b", datetime(2025, 1, 1, 11))]
    spark.createDataFrame(rows, "id int, k string, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id int, k string, ts timestamp").parquet(f"{tmp_path}/in")
    sink = observations.upsert_sink(f"{tmp_path}/out", ["id"], ["ts"], buckets=4)
    q = observations.deduplicated(stream, "id", "ts").writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(60)
    table = lambda: sorted((r.id, r.k) for r in observations.read_upserted(spark, f"{tmp_path}/out", stream.schema).collect())
    assert table() == [(1, "a"), (2, "b")]
    batch = spark.createDataFrame([(2, "c", datetime(2025, 1, 2)), (3, "d", datetime(2025, 1, 2))], "id int, k string, ts timestamp")
    for _ in range(2):  # a batch run again changes nothing
        sink(batch, 7)
    sink(batch.withColumn("k", F.lit("late")), 6)
    assert table() == [(1, "a"), (2, "c"), (3, "d")]


def test_polite(spark):
    r = spark.createDataFrame([("h", datetime(2025, 1, 1), 1), ("h", datetime(2025, 1, 1), 2), ("g", datetime(2025, 1, 1), 3)], "host string, at timestamp, id int")
    got = {x.id: (x.place, x.not_before.second, x.within_budget) for x in observations.polite(r, "host", "at", 3, 1).collect()}
    assert got == {1: (1, 0, True), 2: (2, 3, False), 3: (1, 0, True)} and observations.retry_delays(3) == [6, 12]


def test_betweenness_and_communities(spark):
    from loomgraph.operators import centrality

    path = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("c", "d"), ("b", "b")], "src string, dst string")
    assert {r.id: r.betweenness for r in centrality.betweenness(path).collect()} == {"a": 0.0, "b": 2.0, "c": 2.0, "d": 0.0}
    square = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "a")], "src string, dst string")
    assert {r.betweenness for r in centrality.betweenness(square).collect()} == {0.5}
    cliques = [(f"{s}{i}", f"{s}{j}") for s in "xy" for i in range(5) for j in range(i)] + [("x0", "y0")]
    got = {r.id: r.community for r in centrality.communities(spark.createDataFrame(cliques, "src string, dst string")).collect()}
    assert len({got[f"x{i}"] for i in range(5)}) == 1 and len({got[f"y{i}"] for i in range(5)}) == 1 and got["x1"] != got["y1"]
    assert centrality.communities(path.limit(0)).count() == 0
