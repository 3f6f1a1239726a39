"""Hot keys, nulls, long chains: half of all rows on one key, half on null."""

from datetime import datetime

from pyspark.sql import functions as F

from loomgraph.operators import components, graph, skew, snapshots
from loomgraph.operators.references import KnowledgeTables, orphan_cascade


def test_nulls_are_spread_and_kept(spark):
    facts = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(None)).when(F.col("id") % 4 == 1, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1), ("7", 2), (None, 9)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = facts.join(dim, "k", how)
        got = skew.salted_join(facts, dim, "k", how, rows_limit=100).select(*want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    spread = skew.salted_join(facts, dim, "k", "left", rows_limit=100).filter("k IS NULL").groupBy(F.spark_partition_id()).count().count()
    assert spread > 1 or spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_components_with_a_hub_a_chain_and_salts(spark):
    hub = [(0, i) for i in range(1, 400)]
    chain = [(1000 + i, 1001 + i) for i in range(300)]
    edges = spark.createDataFrame(hub + chain + [(5000, 5001), (5001, 5000), (7, 7)], "a bigint, b bigint")
    for limit in (20, skew.ROWS_LIMIT):
        got = {r.v: r.label for r in components.components(edges, limit).collect()}
        assert len(got) == 400 + 301 + 2 and {got[i] for i in range(400)} == {0} and {got[1000 + i] for i in range(301)} == {1000} and got[5001] == 5000
    named = spark.createDataFrame([("b", "a"), ("b", "c"), ("x", "x")], "src string, dst string")
    assert {r.id: r.component for r in graph.components(named).collect()} == {"a": "a", "b": "a", "c": "a"}


def test_cascade_follows_long_chains(spark):
    n = 60
    claims = [("c0", "gone", datetime(2025, 1, 1), None)] + [(f"c{i}", None, datetime(2025, 1, 1), [f"c{i - 1}"]) for i in range(1, n)]
    none = lambda ddl: spark.createDataFrame([], ddl)
    t = KnowledgeTables(
        relations=none("relation_id string, source_id string, target_id string, last_observed_at timestamp, claim_ids array<string>"), claims=spark.createDataFrame(claims, "claim_id string, document_id string, observed_at timestamp, derived_from array<string>"),
        person=none("canonical_id string, snapshot_date date"), project=none("canonical_id string"), org_units=none("canonical_id string"), documents=none("document_id string, retrieved_at timestamp"))
    assert {(r.row_key, r.depth) for r in orphan_cascade(t).collect()} == {(f"c{i}", i) for i in range(n)}


def test_ordinals_persist_from_delivery_to_delivery(spark, tmp_path):
    path = f"{tmp_path}/ordinals"
    first = {r.key: r.ordinal for r in snapshots.persistent_ordinals(spark.createDataFrame([("b",), ("a",), (None,)], "key string"), path).collect()}
    second = {r.key: r.ordinal for r in snapshots.persistent_ordinals(spark.createDataFrame([("c",), ("a",)], "key string"), path).collect()}
    assert set(first) == {"a", "b"} and first.items() <= second.items() and set(second) == {"a", "b", "c"} and len(set(second.values())) == 3


def test_dense_and_sparse_containers_agree(spark, monkeypatch):
    rows = [(f"k{i:05d}", d, datetime(2025, 1, 1), "x" if (i + d) % 7 else "y") for d in (1, 2) for i in range(5000) if i % (d + 3)]
    df = spark.createDataFrame(rows, "k string, d int, l timestamp, p string").withColumn("d", F.date_add(F.lit("2025-01-01").cast("date"), F.col("d")))
    found = []
    for limit in (1, 10**9):
        monkeypatch.setattr(snapshots, "SPARSE", limit)
        found.append(sorted(map(tuple, snapshots.snapshot_changes(df, "k", "d", "l", F.col("p")).collect())))
    old, new = ({k: p for k, d, _, p in rows if d == day} for day in (1, 2))
    want = sorted([(k, "2025-01-03", "added") for k in new.keys() - old.keys()] + [(k, "2025-01-03", "removed") for k in old.keys() - new.keys()] + [(k, "2025-01-03", "changed") for k in new.keys() & old.keys() if new[k] != old[k]])
    assert found[0] == found[1] == want
