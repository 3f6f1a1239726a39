"""Orphans, histories and snapshot changes on small tables with odd rows."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from loomgraph.functions.lists import list_form
from loomgraph.operators import history, snapshots
from loomgraph.operators.references import KnowledgeTables, orphan_cascade
from loomgraph.operators.skew import salted_join

PERSON = "canonical_id string, snapshot_date date, loaded_at timestamp, last_verified_at timestamp, first_observed_at timestamp, position_titles array<string>, extra map<string,string>"


def person_rows(spark, rows):
    return spark.createDataFrame(rows, PERSON)


def versions(df):
    out = history.attribute_versions(df, "canonical_id", list_form("position_titles"), "last_verified_at", "snapshot_date", "loaded_at", "first_observed_at")
    return sorted(map(tuple, out.collect()))


def test_history_versions(spark):
    d, t = date, datetime
    rows = [
        ("p", d(2025, 1, 1), t(2025, 1, 2), t(2025, 1, 1), t(2024, 12, 1), ["a", "B "], None),
        ("p", d(2025, 2, 1), t(2025, 2, 2), t(2025, 2, 1), None, ["b", "A", "a"], None),  # equal apart from order and case
        ("p", d(2025, 3, 1), t(2025, 3, 2), None, None, None, None),  # null time: the snapshot's midnight; null list
        ("p", d(2025, 3, 1), t(2025, 3, 1), None, None, ["older load"], None),
        ("p", d(2025, 4, 1), t(2025, 4, 2), t(2025, 4, 1), None, [], None),  # empty equals null
        ("p", d(2025, 5, 1), t(2025, 5, 2), t(2025, 5, 1), None, ["a", "b"], None),
        (None, d(2025, 5, 1), t(2025, 5, 2), t(2025, 5, 1), None, ["a"], None),
    ]
    assert versions(person_rows(spark, rows + rows)) == [("p", "2024-12-01", "2025-03-01"), ("p", "2025-03-01", "2025-05-01"), ("p", "2025-05-01", "open")]
    assert versions(person_rows(spark, [])) == []


def test_history_of_a_hot_entity_against_a_scan(spark):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    rows = [("hot", start + timedelta(hours=7 * k), k, rng.choice("ab")) for k in range(700)]
    units = spark.createDataFrame(rows, "entity string, t timestamp, k int, p string").drop("k")
    want, last = [], None
    for _, t, _, p in rows:
        if p != last:
            want.append((t, p))
        last = p
    for bits in (3, 10):  # many chunks, one chunk
        got = sorted((r.t, r.p, r.next_t) for r in history.coalesce_versions(units, bits).collect())
        assert [(t, p) for t, p, _ in got] == want
        assert [n for *_, n in got] == [t for t, _ in want[1:]] + [None]


def test_snapshot_changes(spark):
    d, t = date, datetime
    rows = [
        ("a", d(2025, 1, 1), t(2025, 1, 2), None, None, ["x"], None),
        ("b", d(2025, 1, 1), t(2025, 1, 2), None, None, None, None),
        ("a", d(2025, 2, 1), t(2025, 2, 1), None, None, ["y"], None),
        ("a", d(2025, 2, 1), t(2025, 2, 2), None, None, [" X"], None),  # the later load counts
        ("c", d(2025, 2, 1), t(2025, 2, 2), None, None, [], None),
        ("b", d(2025, 3, 1), t(2025, 3, 1), None, None, [], None),
        ("c", d(2025, 3, 1), t(2025, 3, 1), None, None, ["z"], None),
        (None, d(2025, 3, 1), t(2025, 3, 1), None, None, ["z"], None),
    ]
    f = lambda df, o=None: sorted(map(tuple, snapshots.snapshot_changes(df, "canonical_id", "snapshot_date", "loaded_at", list_form("position_titles"), o).collect()))
    want = [("a", "2025-03-01", "removed"), ("b", "2025-02-01", "removed"), ("b", "2025-03-01", "added"), ("c", "2025-02-01", "added"), ("c", "2025-03-01", "changed")]
    assert f(person_rows(spark, rows * 2)) == want
    assert f(person_rows(spark, [])) == []
    known = snapshots.assign_ordinals(spark.createDataFrame([("c",), ("zz",)], "key string"))
    both = snapshots.assign_ordinals(spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "key string"), known)
    kept = {r.key: r.ordinal for r in both.collect()}
    assert {r.key: r.ordinal for r in known.collect()}.items() <= kept.items() and len(set(kept.values())) == 4
    assert f(person_rows(spark, rows), both) == want


def test_orphan_cascade(spark):
    t = datetime
    tables = KnowledgeTables(
        relations=spark.createDataFrame(
            [("r1", "p1", "u1", t(2025, 3, 1), ["c1"]), ("r2", "old", None, None, None), ("r3", None, "nowhere", t(2025, 4, 1), ["c3"]), ("r3", None, "nowhere", t(2025, 4, 1), ["c3"])],
            "relation_id string, source_id string, target_id string, last_observed_at timestamp, claim_ids array<string>",
        ),
        claims=spark.createDataFrame(
            [("c1", "d1", t(2025, 1, 5), None), ("c2", "d2", t(2025, 1, 1), []), ("c3", "gone", None, None), ("c4", "d1", t(2025, 1, 5), ["c3", None]), ("c5", None, t(2025, 2, 5), ["c4"]), ("c3", "gone", None, ["c5"])],
            "claim_id string, document_id string, observed_at timestamp, derived_from array<string>",
        ),
        person=spark.createDataFrame([("p1", date(2025, 1, 1)), ("old", date(2024, 1, 1)), (None, date(2025, 1, 1))], "canonical_id string, snapshot_date date"),
        project=spark.createDataFrame([], "canonical_id string"),
        org_units=spark.createDataFrame([("u1",)], "canonical_id string"),
        documents=spark.createDataFrame([("d1", t(2025, 1, 1)), ("d2", t(2025, 1, 2)), ("d2", t(2025, 1, 3)), (None, None)], "document_id string, retrieved_at timestamp"),
    )
    got = {(r.row_key, r.field_name, r.ref_month, r.ref_state, r.orphan_kind, r.depth) for r in orphan_cascade(tables).collect()}
    assert got == {
        ("r2", "source_id", "unknown", "gone", "direct", 0), ("r3", "target_id", "2025-04", "missing", "direct", 0),
        ("c2", "document_id", "2025-01", "late", "direct", 0), ("c3", "document_id", "unknown", "missing", "direct", 0),
        ("c4", "derived_from", "2025-01", "inherited", "inherited", 1), ("c5", "derived_from", "2025-02", "inherited", "inherited", 2),
        ("r3", "claim_ids", "2025-04", "inherited", "inherited", 1),
    }
    empty = KnowledgeTables(**{k: v.limit(0) for k, v in vars(tables).items()})
    assert orphan_cascade(empty).count() == 0


def test_salted_join_equals_join(spark):
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.col("id").cast("string")).alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1), ("7", 2), ("8", 3)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(str, facts.join(dim, "k", how).collect()))
        assert sorted(map(str, salted_join(facts, dim, "k", how, rows_limit=100).select(*facts.join(dim, "k", how).columns).collect())) == want
