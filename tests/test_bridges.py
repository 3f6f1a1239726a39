"""Bridges between unit trees: counted as pairs of every project, without building these pairs."""

import random
from itertools import combinations

from loomgraph.plans import structure


def written(spark):
    """Records written to shuffles so far."""
    store = spark.sparkContext._jsc.sc().statusStore()
    empty = spark.sparkContext._jvm.java.util.ArrayList()
    stages = store.stageList(empty, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), empty)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def saved(spark, tmp_path, rows):
    spark.createDataFrame(rows, "type string, source_id string, target_id string").write.parquet(f"{tmp_path}/relations.parquet")
    return {(r.top_a, r.top_b): r.projects for r in structure.unit_tree_bridges(spark, str(tmp_path)).collect()}


def test_bridges_of_many_parents(spark, tmp_path):
    rng = random.Random(4)
    above = {f"u{i}": {f"t{j}" for j in range(12) if (i + j) % 3} for i in range(4)} | {f"t{j}": {f"t{j}"} for j in range(3)} | {"alone": {"alone"}}
    units = {f"p{i}": rng.sample(list(above), rng.randrange(4)) for i in range(30)}
    projects = {f"j{i}": rng.sample(list(units), rng.randrange(1, 4)) for i in range(25)}
    rows = [("PART_OF", u, t) for u, tops in above.items() for t in tops if u != t] + [("MEMBER_OF" if u < "u1" else "AFFILIATED_WITH", p, u) for p, us in units.items() for u in us]
    rows += [("PARTICIPATES_IN", p, j) for j, ps in projects.items() for p in ps] + [("PART_OF", None, "t1"), ("MEMBER_OF", "p1", None), ("PRINCIPAL_INVESTIGATOR_OF", "p1", "j1"), ("PARTICIPATES_IN", "p1", "j1")]
    projects["j1"].append("p1")
    want = {}
    for people in projects.values():
        for pair in combinations(sorted({t for p in people for u in units[p] for t in above[u]}), 2):
            want[pair] = want.get(pair, 0) + 1
    assert saved(spark, tmp_path, rows) == want


def test_pairs_are_not_built_for_each_project(spark, tmp_path):
    rows = [("PART_OF", "u", f"t{i:02d}") for i in range(40)] + [("MEMBER_OF", "p", "u")] + [("PARTICIPATES_IN", "p", f"j{i}") for i in range(300)]
    before = written(spark)
    got = saved(spark, tmp_path, rows)
    assert len(got) == 40 * 39 / 2 and set(got.values()) == {300} and written(spark) - before < 10_000
