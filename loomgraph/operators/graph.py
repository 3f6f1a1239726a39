"""Graph operators over edge tables (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.components import labelled
from loomgraph.session import cut, cut_measured


def closure(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, ancestor, depth): all nodes reached along edges, shortest depth, cycle-safe.

    By doubling: a round joins the reached pairs with themselves, so paths of up to
    2**k edges are known after k rounds and a hierarchy of 20 levels takes five.
    The start pairs (node, node, 0) are not included, nor a node as its own
    ancestor. Ends when a round finds no new pair; ``max_rounds`` stands for
    paths of 2**40 edges, beyond which it raises.
    """
    figures = {"n": F.count(F.lit(1))}
    start = edges.select(F.col("src").alias("node"), F.col("dst").alias("ancestor")).filter("node IS NOT NULL AND ancestor IS NOT NULL AND node <> ancestor")
    pairs, seen = cut_measured(start.distinct().withColumn("depth", F.lit(1)), **figures)
    for _ in range(max_rounds):
        far = pairs.alias("l").join(pairs.alias("r"), F.col("l.ancestor") == F.col("r.node")).select("l.node", "r.ancestor", (F.col("l.depth") + F.col("r.depth")).alias("depth"))
        step = pairs.unionByName(far.filter("node <> ancestor")).groupBy("node", "ancestor").agg(F.min("depth").alias("depth"))
        before = seen["n"]
        pairs, seen = cut_measured(step, **figures)
        if seen["n"] == before:
            return pairs
    raise RuntimeError("no fixpoint within max_rounds")


def hops(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """(id, hop): breadth-first distance from the seeds, up to ``depth``; edges count both ways."""
    both = cut(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    frontier = cut(seeds.select("id").distinct().withColumn("hop", F.lit(0)))
    reached = frontier
    for hop in range(1, depth + 1):
        step = frontier.join(both, F.col("id") == F.col("src")).select(F.col("dst").alias("id")).distinct()
        frontier = cut(step.join(reached.select("id"), "id", "left_anti").withColumn("hop", F.lit(hop)))
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return reached


def ties(membership: DataFrame) -> DataFrame:
    """(a, b, shared, weight): pairs of persons with common projects.

    membership (project, person); weight = sum of 1/(n-1) over the shared
    projects of n persons. Pairs grow with the square of a project's size, which
    is what a projection is; the strength of single persons needs none of them
    (see ``strength``).
    """
    m = membership.select("project", "person").distinct()
    sized = m.join(m.groupBy("project").agg(F.count(F.lit(1)).alias("n")), "project")
    pairs = sized.alias("l").join(m.alias("r"), (F.col("l.project") == F.col("r.project")) & (F.col("l.person") < F.col("r.person")))
    return pairs.groupBy(F.col("l.person").alias("a"), F.col("r.person").alias("b")).agg(
        F.count(F.lit(1)).alias("shared"), F.sum(1 / (F.col("l.n") - 1)).alias("weight")
    )


def strength(membership: DataFrame) -> DataFrame:
    """(person, projects, tied_projects): by the identity that the weights 1/(n-1) of a
    person's ties in a project add up to one, no pair is ever built."""
    m = membership.select("project", "person").distinct()
    sized = m.join(m.groupBy("project").agg(F.count(F.lit(1)).alias("n")), "project")
    return sized.groupBy("person").agg(F.count(F.lit(1)).alias("projects"), F.count_if(F.col("n") > 1).alias("tied_projects"))


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree) over distinct undirected edges."""
    e = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).filter("a <> b").distinct()
    return e.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def prune(edges: DataFrame, least: int, rounds: int = 5) -> DataFrame:
    """Edges whose ends keep at least ``least`` edges, pruned for a bounded number of rounds."""
    e = cut(edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).filter("src <> dst").distinct())
    for _ in range(rounds):
        kept = degrees(e).filter(F.col("degree") >= least).select("id")
        e = cut(e.join(kept.withColumnRenamed("id", "src"), "src", "left_semi").join(kept.withColumnRenamed("id", "dst"), "dst", "left_semi"))
    return e


def components(edges: DataFrame) -> DataFrame:
    """(id, component): least id of each connected component. Hubs are salted and
    labels travel as numbers (``operators/components.py``)."""
    pairs = edges.filter("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    return labelled(cut(pairs)).select(F.col("ref").alias("id"), F.col("label").alias("component"))


WEIGHTINGS = ["unweighted", "project_count", "size_discounted"]


def projection(membership: DataFrame, weighting: str, drop_from: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes (person) and edges (a, b, weight) of the co-participation graph.

    unweighted: 1 for a tied pair; project_count: the common projects;
    size_discounted: 1/(n-1) for each common project of n persons. Projects of
    ``drop_from`` and more persons tie nobody, but their persons stay as isolates.
    """
    m = membership.select("project", "person").distinct()
    kept = m
    if drop_from is not None:
        kept = m.join(m.groupBy("project").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < drop_from).select("project"), "project", "left_semi")
    t = ties(kept)
    weight = {"unweighted": F.lit(1.0), "project_count": F.col("shared").cast("double"), "size_discounted": F.col("weight")}[weighting]
    return m.select("person").distinct(), t.select("a", "b", weight.alias("weight"))


def reachable_by(edges: DataFrame, seeds: DataFrame, hops_types: list[list[str]]) -> DataFrame:
    """(id, hop): what seeds (id) reach if hop k follows only edges of the k-th list of types, either way; hop = first reach."""
    both = edges.select("src", "dst", "type").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type")).distinct()
    frontier = reached = cut(seeds.select("id").distinct().withColumn("hop", F.lit(0)))
    for k, types in enumerate(hops_types, 1):
        step = frontier.join(both.filter(F.col("type").isin(*types)), F.col("id") == F.col("src")).select(F.col("dst").alias("id")).distinct()
        frontier = cut(step.join(reached.select("id"), "id", "left_anti").withColumn("hop", F.lit(k)))
        reached = reached.unionByName(frontier)
    return reached


def shortest_paths(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """(id, hop, path): a shortest path from the nearest seed, ids joined by >; of several the one of least predecessors."""
    both = cut(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    frontier = reached = cut(seeds.select("id").distinct().select("id", F.lit(0).alias("hop"), F.col("id").alias("path")))
    for k in range(1, depth + 1):
        step = frontier.join(both, F.col("id") == F.col("src")).groupBy(F.col("dst").alias("id")).agg(F.min_by("path", "src").alias("p"))
        frontier = cut(step.join(reached.select("id"), "id", "left_anti").select("id", F.lit(k).alias("hop"), F.concat("p", F.lit(">"), "id").alias("path")))
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return reached


def top_ancestors(units: DataFrame, part_of: DataFrame) -> DataFrame:
    """(node, top): the ancestors of a unit (itself included) that are part of nothing; on a cycle there are none.

    units (id), part_of (src, dst)."""
    above = closure(part_of)
    all_up = units.select(F.col("id").alias("node"), F.col("id").alias("top")).unionByName(above.select("node", F.col("ancestor").alias("top"))).distinct()
    inner = part_of.filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").select(F.col("src").alias("top")).distinct()
    return all_up.join(inner, "top", "left_anti").select("node", "top")


def bridges(people: DataFrame, tops: DataFrame, membership: DataFrame) -> DataFrame:
    """(top_a, top_b, projects): in how many projects people under both tops take part.

    people (person, node), tops (node, top), membership (project, person). Units
    under the same tops are of one kind. Projects of the same kinds, then of the
    same tops, are counted together before tops are paired: pairs grow with the
    square of the tops, and in a hierarchy of many parents most projects have the same.
    """
    sets = tops.groupBy("node").agg(F.array_sort(F.collect_set("top")).alias("tops"))
    kinds = cut(sets.join(sets.groupBy("tops").agg(F.min("node").alias("kind")), "tops").select("node", "kind", "tops"))
    placed = people.join(kinds.select("node", "kind"), "node").select("person", "kind").distinct()
    takes_part = placed.join(membership, "person").select("project", "kind").distinct()
    same = lambda df, key: df.groupBy(key).agg(F.min("project").alias("project"), F.sum("n").alias("n"))
    by_kinds = cut(same(takes_part.groupBy("project").agg(F.array_sort(F.collect_set("kind")).alias("kinds"), F.lit(1).alias("n")), "kinds"))
    under = kinds.filter("node = kind").select("kind", F.explode("tops").alias("top"))
    wide = by_kinds.select("project", "n", F.explode("kinds").alias("kind")).join(under, "kind")
    by_tops = cut(same(wide.groupBy("project").agg(F.array_sort(F.collect_set("top")).alias("tops"), F.max("n").alias("n")), "tops"))
    at = by_tops.select("project", "n", F.explode("tops").alias("top"))
    pairs = at.alias("l").join(at.alias("r"), (F.col("l.project") == F.col("r.project")) & (F.col("l.top") < F.col("r.top")))
    return pairs.groupBy(F.col("l.top").alias("top_a"), F.col("r.top").alias("top_b")).agg(F.sum("l.n").alias("projects"))


def label_agreement(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row (n, nmi_millionths): normalised mutual information of two labelings, arithmetic mean of the entropies.

    Null for fewer than two rows; 1 if both labelings have one label, 0 if only one has.
    """
    c = pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("x"), F.col(b).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    cx, cy = c.groupBy("x").agg(F.sum("n").alias("nx")), c.groupBy("y").agg(F.sum("n").alias("ny"))
    total = c.agg(F.sum("n").alias("t"))
    entropy = lambda df, k, out: df.crossJoin(F.broadcast(total)).agg(F.sum(-(F.col(k) / F.col("t")) * F.log(F.col(k) / F.col("t"))).alias(out))
    mutual = c.join(cx, "x").join(cy, "y").crossJoin(F.broadcast(total)).agg(F.sum(F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("nx") * F.col("ny")))).alias("mi"))
    one = mutual.crossJoin(entropy(cx, "nx", "hx")).crossJoin(entropy(cy, "ny", "hy")).crossJoin(total)  # single rows
    tiny = 1e-12
    value = F.when(F.coalesce("t", F.lit(0)) < 2, F.lit(None)).when((F.col("hx") < tiny) & (F.col("hy") < tiny), 1.0).when((F.col("hx") < tiny) | (F.col("hy") < tiny), 0.0).otherwise(F.col("mi") / ((F.col("hx") + F.col("hy")) / 2))
    return one.select(F.coalesce("t", F.lit(0)).alias("n"), F.round(value * 1_000_000).cast("bigint").alias("nmi_millionths"))
