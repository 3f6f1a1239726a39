"""Betweenness and communities. Graphs of up to ``held`` links are walked within tasks (``operators/held.py``), larger
ones with joins only, so that no task holds them; the results are the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.held import HELD, dependency_sums, settled
from loomgraph.session import cut, cut_measured


def _both(edges: DataFrame) -> DataFrame:
    e = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).filter("a <> b").distinct()
    return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def betweenness(edges: DataFrame, max_depth: int = 100_000, held: int = HELD) -> DataFrame:
    """(id, betweenness, normalised) of an unweighted, undirected graph, each pair counted once;
    normalised by the number of pairs of other nodes. Paths beyond ``max_depth`` raise.

    Brandes' method: breadth-first levels carry the number of shortest paths,
    dependencies flow back level by level; the work is nodes times edges by
    nature. A graph of up to ``held`` links is walked source by source within
    tasks; beyond that all sources are joined at once, with states of (source,
    node) pairs.
    """
    both, size = cut_measured(_both(edges), n=F.count(F.lit(1)))
    if size["n"] <= held:
        nodes, sums = dependency_sums(both, max_depth)
        return _scored(nodes, sums.join(nodes, "k").select("id", (F.col("delta") / 2).alias("betweenness")))
    level = cut(both.select(F.col("a").alias("s")).distinct().select("s", F.col("s").alias("v"), F.lit(1.0).alias("sigma")))
    levels = [level]
    for _ in range(max_depth):
        step = levels[-1].join(both, F.col("v") == F.col("a")).groupBy("s", F.col("b").alias("v")).agg(F.sum("sigma").alias("sigma"))
        for seen in levels[-2:]:  # a neighbour of a level lies one before, on or one behind it
            step = step.join(seen.select("s", "v"), ["s", "v"], "left_anti")
        step = cut(step)
        if step.isEmpty():
            break
        levels.append(step)
    else:
        raise RuntimeError("no fixpoint within max_depth")
    total, below = None, None
    for k in range(len(levels) - 1, 0, -1):
        here = levels[k].withColumn("delta", F.lit(0.0)) if below is None else levels[k].join(below, ["s", "v"], "left").select("s", "v", "sigma", F.coalesce("delta", F.lit(0.0)).alias("delta"))
        total = here.select("v", "delta") if total is None else total.unionByName(here.select("v", "delta"))
        give = here.select("s", F.col("v").alias("w"), ((1 + F.col("delta")) / F.col("sigma")).alias("c")).join(both, F.col("w") == F.col("a"))
        to = give.select("s", F.col("b").alias("v"), "c").join(levels[k - 1], ["s", "v"])
        below = cut(to.groupBy("s", "v").agg(F.sum(F.col("sigma") * F.col("c")).alias("delta")))
    nodes = levels[0].select(F.col("v").alias("id"))
    return _scored(nodes, total and total.groupBy(F.col("v").alias("id")).agg((F.sum("delta") / 2).alias("betweenness")))


def _scored(nodes: DataFrame, sums: DataFrame | None) -> DataFrame:
    """(id, betweenness, normalised) of all nodes (id); zero where sums (id, betweenness) has no row."""
    others = nodes.count()
    pairs = (others - 1) * (others - 2) / 2
    of = lambda c: (c / pairs if pairs else F.lit(0.0)).alias("normalised")
    if sums is None:
        return nodes.select("id", F.lit(0.0).alias("betweenness"), F.lit(0.0).alias("normalised"))
    between = F.coalesce("betweenness", F.lit(0.0))
    return nodes.join(sums, "id", "left").select("id", between.alias("betweenness"), of(between))


def communities(edges: DataFrame, seed: int = 0, max_rounds: int = 200, held: int = HELD) -> DataFrame:
    """(id, community) by modularity: local moves until none gains, then communities become nodes, and so on.

    edges (src, dst) or (src, dst, weight). In a round the nodes of one half (by
    a hash of node, seed and round) move to the neighbouring community of the
    greatest positive gain; halves keep neighbours from swapping places. A level
    ends when two rounds in a row, one for each half, move nobody; the whole ends
    when a level leaves every node alone. Communities are numbered by size, then
    by their least member. ``max_rounds`` of one level without an end raise. The
    levels of up to ``held`` links are settled in one task, those before by joins.
    """
    w = F.col("weight") if "weight" in edges.columns else F.lit(1.0)
    e = edges.filter("src <> dst").groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.max(w).alias("w"))
    level, size = cut_measured(e.select("a", "b", "w").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")), n=F.count(F.lit(1)))
    members = None
    while True:
        place, moved = (settled(level, seed, max_rounds), False) if size["n"] <= held else _moves(level, seed, max_rounds)
        members = place if members is None else cut(members.withColumnRenamed("c", "m").join(place.withColumnRenamed("id", "m"), "m").select("id", "c"))
        if not moved:
            break
        of = lambda end: place.select(F.col("id").alias(end), F.col("c").alias(f"c{end}"))
        level, size = cut_measured(level.join(of("a"), "a").join(of("b"), "b").groupBy(F.col("ca").alias("a"), F.col("cb").alias("b")).agg(F.sum("w").alias("w")), n=F.count(F.lit(1)))
    sizes = members.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    from pyspark.sql import Window

    order = sizes.withColumn("community", F.row_number().over(Window.orderBy(F.desc("n"), "least")) - 1)  # one row a community
    return members.join(order, "c").select("id", "community")


def _moves(links: DataFrame, seed: int, max_rounds: int) -> tuple[DataFrame, bool]:
    """(id, c) after local moves over links (a, b, w; both ways, loops once), and whether anybody moved."""
    degree, seen = cut_measured(links.groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("d")), t=F.sum("d"))
    twice_m = seen["t"]
    place = degree.select("id", "d", F.col("id").alias("c"))
    if not twice_m:
        return place.select("id", "c"), False
    ever, quiet = False, 0
    for k in range(max_rounds):
        totals = place.groupBy("c").agg(F.sum("d").alias("t"))
        near = links.filter("a <> b").join(place.select(F.col("id").alias("b"), "c"), "b").groupBy(F.col("a").alias("id"), "c").agg(F.sum("w").alias("links"))
        own = place.select("id", "d", F.col("c").alias("own"))
        stay = own.select("id", F.col("own").alias("c"), F.lit(0.0).alias("links"))
        options = near.unionByName(stay).groupBy("id", "c").agg(F.sum("links").alias("links")).join(totals, "c").join(own, "id")
        rest = F.col("t") - F.when(F.col("c") == F.col("own"), F.col("d")).otherwise(0.0)
        gain = F.col("links") - F.col("d") * rest / F.lit(float(twice_m))
        best = options.withColumn("gain", gain).groupBy("id").agg(
            F.max(F.struct(F.round("gain", 9).alias("gain"), (F.col("c") == F.col("own")).alias("stay"), -F.xxhash64("c", F.lit(seed)), "c")).alias("best"), F.max(F.when(F.col("c") == F.col("own"), F.col("gain"))).alias("now"), F.max("own").alias("own"), F.max("d").alias("d"))
        turn = F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k // 2)), F.lit(2)) == k % 2
        goes = turn & (F.col("best.gain") > F.col("now") + 1e-9)
        place, figures = cut_measured(best.select("id", "d", F.when(goes, F.col("best.c")).otherwise(F.col("own")).alias("c"), goes.alias("goes")), moved=F.count_if("goes"))
        place = place.select("id", "d", "c")
        ever, quiet = ever or figures["moved"] > 0, 0 if figures["moved"] else quiet + 1
        if quiet == 2:
            return place.select("id", "c"), ever
    raise RuntimeError("no fixpoint within max_rounds")
