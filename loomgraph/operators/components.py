"""Connected components over edges of numbers, by least labels and pointer jumping.

Each round every node takes the least label of its neighbourhood as parent,
parents are replaced by their parents until every tree is flat, and the edges
are rewritten to the roots, where loops and repetitions drop out. A chain of n
nodes needs O(log n) rounds, a star two. The labels and edges of each round are
cut; the loop ends when no edge is left, that is no label changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.skew import ROWS_LIMIT, salted_join
from loomgraph.session import cut, cut_measured


def flatten(parents: DataFrame, rows: int, rows_limit: int) -> DataFrame:
    """Pointer jumping: (v, p) with p = root of v. Each cut step follows three more
    pointers, so a path of length n takes log4(n) steps. Nodes that point to a root
    are settled and join no more: the members of the largest group, which all share
    one parent then, are not joined again and again. Joins on a shared parent are
    salted as soon as more than ``rows_limit`` rows are open."""
    settled, active = None, parents
    while rows:
        known = active if settled is None else active.unionByName(settled)
        up = known.select(F.col("v").alias("p"), F.col("p").alias("up"))
        out = active.withColumn("below", F.col("p"))
        for _ in range(3):
            joined = salted_join(out, up, "p", "inner", rows_limit) if rows > rows_limit else out.join(up, "p")
            out = joined.select("v", F.col("p").alias("below"), F.col("up").alias("p"))
        out, seen = cut_measured(out.select("v", "p", (F.col("p") == F.col("below")).alias("done")), open=F.count_if(~F.col("done")))
        rows = seen["open"]
        ended = out.filter("done").select("v", "p")
        settled = ended if settled is None else settled.unionByName(ended)
        active = out.filter("NOT done").select("v", "p")
    return parents if settled is None else settled


def to_roots(edges: DataFrame, parents: DataFrame, end: str, hot: bool, rows_limit: int) -> DataFrame:
    """Rewrites one end of the edges by ``parents`` (v, p)."""
    to = parents.select(F.col("v").alias(end), F.col("p").alias("_p"))
    joined = salted_join(edges, to, end, "inner", rows_limit) if hot else edges.join(to, end)
    return joined.drop(end).withColumnRenamed("_p", end)


def components(edges: DataFrame, rows_limit: int = ROWS_LIMIT, max_rounds: int = 100) -> DataFrame:
    """(v, label) for the nodes of ``edges`` (a, b: bigint): label = least node of the component.

    Loops and repeated edges are harmless. An empty edge table gives no rows. A
    round salts its joins only if some node has more than ``rows_limit`` edges.
    """
    count = {"n": F.count(F.lit(1))}
    edges, seen = cut_measured(edges.filter("a <> b"), **count)
    labels, root_labels = None, []
    for _ in range(max_rounds):
        if not seen["n"]:
            break
        both = F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("n")), F.struct(F.col("b").alias("v"), F.col("a").alias("n"))))
        least = edges.select(both.alias("e")).groupBy(F.col("e.v").alias("v")).agg(F.min("e.n").alias("n"), F.count(F.lit(1)).alias("d"))
        parents, degree = cut_measured(least.select("v", F.least("v", "n").alias("p"), "d"), top=F.max("d"), n=F.count(F.lit(1)))
        parents = flatten(parents.select("v", "p"), degree["n"], rows_limit)
        hot = degree["top"] > rows_limit
        for end in ("a", "b"):
            edges = to_roots(edges, parents, end, hot, rows_limit)
        contracted = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges, seen = cut_measured(contracted, **count)
        root_labels.append(parents)
    else:
        raise RuntimeError("no fixpoint within max_rounds")
    if not root_labels:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("label"))
    # later rounds hold roots only: compose from the last to the first, the small maps first
    labels = root_labels[-1].withColumnRenamed("p", "label")
    for parents in reversed(root_labels[:-1]):
        over = labels.select(F.col("v").alias("p"), "label")
        labels = salted_join(parents, over, "p", "left", rows_limit).select("v", F.coalesce("label", "p").alias("label"))
    return labels


def numbered(pairs: DataFrame, rows_limit: int = ROWS_LIMIT) -> tuple[DataFrame, DataFrame]:
    """Edges of strings (a, b) as edges of numbers, and (ref, id): numbers in string order."""
    degrees = pairs.select(F.explode(F.array("a", "b")).alias("ref")).groupBy("ref").agg(F.count(F.lit(1)).alias("d"))
    numbers, degree = cut_measured(degrees.orderBy("ref").select("ref", F.monotonically_increasing_id().alias("id"), "d"), top=F.max("d"))
    hot = (degree["top"] or 0) > rows_limit
    edges = pairs
    for end in ("a", "b"):
        edges = to_roots(edges, numbers.select(F.col("ref").alias("v"), F.col("id").alias("p")), end, hot, rows_limit)
    return edges.select("a", "b"), numbers.select("ref", "id")


def labelled(pairs: DataFrame, rows_limit: int = ROWS_LIMIT) -> DataFrame:
    """(ref, label): each string of ``pairs`` (a, b) with the smallest string of its component."""
    edges, numbers = numbered(pairs, rows_limit)
    labels = components(edges, rows_limit)
    names = numbers.select(F.col("id").alias("label"), F.col("ref").alias("name"))
    grouped = salted_join(labels, names, "label", "inner", rows_limit).select(F.col("v").alias("id"), "name")
    return grouped.join(numbers, "id").select("ref", F.col("name").alias("label"))
