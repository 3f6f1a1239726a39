"""Graphs walked within tasks: the results of the joins, in a number of jobs that does not follow the depth."""

import random

import numpy as np
from pyspark.sql import functions as F

from loomgraph.operators import centrality, graph, held


def jobs(spark, f):
    """What f returns, and how many jobs it ran."""
    group = f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        return f(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_betweenness_of_a_long_ring(spark):
    n = 201
    ring = spark.createDataFrame([(f"{i:04d}", f"{(i + 1) % n:04d}") for i in range(n)], "src string, dst string")
    got, ran = jobs(spark, lambda: centrality.betweenness(ring).collect())
    assert len(got) == n and {round(r.betweenness, 6) for r in got} == {(n - 1) * (n - 3) / 8} and ran < 40


def test_betweenness_held_and_joined_agree(spark):
    rng = random.Random(5)
    edges = [(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}") for _ in range(55)] + [("x", "y"), ("y", "z"), ("é", "x"), ("alone", "alone")]
    df = spark.createDataFrame(edges, "src string, dst string")
    of = lambda limit: {r.id: (round(r.betweenness, 9), round(r.normalised, 9)) for r in centrality.betweenness(df, held=limit).collect()}
    assert of(10**6) == of(0) and "alone" not in of(10**6)
    assert centrality.betweenness(df.limit(0)).count() == 0


def test_hash_of_a_round_is_sparks(spark):
    rows = spark.range(50).select(F.concat(F.lit("n"), "id").alias("id")).select(F.xxhash64("id", F.lit(3)).alias("h"), *[F.xxhash64("id", F.lit(3), F.lit(k)).alias(f"h{k}") for k in (0, 7)]).collect()
    for k in (0, 7):
        assert held._hashed(k, np.array([r.h for r in rows])).tolist() == [r[f"h{k}"] for r in rows]


def test_communities_held_and_joined_agree(spark):
    rng = random.Random(2)
    members = [(f"p{rng.randrange(40)}", f"n{rng.randrange(60):02d}") for _ in range(130)]
    _, edges = graph.projection(spark.createDataFrame(members, "project string, person string"), "size_discounted")
    edges = edges.select(F.col("a").alias("src"), F.col("b").alias("dst"), "weight").localCheckpoint()
    of = lambda limit: {r.id: r.community for r in centrality.communities(edges, held=limit).collect()}
    whole, ran = jobs(spark, lambda: of(10**6))
    assert whole == of(0) == of(60) and 1 < len(set(whole.values())) < len(whole) and ran < 20
