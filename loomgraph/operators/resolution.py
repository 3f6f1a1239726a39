"""Entity resolution: candidate pairs, verdicts, blocked clustering, stable ids."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.graph import components
from loomgraph.operators.skew import salted_join
from loomgraph.session import cut

#: A block with more records is split.
BLOCK_ROWS = 20_000


def candidate_pairs(records: DataFrame) -> DataFrame:
    """(a, b): pairs that share a hard id or an order-free name key, each once.

    records (ref, keys, free_keys, hard_ids, family, slug), arrays never null. An
    empty key blocks nothing; a block of more than BLOCK_ROWS records is split.
    """
    keys = F.concat(F.transform("hard_ids", lambda x: F.concat(F.lit("id|"), x)), F.transform("free_keys", lambda x: F.concat(F.lit("name|"), x)))
    blocks = cut(records.select("ref", F.explode(keys).alias("block")).filter("block <> 'name|'").distinct())
    met = salted_join(blocks.select("block", F.col("ref").alias("a")), blocks.select("block", F.col("ref").alias("b")), "block", "inner", BLOCK_ROWS)
    return met.filter("a < b").select("a", "b").distinct()


def pair_verdicts(records: DataFrame) -> DataFrame:
    """(a, b, status, method, score): the first rule that holds decides.

    A kind of hard id that both state without a common value rejects, whatever
    other kinds say; a common id with compatible names (a common key of any of
    their labels, in order or not) confirms; a common id alone, or the same name
    alone, is possible (score .6, and .4 plus .15 for the same site family and
    the same profile slug each). Same names are never merged automatically.
    """
    of = lambda s: records.select(F.col("ref").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("keys", "free_keys", "hard_ids", "family", "slug")])
    p = candidate_pairs(records).join(of("a"), "a").join(of("b"), "b")
    kind = lambda v: F.substring_index(v, ":", 1)
    shared = F.array_intersect("a_hard_ids", "b_hard_ids")
    both = F.array_intersect(F.transform("a_hard_ids", kind), F.transform("b_hard_ids", kind))
    p = p.select("*", shared.alias("shared"), F.transform(shared, kind).alias("shared_kinds"), both.alias("kinds"))
    conflict = F.size(F.array_except("kinds", "shared_kinds")) > 0
    agree = F.size("shared") > 0
    names = F.arrays_overlap(F.concat("a_keys", "a_free_keys"), F.concat("b_keys", "b_free_keys"))
    same = lambda c: F.coalesce(F.col(f"a_{c}") == F.col(f"b_{c}"), F.lit(False)).cast("int")
    rule = lambda status, method, score: F.struct(F.lit(status).alias("status"), F.lit(method).alias("method"), score.alias("score"))
    verdict = (
        F.when(conflict, rule("REJECTED", "auto:conflicting_hard_id", F.lit(0.0))).when(agree & names, rule("CONFIRMED", "auto:hard_id+name", F.lit(1.0)))
        .when(agree, rule("POSSIBLE", "auto:hard_id_name_mismatch", F.lit(0.6))).otherwise(rule("POSSIBLE", "auto:same_name", F.least(F.lit(0.85), F.round(0.4 + 0.15 * (same("family") + same("slug")), 2))))
    )
    return p.select("a", "b", verdict.alias("v")).select("a", "b", "v.*")


def structural_matches(records: DataFrame) -> DataFrame:
    """(left, right, entity_type, method, score): records (ref, t, k) of one type and name key
    within one site, each joined to the first of its group."""
    o = records.withColumn("site", F.substring_index("ref", "|", 1))
    first = o.groupBy("t", "site", "k").agg(F.min("ref").alias("left"))
    return o.join(first, ["t", "site", "k"]).filter("ref <> left").select("left", F.col("ref").alias("right"), F.col("t").alias("entity_type"), F.lit("auto:same_site_same_name").alias("method"), F.lit(0.95).alias("score")).distinct()


def blocked_clusters(verdicts: DataFrame) -> DataFrame:
    """(ref, cluster): confirmed links joined in order (score descending, then a, b), where
    a link is left out if it would put two rejected records together.

    Components of the confirmed links without any rejected pair inside are taken
    as they are. Only those that hold one are replayed link by link, each in its
    own group, so the order-dependent part stays with the few that need it.
    """
    yes = cut(verdicts.filter("status = 'CONFIRMED'").select("a", "b", "score"))
    no = verdicts.filter("status = 'REJECTED'").select("a", "b")
    label = cut(components(yes.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    of = lambda s: label.select(F.col("id").alias(s), F.col("component").alias(f"{s}_c"))
    inside = cut(no.join(of("a"), "a").join(of("b"), "b").filter("a_c = b_c").select("a", "b", F.col("a_c").alias("component")))
    contested = inside.select("component").distinct()
    calm = label.join(contested, "component", "left_anti").select(F.col("id").alias("ref"), F.col("component").alias("cluster"))
    links = yes.join(of("a"), "a").select("a", "b", "score", F.col("a_c").alias("component"), F.lit(True).alias("yes")).join(contested, "component", "left_semi")
    both = links.unionByName(inside.select("a", "b", F.lit(0.0).alias("score"), "component", F.lit(False).alias("yes")))

    def replay(group: pd.DataFrame) -> pd.DataFrame:
        root: dict[str, str] = {}

        def find(x: str) -> str:
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        barred = [(r.a, r.b) for r in group[~group.yes].itertuples()]
        for r in group[group.yes].sort_values(["score", "a", "b"], ascending=[False, True, True]).itertuples():
            a, b = sorted((find(r.a), find(r.b)))
            if a != b and not any({find(x), find(y)} == {a, b} for x, y in barred):
                root[b] = a
        refs = sorted({*group.a, *group.b})
        return pd.DataFrame({"ref": refs, "cluster": [find(x) for x in refs]})

    return calm.unionByName(both.groupBy("component").applyInPandas(replay, "ref string, cluster string"))


def clusters_of(members: DataFrame) -> DataFrame:
    """(cluster, n, least_ref) of members (ref, cluster)."""
    return members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("ref").alias("least_ref"))


def assign_ids(members: DataFrame, known: DataFrame, survivors: DataFrame | None = None, strength: DataFrame | None = None, prefix: str = "ent_", max_rounds: int = 1000) -> DataFrame:
    """(ref, canonical_id, previous_id, is_new) of each member.

    members (ref, cluster), known (ref, canonical_id, assigned_at; ref unique).
    Clusters come in the order of their oldest assignment, then of their least
    reference; each takes the first of its members' ids that no earlier one took:
    ids a reviewer named (survivors: canonical_id) first, then by oldest
    assignment, greatest strength (ref, strength), the id itself. Without one an
    id is made from the least reference. previous_id: what a member had before,
    if another. Rounds of proposals: a cluster proposes its best id not yet lost,
    an id keeps the earliest cluster; that ends where the ordered loop would.
    """
    known = cut(known)
    stated = members.join(known, "ref")
    if strength is not None:
        stated = stated.join(strength, "ref", "left")
    else:
        stated = stated.withColumn("strength", F.lit(0))
    options = stated.groupBy("cluster", "canonical_id").agg(F.min("assigned_at").alias("at"), F.max(F.coalesce("strength", F.lit(0))).alias("s"))
    named = (survivors.select("canonical_id").distinct() if survivors is not None else known.select("canonical_id").limit(0)).withColumn("named", F.lit(0))
    options = options.join(named, "canonical_id", "left").withColumn("named", F.coalesce("named", F.lit(1)))
    order = members.join(known.select("ref", "assigned_at"), "ref", "left").groupBy("cluster").agg(F.min(F.struct(F.col("assigned_at").isNull().alias("late"), "assigned_at")).alias("a"), F.min("ref").alias("least"))
    turn = order.select("cluster", "least", F.struct("a", "least").alias("turn"))
    options = cut(options.join(turn.select("cluster", "turn"), "cluster").select("cluster", "canonical_id", "turn", F.struct("named", "at", (-F.col("s")).alias("s"), "canonical_id").alias("wish")))
    lost = options.select("cluster", "canonical_id").limit(0)
    for _ in range(max_rounds):
        left = options.join(lost, ["cluster", "canonical_id"], "left_anti")
        asks = left.groupBy("cluster").agg(F.min("wish").alias("w"), F.first("turn").alias("turn")).select("cluster", "turn", F.col("w.canonical_id").alias("canonical_id"))
        asks = cut(asks)
        holds = asks.groupBy("canonical_id").agg(F.min(F.struct("turn", "cluster")).alias("h")).select("canonical_id", F.col("h.cluster").alias("cluster"))
        refused = asks.select("cluster", "canonical_id").join(holds, ["canonical_id", "cluster"], "left_anti").select("cluster", "canonical_id")
        lost_now = cut(lost.unionByName(refused))
        if refused.isEmpty():
            break
        lost = lost_now
    else:
        raise RuntimeError("no fixpoint within max_rounds")
    kept = asks.select("cluster", F.col("canonical_id").alias("held"))
    ids = turn.join(kept, "cluster", "left").select("cluster", F.coalesce("held", F.concat(F.lit(prefix), F.substring(F.sha1("least"), 1, 10))).alias("canonical_id"), F.col("held").isNull().alias("is_new"))
    j = members.join(ids, "cluster").join(known.select("ref", F.col("canonical_id").alias("before")), "ref", "left")
    return j.select("ref", "canonical_id", F.when(F.col("before") != F.col("canonical_id"), F.col("before")).alias("previous_id"), "is_new")


def anchored_only(members: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of clusters with at least one anchored reference (anchors: ref), and the others, which are mentions and lose their ids."""
    keep = members.join(anchors.select("ref").distinct(), "ref", "left_semi").select("cluster").distinct()
    return members.join(keep, "cluster", "left_semi"), members.join(keep, "cluster", "left_anti")


def stable_ids(clusters: DataFrame, known: DataFrame) -> DataFrame:
    """(ref, canonical_id, is_new): a cluster keeps the oldest known id of its members.

    known (ref, canonical_id, assigned_at). Ties: the smaller id. If two clusters
    claim one id, the cluster with the smaller name keeps it. Others get an id
    from the smallest reference's hash.
    """
    claims = clusters.join(known, "ref").groupBy("cluster", "canonical_id").agg(F.min("assigned_at").alias("at"))
    choice = claims.groupBy("cluster").agg(F.min(F.struct("at", "canonical_id")).alias("c")).select("cluster", F.col("c.canonical_id").alias("old"))
    keeper = choice.groupBy("old").agg(F.min("cluster").alias("cluster"))
    minted = clusters.groupBy("cluster").agg(F.min("ref").alias("least"))
    ids = minted.join(keeper, "cluster", "left").select("cluster", F.coalesce("old", F.concat(F.lit("ent_"), F.substring(F.sha1("least"), 1, 10))).alias("canonical_id"), F.col("old").isNull().alias("is_new"))
    return clusters.join(ids, "cluster").select("ref", "canonical_id", "is_new")
