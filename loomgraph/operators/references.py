"""References to records that do not exist: a fixpoint cascade over foreign keys.

Direct orphans are references whose key no target table holds (``missing``),
holds no longer (``gone``) or holds only later (``late``). Records that rest on
an orphaned record are orphaned too, indirectly: their list is found by iterated
semi-joins down the foreign-key graph until no new record comes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.skew import salted_join
from loomgraph.session import cut

REPORT = ["table_name", "field_name", "row_key", "ref_month", "ref_state"]


def month_of(time: Column) -> Column:
    """``yyyy-MM`` in the session's zone (UTC), ``unknown`` for null."""
    return F.coalesce(F.date_format(time, "yyyy-MM"), F.lit("unknown"))


@dataclass
class KnowledgeTables:
    """The tables of the foreign-key graph, each with the columns it needs."""

    relations: DataFrame
    claims: DataFrame
    person: DataFrame
    project: DataFrame
    org_units: DataFrame
    documents: DataFrame


def entity_keys(t: KnowledgeTables) -> DataFrame:
    """(ref_key, held): each known entity key, held = not only in old person snapshots."""
    last = t.person.agg(F.max("snapshot_date")).first()[0]
    on_last = F.lit(False) if last is None else F.coalesce(F.col("snapshot_date") == F.lit(last), F.lit(False))
    keys = t.person.select(F.col("canonical_id").alias("ref_key"), on_last.alias("held"))
    for other in (t.project, t.org_units):
        keys = keys.unionByName(other.select(F.col("canonical_id").alias("ref_key"), F.lit(True).alias("held")))
    return keys.filter("ref_key IS NOT NULL").groupBy("ref_key").agg(F.max("held").alias("held"))


def direct_orphans(t: KnowledgeTables) -> DataFrame:
    """Direct orphans, distinct, with the columns REPORT.

    Nulls: a null reference is no reference. A null time gives month
    ``unknown``; without both times a claim is never ``late``. Repeated rows give
    one row. Empty tables: everything that refers to them is ``missing``.
    """
    refs = t.relations.select(
        F.col("relation_id").alias("row_key"),
        month_of(F.col("last_observed_at")).alias("ref_month"),
        F.explode(
            F.array(
                F.struct(F.lit("source_id").alias("field_name"), F.col("source_id").alias("ref_key")),
                F.struct(F.lit("target_id").alias("field_name"), F.col("target_id").alias("ref_key")),
            )
        ).alias("r"),
    ).select("row_key", "ref_month", "r.field_name", "r.ref_key").filter("ref_key IS NOT NULL")
    relation_side = salted_join(refs, entity_keys(t), "ref_key").select(
        F.lit("relations").alias("table_name"),
        "field_name",
        "row_key",
        "ref_month",
        F.when(F.col("held").isNull(), "missing").when(~F.col("held"), "gone").alias("ref_state"),
    )
    first_seen = (
        t.documents.filter("document_id IS NOT NULL")
        .groupBy("document_id")
        .agg(F.min("retrieved_at").alias("first_at"), F.lit(True).alias("known"))
    )
    claims = t.claims.select("claim_id", "document_id", "observed_at").filter("document_id IS NOT NULL")
    claim_side = salted_join(claims, first_seen, "document_id").select(
        F.lit("claims").alias("table_name"),
        F.lit("document_id").alias("field_name"),
        F.col("claim_id").alias("row_key"),
        month_of(F.col("observed_at")).alias("ref_month"),
        F.when(F.col("known").isNull(), "missing").when(F.col("first_at") > F.col("observed_at"), "late").alias("ref_state"),
    )
    return relation_side.unionByName(claim_side).filter("ref_state IS NOT NULL").distinct()


def orphan_cascade(t: KnowledgeTables, max_rounds: int = 100_000) -> DataFrame:
    """REPORT and (orphan_kind, depth): ``direct`` at depth 0, ``inherited`` below.

    Children: claims by ``derived_from`` (itself a chain of claims) and relations
    by ``claim_ids``. Each round semi-joins the links whose parent was found in
    the last round and keeps the children not met before; it ends when a round
    finds none, so cycles end too. A record that is a direct orphan is reported
    as direct only in the field concerned and may appear as inherited in another.
    A chain longer than ``max_rounds`` raises; nothing is left out.
    """
    direct = cut(direct_orphans(t))
    links = t.claims.filter("claim_id IS NOT NULL AND size(derived_from) > 0").select(
        F.col("claim_id").alias("child"), F.explode("derived_from").alias("parent")
    ).filter("parent IS NOT NULL AND parent <> child").distinct()
    reached = direct.filter("table_name = 'claims' AND row_key IS NOT NULL").select(F.col("row_key").alias("id"), F.lit(0).alias("depth")).distinct()
    reached = cut(reached)
    frontier, levels = reached, [reached]
    links = cut(links)
    for depth in range(1, max_rounds + 1):
        step = salted_join(links, frontier.select(F.col("id").alias("parent")), "parent", "left_semi")
        found = step.select(F.col("child").alias("id")).distinct().join(_union(levels).select("id"), "id", "left_anti")
        frontier = cut(found.withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        levels.append(frontier)
        if len(levels) > 16:  # long chains: one table for the levels so far keeps plans short
            levels = [cut(_union(levels))]
    else:
        raise RuntimeError("no fixpoint within max_rounds")
    orphans = _union(levels)
    by_claim = orphans.filter("depth > 0")
    claim_months = t.claims.select(F.col("claim_id").alias("id"), month_of(F.col("observed_at")).alias("ref_month"))
    inherited_claims = claim_months.join(by_claim, "id").select(
        F.lit("claims").alias("table_name"), F.lit("derived_from").alias("field_name"), F.col("id").alias("row_key"),
        "ref_month", F.lit("inherited").alias("ref_state"), "depth",
    ).distinct()
    relation_links = t.relations.select(
        "relation_id", month_of(F.col("last_observed_at")).alias("ref_month"), F.explode("claim_ids").alias("id")
    )
    inherited_relations = (
        salted_join(relation_links, orphans, "id", "inner")
        .groupBy("relation_id", "ref_month")
        .agg((F.min("depth") + 1).alias("depth"))
        .select(
            F.lit("relations").alias("table_name"), F.lit("claim_ids").alias("field_name"), F.col("relation_id").alias("row_key"),
            "ref_month", F.lit("inherited").alias("ref_state"), "depth",
        )
    )
    inherited = inherited_claims.unionByName(inherited_relations).withColumn("orphan_kind", F.lit("inherited"))
    return (
        direct.withColumn("depth", F.lit(0)).withColumn("orphan_kind", F.lit("direct")).unionByName(inherited)
        .select(*REPORT, "orphan_kind", "depth")
    )


def _union(levels: list[DataFrame]) -> DataFrame:
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def orphan_counts(report: DataFrame) -> DataFrame:
    """Counts per table, field, month, state and kind."""
    return report.groupBy("table_name", "field_name", "ref_month", "ref_state", "orphan_kind").agg(
        F.count(F.lit(1)).alias("n_refs"), F.countDistinct("row_key").alias("n_rows")
    )
