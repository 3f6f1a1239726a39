"""Routing of linked addresses: whose host it is, how far the statement can be trusted, and what becomes of the link.

The registry is a table (source_id, host, verified array<string>, inferred
array<string>, enabled, in_run, suffix). Hosts are matched by equi-joins only: a
host is taken apart into its suffixes instead of being compared with every entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import urls
from loomgraph.operators.skew import salted_join

# What is known of the host a link was written with, from certain to unknown, and the order in which the least certain is reported.
STATUSES = ["canonical", "verified", "inferred", "unknown"]
WORST_FIRST = ["inferred", "unknown", "verified", "canonical"]


def alias_table(registry: DataFrame) -> DataFrame:
    """(host, canonical, status) of every host the registry knows, the most certain status of each."""
    pairs = F.concat(
        F.array(F.struct(F.col("host").alias("h"), F.lit(0).alias("s"))), F.transform("verified", lambda x: F.struct(F.lower(x).alias("h"), F.lit(1).alias("s"))),
        F.transform("inferred", lambda x: F.struct(F.lower(x).alias("h"), F.lit(2).alias("s"))),
    )
    rows = registry.filter("host IS NOT NULL").select(F.col("host").alias("canonical"), F.explode(pairs).alias("p"))
    best = rows.groupBy(F.col("p.h").alias("host")).agg(F.min(F.struct("p.s", "canonical")).alias("b"))
    return best.select("host", "b.canonical", F.element_at(F.array(*map(F.lit, STATUSES)), F.col("b.s") + 1).alias("status"))


def host_scopes(hosts: DataFrame, registry: DataFrame) -> DataFrame:
    """(host, scope, owner, reason) of distinct hosts: a source's own host first, then a suffix of an institution."""
    h = hosts.filter("host IS NOT NULL").select("host").distinct()
    own = registry.groupBy("host").agg(F.min(F.struct("source_id", "enabled")).alias("o"))
    labels = F.split("host", r"\.")
    tails = h.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("suffix"))
    near = tails.join(registry.select("suffix").filter("suffix IS NOT NULL").distinct(), "suffix", "left_semi").select("host", F.lit(True).alias("near")).distinct()
    j = h.join(own, "host", "left").join(near, "host", "left")
    owned, on = F.col("o").isNotNull(), F.col("o.enabled")
    scope = F.when(owned & on, "in_scope").when(owned | F.col("near"), "other_unit_site").otherwise("external")
    reason = F.when(owned & on, F.lit(None)).when(owned, "source_not_enabled").when(F.col("near"), "site_not_registered").otherwise("external_host")
    return j.select("host", scope.alias("scope"), F.col("o.source_id").alias("owner"), reason.alias("reason"))


def route(links: DataFrame, registry: DataFrame, fetched: DataFrame, path_ok: Column) -> DataFrame:
    """(url, host, scope, owner, host_status, decision, reason, n_stated, n_via): one row for each linked address.

    links (url, stated, via): the canonical address, as written, and by which
    source. fetched (url): addresses already there. path_ok: is ``url`` of a
    project page's shape? The first condition that holds decides: no web address,
    the scope, an alias nobody verified, a source outside of this run, the path.
    """
    known = alias_table(registry)
    stated = links.select("url", "stated", "via", urls.host(F.col("stated")).alias("stated_host"))
    stated = salted_join(stated, known.select(F.col("host").alias("stated_host"), "status"), "stated_host").withColumn("status", F.coalesce("status", F.lit("unknown")))
    worst = F.lit(len(WORST_FIRST))
    for k, s in enumerate(WORST_FIRST):
        worst = F.when(F.col("status") == s, k).otherwise(worst)
    per = stated.groupBy("url").agg(F.min(worst).alias("w"), F.bool_or(F.col("status").isin("canonical", "verified")).alias("trusted"), F.countDistinct("stated").alias("n_stated"), F.countDistinct("via").alias("n_via"))
    per = per.withColumn("host_status", F.element_at(F.array(*map(F.lit, WORST_FIRST)), F.col("w") + 1)).withColumn("host", urls.host(F.col("url")))
    scoped = salted_join(per, host_scopes(per, registry), "host")
    runs = registry.select(F.col("source_id").alias("owner"), "in_run")
    there = fetched.select("url").distinct().withColumn("there", F.lit(True))
    j = scoped.join(runs, "owner", "left").join(there, "url", "left")
    inside = F.col("scope") == "in_scope"
    why = (
        F.when(~F.coalesce(F.col("url").rlike("^https?://"), F.lit(False)), "not_http").when(~inside | F.col("scope").isNull(), F.coalesce("reason", F.lit("external_host")))
        .when((F.col("host_status") == "inferred") & ~F.col("trusted"), "alias_unverified").when(~F.coalesce("in_run", F.lit(False)), "owner_not_in_run").when(~path_ok, "not_project_path")
    )
    decision = F.when(why.isNotNull(), "skipped").when(F.col("there"), "already_fetched").otherwise("enqueued")
    return j.select("url", "host", F.coalesce("scope", F.lit("external")).alias("scope"), "owner", "host_status", decision.alias("decision"), why.alias("reason"), "n_stated", "n_via")
