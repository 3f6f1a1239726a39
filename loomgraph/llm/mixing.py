"""Mixing sources to target weights as a min-cost flow.

The same text may come from several sources. Distinct texts are aggregated by
membership pattern, the set of sources they occur in; a pattern's token mass may
be used again at growing cost, one unit more for each further pass, which makes
the costs convex. Token capacity flows from patterns to source quotas at least
cost, so unused text goes before repeated text and texts of several sources go
where they save repetition. The network has one node for each pattern (at most
2**sources, whatever the corpus) and is solved on the driver.

Each pattern's texts lie on a tape in seeded order. The flows to its sources are
laid side by side along the passes of the tape, and a source takes a text as
often as its stretch meets the text's beginning, never more than its cap. Places
on the tape come from sums over hash buckets, so no pattern is gathered.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.bpe import token_counts
from loomgraph.session import cut, cut_measured

#: Seeded order: hash buckets of a pattern, each summed before texts are placed within it. Buckets are
#: prefixes of the hash that orders the tape, so their number does not change the result; it grows with
#: the texts so that a bucket holds about BUCKET_TEXTS of them.
BUCKET_BITS, BUCKET_TEXTS = 12, 65_536


def min_cost_flow(masses: dict[tuple[str, ...], int], quotas: dict[str, int], caps: dict[str, int]) -> dict[tuple[tuple[str, ...], str], int]:
    """(pattern, source) -> tokens: fills the quotas as far as they can be filled, at least cost.

    A pattern of mass m feeds a source at most caps[source] * m and pass k of it
    costs k a token. Successive shortest paths on the residual network.
    """
    nodes = {("in",): 0, ("out",): 1}
    graph: list[list[int]] = [[], []]
    to, cap, cost = [], [], []

    def node(x: tuple) -> int:
        if x not in nodes:
            nodes[x] = len(graph)
            graph.append([])
        return nodes[x]

    def arc(a: int, b: int, c: int, w: int) -> int:
        for u, v, k, x in ((a, b, c, w), (b, a, 0, -w)):
            graph[u].append(len(to))
            to.append(v), cap.append(k), cost.append(x)
        return len(to) - 2

    used = {}
    for pattern, mass in sorted(masses.items()):
        mine = [s for s in pattern if quotas.get(s, 0) > 0 and caps.get(s, 0) > 0]
        if not mine or mass <= 0:
            continue
        p = node(("p", pattern))
        for k in range(sum(caps[s] for s in mine)):
            arc(0, p, mass, k)
        for s in mine:
            used[pattern, s] = arc(p, node(("s", s)), mass * caps[s], 0)
    for s, quota in sorted(quotas.items()):
        if ("s", s) in nodes:
            arc(nodes["s", s], 1, quota, 0)
    while True:
        best, via, queued = {0: 0}, {}, deque([0])
        while queued:
            u = queued.popleft()
            for e in graph[u]:
                if cap[e] > 0 and best[u] + cost[e] < best.get(to[e], 1 << 60):
                    best[to[e]], via[to[e]] = best[u] + cost[e], e
                    queued.append(to[e])
        if 1 not in best:
            break
        path, v = [], 1
        while v:
            path.append(via[v])
            v = to[via[v] ^ 1]
        push = min(cap[e] for e in path)
        for e in path:
            cap[e] -= push
            cap[e ^ 1] += push
    return {k: cap[e ^ 1] for k, e in used.items() if cap[e ^ 1] > 0}


class Mix:
    """A plan over documents: ``rows`` are the drawn documents, ``shares`` the report."""

    def __init__(self, documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7, path: str | None = None):
        """``documents`` (doc_id, text, source), ``targets`` (source, target_share, max_repeats).

        total_tokens: size of the mix; by default the largest for which every
        source that has text meets its quota. Empty and null texts have no
        tokens and are never drawn; documents of a null or unlisted source are
        left out; a listed source without text gets nothing and its share is
        reported as not met. Of equal texts of one source the least doc_id stands.
        """
        self.seed = seed
        plans = targets.groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("repeats")).filter("source IS NOT NULL").collect()
        self.share = {r["source"]: r["share"] or 0.0 for r in plans}
        self.caps = {r["source"]: max(0, r["repeats"] or 0) for r in plans}
        listed = documents.filter(F.col("source").isin(*self.share) & (F.length("text") > 0)) if self.share else documents.filter("false")
        keyed = listed.select("doc_id", "source", F.sha2("text", 256).alias("content"), "text")
        self.docs = cut(token_counts(keyed, ["doc_id", "source", "content"], "text", path))
        by_source = self.docs.groupBy("content", "source").agg(F.min("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"))
        texts, size = cut_measured(
            by_source.groupBy("content").agg(F.array_sort(F.collect_set("source")).alias("pattern"), F.max("n_tokens").alias("n_tokens")).withColumn("h", F.xxhash64("content", F.lit(seed))),
            n=F.count(F.lit(1)),
        )
        bits = max(BUCKET_BITS, (size["n"] // BUCKET_TEXTS).bit_length())
        self.texts = texts.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits))
        self.by_source = by_source.select("content", "source", "doc_id")
        self.masses = {tuple(r["pattern"]): r["m"] for r in self.texts.groupBy("pattern").agg(F.sum("n_tokens").alias("m")).collect()}  # <= 2**sources rows
        self.available = {s: sum(m for p, m in self.masses.items() if s in p) for s in self.share}
        limits = [self.available[s] * self.caps[s] / w for s, w in self.share.items() if w > 0 and self.available[s] * self.caps[s] > 0]
        self.total = int(min(limits, default=0)) if total_tokens is None else total_tokens
        self.quotas = {s: int(w * self.total) for s, w in self.share.items()}
        self.flow = min_cost_flow(self.masses, self.quotas, self.caps)

    def rows(self) -> DataFrame:
        """(doc_id, source, n_tokens, repeats): each drawn document and how often it is taken."""
        spark = self.texts.sparkSession
        stretches, at = [], {}
        for (pattern, source), tokens in sorted(self.flow.items()):
            begin = at.get(pattern, 0)
            at[pattern] = begin + tokens
            stretches.append((list(pattern), source, begin, begin + tokens, self.masses[pattern]))
        plan = spark.createDataFrame(stretches, "pattern array<string>, source string, lo bigint, hi bigint, mass bigint")
        before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        buckets = self.texts.groupBy("pattern", "bucket").agg(F.sum("n_tokens").alias("b")).select("pattern", "bucket", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("base"))
        within = Window.partitionBy("pattern", "bucket").orderBy("h", "content").rowsBetween(Window.unboundedPreceding, -1)
        placed = (
            self.texts.withColumn("ahead", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
            .join(buckets, ["pattern", "bucket"])
            .select("content", "pattern", "n_tokens", (F.col("base") + F.col("ahead")).alias("x"))
        )
        meets = lambda end: F.greatest(F.lit(0), F.ceil((F.col(end) - F.col("x")) / F.col("mass")))
        drawn = placed.join(F.broadcast(plan), "pattern").withColumn("repeats", (meets("hi") - meets("lo")).cast("int")).filter("repeats > 0")
        return drawn.join(self.by_source, ["content", "source"]).select("doc_id", "source", "n_tokens", "repeats")

    def shares(self) -> DataFrame:
        """A row for each listed source: target and actual share, sizes, repetition, state.

        actual_share refers to the drawn total, share_of_plan to the planned one;
        they differ if a listed source has too little text.
        """
        spark = self.texts.sparkSession
        listed = spark.createDataFrame(
            [(s, float(self.share[s]), self.caps[s], self.available[s], self.quotas[s]) for s in sorted(self.share)],
            "source string, target_share double, max_repeats int, available_tokens bigint, target_tokens bigint",
        )
        drawn = self.rows().groupBy("source").agg(
            F.sum(F.col("n_tokens") * F.col("repeats")).alias("actual_tokens"), F.count(F.lit(1)).alias("n_documents"), F.max("repeats").alias("most_repeats")
        )
        total = F.sum("actual_tokens").over(Window.partitionBy(F.lit(0)))  # over the listed sources, a handful of rows
        out = listed.join(drawn, "source", "left").fillna(0, ["actual_tokens", "n_documents", "most_repeats"])
        return out.withColumn("actual_share", F.when(total > 0, F.col("actual_tokens") / total).otherwise(0.0)).withColumn(
            "share_of_plan", F.col("actual_tokens") / F.lit(float(max(1, self.total)))
        ).withColumn(
            "state", F.when(F.col("available_tokens") == 0, "no text").when(F.col("actual_tokens") < F.col("target_tokens") * 0.99, "short").otherwise("met")
        )
