"""Graphs whose links one task can hold: numbered once, then walked over arrays instead of joined step by step.

``HELD`` bounds the links (both ways) of such a graph, and with it what the driver
and a task hold; larger graphs take the joins of ``operators/centrality.py``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.session import cut

HELD = 4_000_000


def _numbered(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table, pa.Array, np.ndarray, np.ndarray] | None:
    """(rows, names, a, b): the ends a and b of the rows as places in the sorted names; nothing for no rows."""
    rows = pa.Table.from_batches(kept) if (kept := [x for x in batches if x.num_rows]) else None
    if rows is None:
        return None
    ends = pa.chunked_array([*rows["a"].chunks, *rows["b"].chunks]).dictionary_encode().combine_chunks()
    order = pa.compute.sort_indices(ends.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    codes = place[ends.indices.to_numpy()]
    return rows, ends.dictionary.take(pa.array(order)), codes[: rows.num_rows], codes[rows.num_rows :]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, k) of each node and, without id, the links as bytes: k = 0 where a node's links start, k = 1 where they lead."""
    found = _numbered(batches)
    if found is None:
        return
    _, names, a, b = found
    start = np.concatenate([[0], np.cumsum(np.bincount(a, minlength=len(names)))])
    to = b[np.argsort(a, kind="stable")].astype(np.int32)
    for at in range(0, len(names), 10_000):
        some = names.slice(at, 10_000)
        yield pa.record_batch([some, pa.array(np.arange(at, at + len(some))), pa.nulls(len(some), pa.binary())], ["id", "k", "blob"])
    yield pa.record_batch([pa.nulls(2, names.type), pa.array([0, 1], pa.int64()), pa.array([start.tobytes(), to.tobytes()], pa.binary())], ["id", "k", "blob"])


def dependencies(start: np.ndarray, to: np.ndarray, sources: np.ndarray, max_depth: int) -> np.ndarray:
    """Brandes' dependencies on each node, summed over ``sources``.

    A level is found from the last one or from the nodes not yet seen, whichever have fewer links.
    """
    n = len(start) - 1
    degree, out = np.diff(start), np.zeros(n)
    for s in sources:
        level, sigma, steps = np.full(n, -1, np.int32), np.zeros(n), []
        level[s], sigma[s], last = 0, 1, np.array([s])
        unseen = len(to) - degree[s]
        while True:
            forth = degree[last].sum() <= unseen
            at = last if forth else np.flatnonzero(level < 0)
            many = degree[at]
            if not (total := many.sum()):
                break
            end = to[np.repeat(start[at] - np.cumsum(many) + many, many) + np.arange(total)]
            own = np.repeat(at, many)
            keep = np.flatnonzero(level[end] == (-1 if forth else len(steps)))
            if not len(keep):
                break
            if len(steps) == max_depth:
                raise RuntimeError("no fixpoint within max_depth")
            near, far = (own[keep], end[keep]) if forth else (end[keep], own[keep])
            steps.append((near, far))
            level[far] = len(steps)
            sigma += np.bincount(far, sigma[near], n)
            last = np.flatnonzero(level == len(steps))
            unseen -= degree[last].sum()
        share = 1 / np.where(sigma > 0, sigma, 1)
        given, delta = share.copy(), np.zeros(n)  # given = (1 + delta) / sigma
        for near, far in reversed(steps):
            more = np.bincount(near, given[far], n) * sigma
            delta += more
            given += more * share
        delta[s] = 0
        out += delta
    return out


def dependency_sums(both: DataFrame, max_depth: int) -> tuple[DataFrame, DataFrame]:
    """(id, k) of the nodes and (k, delta): the dependencies on each, summed over all sources; nodes between no others have no row.

    both (a, b): distinct links, each in both directions, at most ``HELD``. One task numbers the nodes; the
    sources are dealt over the cluster, and each task walks from its own.
    """
    spark = both.sparkSession
    kind = both.schema["a"].dataType.simpleString()
    packed = cut(both.coalesce(1).mapInArrow(_packed, f"id {kind}, k bigint, blob binary"))
    nodes = packed.filter("id IS NOT NULL").select("id", "k")
    blobs = {r.k: bytes(r.blob) for r in packed.filter("id IS NULL").select("k", "blob").collect()}
    if not blobs:
        return nodes, spark.createDataFrame([], "k bigint, delta double")
    links = spark.sparkContext.broadcast((blobs[0], blobs[1]))
    n = len(blobs[0]) // 8 - 1

    def run(batches):
        start, to = np.frombuffer(links.value[0], np.int64), np.frombuffer(links.value[1], np.int32).astype(np.int64)
        total = np.zeros(n)
        for batch in batches:
            total += dependencies(start, to, batch.column(0).to_numpy(), max_depth)
        k = np.flatnonzero(total)
        for at in range(0, len(k), 10_000):
            some = k[at : at + 10_000]
            yield pa.record_batch([pa.array(some), pa.array(total[some])], ["k", "delta"])

    tasks = min(-(-n // 64), 4 * spark.sparkContext.defaultParallelism)
    sums = cut(spark.range(0, n, 1, tasks).mapInArrow(run, "k bigint, delta double").groupBy("k").agg(F.sum("delta").alias("delta")))
    links.destroy()
    return nodes, sums


def _hashed(value: int, seeds: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of an int after other columns, whose hashes are ``seeds``."""
    one, two, three, five = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    u = np.uint64
    h = (seeds.view(np.uint64) + five + u(4)) ^ np.array([value], np.uint64) * one
    h = (h << u(23) | h >> u(41)) * two + three
    h = (h ^ h >> u(33)) * two
    h = (h ^ h >> u(29)) * three
    return (h ^ h >> u(32)).view(np.int64)


def _sums(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, and the sum of its values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(value[order], first) if len(first) else np.zeros(0)


def moves(a: np.ndarray, b: np.ndarray, w: np.ndarray, hashes: np.ndarray, max_rounds: int) -> tuple[np.ndarray, bool]:
    """The rounds of ``centrality._moves`` over arrays: the community of each node, and whether anybody moved.

    Links both ways, loops once; nodes and communities are places in ``hashes`` (of their names and the seed).
    """
    n = len(hashes)
    degree, place = np.bincount(a, w, n), np.arange(n)
    if not (twice_m := degree.sum()):
        return place, False
    apart = a != b
    nodes, (a, b, w) = np.unique(a), (x[apart] for x in (a, b, w))
    ever, quiet = False, 0
    for k in range(max_rounds):
        turn = (_hashed(k // 2, hashes) & 1) == k % 2
        mine, ours = np.flatnonzero(turn[a]), nodes[turn[nodes]]
        key, links = _sums(np.r_[a[mine] * n + place[b[mine]], ours * n + place[ours]], np.r_[w[mine], np.zeros(len(ours))])
        v, c = key // n, key % n
        stays = c == place[v]
        gain = links - degree[v] * (np.bincount(place, degree, n)[c] - np.where(stays, degree[v], 0)) / twice_m
        first = np.flatnonzero(np.r_[True, v[1:] != v[:-1]]) if len(v) else v
        now, rounded = gain[stays], np.round(gain, 9)
        best = np.maximum.reduceat(rounded, first) if len(first) else now
        goes = np.repeat(best > now + 1e-9, np.diff(np.r_[first, len(v)]))
        top = np.flatnonzero(goes & (rounded == np.repeat(best, np.diff(np.r_[first, len(v)]))))
        top = top[np.lexsort((c[top], -hashes[c[top]], v[top]))]  # of several the last of a node
        place = place.copy()
        place[v[top]] = c[top]
        ever, quiet = ever or len(top) > 0, 0 if len(top) else quiet + 1
        if quiet == 2:
            return place, ever
    raise RuntimeError("no fixpoint within max_rounds")


def settled(links: DataFrame, seed: int, max_rounds: int) -> DataFrame:
    """(id, c) after all levels of ``centrality.communities`` over links (a, b, w), at most ``HELD``, in one task."""
    kind = links.schema["a"].dataType.simpleString()

    def run(batches):
        found = _numbered(batches)
        if found is None:
            return
        rows, names, a, b = found
        w, hashes = rows["w"].to_numpy(), np.zeros(len(names), np.int64)
        hashes[a] = rows["h"].to_numpy()
        n, of = len(names), np.arange(len(names))
        while True:
            place, moved = moves(a, b, w, hashes, max_rounds)
            of = place[of]
            if not moved:
                break
            key, w = _sums(place[a] * n + place[b], w)
            a, b = key // n, key % n
        for at in range(0, n, 10_000):
            yield pa.record_batch([names.slice(at, 10_000), names.take(pa.array(of[at : at + 10_000]))], ["id", "c"])

    hashed = links.select("a", "b", F.col("w").cast("double").alias("w"), F.xxhash64("a", F.lit(seed)).alias("h"))
    return cut(hashed.coalesce(1).mapInArrow(run, f"id {kind}, c {kind}"))
