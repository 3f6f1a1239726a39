"""All queries of the core library and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomgraph.plans import canon, discovery, facts, graphs, identity, networks, pipeline, portal, quality, reports, strings, structure, texts, upkeep, views

MODULES = [graphs, networks, facts, texts, strings, identity, canon, structure, discovery, quality, pipeline, portal, reports, views, upkeep]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.ORACLES.items()}
