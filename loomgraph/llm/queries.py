"""Queries of this subpackage and their SQL counterparts, where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm.boilerplate import main_body
from loomgraph.llm.bpe import encode_column
from loomgraph.llm.groups import match_groups
from loomgraph.llm.linkage import match_projects
from loomgraph.llm.mixing import Mix
from loomgraph.llm.names import variant_clusters, variant_pairs
from loomgraph.llm.sentences import sentence_units
from loomgraph.sources.tables import read_table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every reference of matches with the smallest reference of its group."""
    return match_groups(read_table(spark, d, "matches", "left", "right", "status"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Main-body lines of every page."""
    return main_body(read_table(spark, d, "documents", "doc_id", "text", "page_title", "raw_path").filter("raw_path IS NOT NULL"))


def _names(spark: SparkSession, d: str) -> DataFrame:
    return variant_clusters(read_table(spark, d, "person", "canonical_id", "canonical_name"), read_table(spark, d, "matches", "left_label", "right_label"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of spellings of the same person or organisation."""
    return variant_pairs(_names(spark, d))


def p5_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling with the centre of its cluster."""
    return _names(spark, d)


def _projects(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "project", "canonical_id", "title", "alternate_titles", "grant_id", "start")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of project ids that describe the same project."""
    return match_projects(_projects(spark, d)).select("id_a", "id_b")


def p6_matches(spark: SparkSession, d: str) -> DataFrame:
    """The same pairs with the rule that found them and its confidence."""
    return match_projects(_projects(spark, d))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document's whole text."""
    return encode_column(read_table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def _mix(spark: SparkSession, d: str) -> Mix:
    return Mix(read_table(spark, d, "documents", "doc_id", "text", "source"), read_table(spark, d, "mix_targets"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The drawn documents with their number of repetitions."""
    return _mix(spark, d).rows()


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of each source."""
    return _mix(spark, d).shares()


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Sentence units of every document."""
    return sentence_units(read_table(spark, d, "documents", "doc_id", "text", "raw_path"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p4_found": p4_found, "p5_found": p5_found, "p5_clusters": p5_clusters, "p6_found": p6_found, "p6_matches": p6_matches, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found}


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": """WITH RECURSIVE
            e AS (SELECT DISTINCT "left" AS a, "right" AS b FROM matches WHERE lower(trim(status)) = 'confirmed_match' AND "left" IS NOT NULL AND "right" IS NOT NULL
                  UNION SELECT "right", "left" FROM matches WHERE lower(trim(status)) = 'confirmed_match' AND "left" IS NOT NULL AND "right" IS NOT NULL),
            n AS (SELECT "left" AS v FROM matches WHERE "left" IS NOT NULL UNION SELECT "right" FROM matches WHERE "right" IS NOT NULL),
            reach(v, r) AS (SELECT v, v FROM n UNION SELECT reach.v, e.b FROM reach JOIN e ON e.a = reach.r)
            SELECT v AS record_ref, min(r) AS group_ref FROM reach GROUP BY v""",
    }
