"""From claims to relations and entity fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.windows import best_row

# Epistemic status from strong to weak.
STATUS_ORDER = ["OBSERVED", "DERIVED", "INFERRED", "INTERPRETIVE"]
# Identification strength from strong to weak.
STRENGTH_ORDER = ["anchored", "MANUAL_CONFIRMED", "DETERMINISTIC", "HIGH_CONFIDENCE_AUTO", "REVIEW_REQUIRED", "UNRESOLVED"]


def rank_of(c: Column, order: list[str]) -> Column:
    """Place of a value in a fixed order; unknown values come last."""
    r = F.lit(len(order))
    for i, v in reversed(list(enumerate(order))):
        r = F.when(c == v, i).otherwise(r)
    return r


def latest_version(claims: DataFrame) -> DataFrame:
    """One row for each claim_id: the last observed (ties: greatest confidence, then review status)."""
    return best_row(claims, ["claim_id"], F.desc("observed_at"), F.desc("confidence"), F.desc_nulls_last("review_status"), F.desc_nulls_last("document_id"))


def relations(claims: DataFrame) -> DataFrame:
    """Claims with an object, grouped by predicate, subject and object.

    valid_until is open unless every explicit claim states an end. The status is
    the strongest of the claims. Rows without subject or object id are left out.
    """
    c = claims.filter("object IS NOT NULL AND object.canonical_id IS NOT NULL AND subject.canonical_id IS NOT NULL")
    explicit = F.col("temporal_basis") == "EXPLICIT"
    return c.groupBy(F.col("predicate"), F.col("subject.canonical_id").alias("source_id"), F.col("object.canonical_id").alias("target_id")).agg(
        F.min(F.when(explicit, F.col("valid_from"))).alias("valid_from"),
        F.when(F.count_if(explicit) == F.count(F.when(explicit, F.col("valid_until"))), F.max(F.when(explicit, F.col("valid_until")))).alias("valid_until"),
        F.when(F.bool_or(explicit), "EXPLICIT").when(F.bool_or(F.col("temporal_basis") == "OBSERVED_AT"), "OBSERVED_AT").otherwise("UNKNOWN").alias("temporal_basis"),
        F.min_by("epistemic_status", rank_of(F.col("epistemic_status"), STATUS_ORDER)).alias("epistemic_status"),
        F.max("confidence").alias("confidence"),
        F.countDistinct("claim_id").alias("n_claims"), F.countDistinct("document_id").alias("n_documents"),
        F.array_join(F.array_sort(F.collect_set("assertion_type")), ",").alias("assertion_types"),
    )


def chosen_values(claims: DataFrame) -> DataFrame:
    """(subject_id, predicate, value, n_documents, n_values): the winning value of each field.

    Values are ranked by documents, greatest confidence, last observation, all
    descending, then by first observation and the value itself.
    """
    c = claims.filter("value IS NOT NULL AND subject.canonical_id IS NOT NULL")
    per = c.groupBy(F.col("subject.canonical_id").alias("subject_id"), "predicate", "value").agg(
        F.countDistinct("document_id").alias("n_documents"), F.max("confidence").alias("confidence"), F.max("observed_at").alias("last_at"), F.min("observed_at").alias("first_at")
    )
    counts = per.groupBy("subject_id", "predicate").agg(F.count(F.lit(1)).alias("n_values"))
    best = best_row(per, ["subject_id", "predicate"], F.desc("n_documents"), F.desc_nulls_last("confidence"), F.desc_nulls_last("last_at"), F.asc_nulls_last("first_at"), F.asc("value"))
    return best.join(counts, ["subject_id", "predicate"]).select("subject_id", "predicate", "value", "n_documents", "n_values")


def merge_partial_dates(dates: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, merged): a coarser date joins the one finer date it begins, if there is exactly one."""
    d = dates.select(F.col(key).alias("k"), F.col(value).alias("v")).filter("v IS NOT NULL").distinct()
    finer = d.alias("l").join(d.alias("r"), (F.col("l.k") == F.col("r.k")) & F.startswith(F.col("r.v"), F.concat(F.col("l.v"), F.lit("-"))))
    one = finer.groupBy(F.col("l.k").alias("k"), F.col("l.v").alias("v")).agg(F.count(F.lit(1)).alias("n"), F.max("r.v").alias("f")).filter("n = 1")
    return d.join(one, ["k", "v"], "left").select(F.col("k").alias(key), F.col("v").alias(value), F.coalesce("f", "v").alias("merged"))
