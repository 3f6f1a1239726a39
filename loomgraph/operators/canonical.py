"""Claims to canonical entities, relations and issues.

A claim speaks of a subject and a value or object. Sides are resolved first (an
explicit id wins over what the reference maps to), then claims with an object
are grouped to relations and the others to fields of entities. Every value keeps
the claims that state it; values that disagree are all kept, ranked. Nothing is
gathered but the claim ids of one relation or field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.claims import STATUS_ORDER, merge_partial_dates, rank_of
from loomgraph.operators.skew import salted_join
from loomgraph.operators.windows import best_row

# Predicates with their field and whether it holds several values.
FIELDS = {
    "Person": {"name": ("canonical_name", False), "profile_url": ("profile_urls", True), "position_title": ("position_titles", True), "research_area": ("disciplines", True)},
    "Project": {"title": ("title", False), "start": ("start", False), "end": ("end", False), "grant_id": ("grant_id", False)},
}
LABELS = {"Person": "canonical_name", "Project": "title"}
ALTERNATES = {"canonical_name": "alternate_names", "title": "alternate_titles"}
DATES = ["start", "end"]
# Where a statement stands on a page outranks other evidence.
LOCATOR_RANK = {"profile.h1": 3, "unit.h1": 3, "project.h1": 3}


def latest_claims(claims: DataFrame) -> DataFrame:
    """One row for each claim_id: the last observed; rows delivered again drop out."""
    return best_row(claims.filter("claim_id IS NOT NULL"), ["claim_id"], F.desc_nulls_last("observed_at"), F.desc_nulls_last("confidence"), F.asc_nulls_last("document_id"))


def resolve_sides(claims: DataFrame, ref_ids: DataFrame) -> DataFrame:
    """Adds subject_id, object_id and subject_basis (explicit, mapped, open). ref_ids (ref, canonical_id), ref unique."""
    of = lambda side: ref_ids.select(F.col("ref").alias(f"{side}_ref"), F.col("canonical_id").alias(f"{side}_mapped"))
    c = claims.withColumn("subject_ref", F.col("subject.source_ref")).withColumn("object_ref", F.col("object.source_ref"))
    c = salted_join(salted_join(c, of("subject"), "subject_ref"), of("object"), "object_ref")
    basis = F.when(F.col("subject.canonical_id").isNotNull(), "explicit").when(F.col("subject_mapped").isNotNull(), "mapped").otherwise("open")
    return c.withColumn("subject_id", F.coalesce("subject.canonical_id", "subject_mapped")).withColumn("object_id", F.coalesce("object.canonical_id", "object_mapped")).withColumn("subject_basis", basis).drop("subject_mapped", "object_mapped", "subject_ref", "object_ref")


def stable_key(prefix: str, *parts: Column) -> Column:
    """Prefix and 16 hex digits of the parts as a JSON list."""
    body = F.concat(F.lit('["'), F.concat_ws('", "', *parts), F.lit('"]'))
    return F.concat(F.lit(prefix), F.substring(F.sha2(body, 256), 1, 16))


def build_relations(resolved: DataFrame) -> DataFrame:
    """Claims with two different resolved ends, grouped by predicate and ends.

    valid_until only if every explicit claim has an end; the strongest status;
    roles in order of observation; sorted ids of claims and documents.
    """
    c = resolved.filter("object IS NOT NULL AND subject_id IS NOT NULL AND object_id IS NOT NULL AND subject_id <> object_id")
    explicit = F.col("temporal_basis") == "EXPLICIT"
    role = F.try_element_at("qualifiers", F.lit("role"))
    roles = c.filter(role.isNotNull()).groupBy("predicate", "subject_id", "object_id", role.alias("role")).agg(F.min(F.struct(F.col("observed_at").isNull().alias("z"), "observed_at", "claim_id")).alias("o"))
    roles = roles.groupBy("predicate", "subject_id", "object_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "role"))), lambda x: x["role"]).alias("roles"))
    g = c.groupBy("predicate", "subject_id", "object_id").agg(
        F.min(F.when(explicit, F.col("valid_from"))).alias("valid_from"),
        F.when(F.count_if(explicit) == F.count(F.when(explicit, F.col("valid_until"))), F.max(F.when(explicit, F.col("valid_until")))).alias("valid_until"),
        F.when(F.bool_or(explicit), "EXPLICIT").when(F.bool_or(F.col("temporal_basis") == "OBSERVED_AT"), "OBSERVED_AT").otherwise("UNKNOWN").alias("temporal_basis"),
        F.min("observed_at").alias("first_observed_at"), F.max("observed_at").alias("last_observed_at"),
        F.min_by("epistemic_status", rank_of(F.col("epistemic_status"), STATUS_ORDER)).alias("epistemic_status"), F.max("confidence").alias("confidence"),
        F.array_sort(F.collect_set("assertion_type")).alias("assertion_types"), F.array_join(F.array_sort(F.collect_set("derivation_method")), "; ").alias("derivation_method"),
        F.array_sort(F.collect_set("claim_id")).alias("claim_ids"), F.array_sort(F.collect_set("document_id")).alias("document_ids"),
    )
    g = g.join(roles, ["predicate", "subject_id", "object_id"], "left")
    return g.withColumn("relation_id", stable_key("rel_", F.col("predicate"), F.col("subject_id"), F.col("object_id")))


def field_claims(resolved: DataFrame) -> DataFrame:
    """(subject_id, entity_type, field, multi, value, claim columns) of the claims with a mapped predicate."""
    rows = [(t, p, f, m) for t, preds in FIELDS.items() for p, (f, m) in preds.items()]
    fields = resolved.sparkSession.createDataFrame(rows, "entity_type string, predicate string, field string, multi boolean")
    c = resolved.filter("object IS NULL AND value IS NOT NULL AND subject_id IS NOT NULL").withColumn("entity_type", F.col("subject.entity_type"))
    return c.join(F.broadcast(fields), ["entity_type", "predicate"]).select("subject_id", "entity_type", "field", "multi", "value", "claim_id", "document_id", "confidence", "observed_at", "locator")


def ranked_values(fields: DataFrame) -> DataFrame:
    """(subject_id, entity_type, field, value, place, n_values, n_documents, claim_ids) of single-valued fields.

    Dates of different precision that agree count as the finer one. Values rank by
    place on the page, documents, greatest confidence and last observation, all
    descending; ties keep the first seen.
    """
    single = fields.filter("NOT multi")
    dated = single.filter(F.col("field").isin(*DATES)).withColumn("k", F.concat_ws("\u0001", "subject_id", "entity_type", "field"))
    merged = merge_partial_dates(dated, "k", "value").select("k", "value", "merged")
    single = single.withColumn("k", F.when(F.col("field").isin(*DATES), F.concat_ws("\u0001", "subject_id", "entity_type", "field"))).join(merged, ["k", "value"], "left").withColumn("value", F.coalesce("merged", "value"))
    rank = F.lit(0)
    for locator, r in LOCATOR_RANK.items():
        rank = F.when(F.col("locator") == locator, r).otherwise(rank)
    key = ["subject_id", "entity_type", "field"]
    per = single.groupBy(*key, "value").agg(
        F.max(rank).alias("r"), F.countDistinct("document_id").alias("n_documents"), F.max("confidence").alias("c"), F.max("observed_at").alias("last"),
        F.min("observed_at").alias("first"), F.min("claim_id").alias("first_id"), F.array_sort(F.collect_set("claim_id")).alias("claim_ids"),
    )
    from pyspark.sql import Window

    order = Window.partitionBy(*key).orderBy(F.desc("r"), F.desc("n_documents"), F.desc_nulls_last("c"), F.desc_nulls_last("last"), F.asc_nulls_last("first"), F.asc("first_id"))
    return per.select(*key, "value", F.row_number().over(order).alias("place"), F.count(F.lit(1)).over(Window.partitionBy(*key)).alias("n_values"), "n_documents", "claim_ids")


def several_values(fields: DataFrame) -> DataFrame:
    """(subject_id, entity_type, field, value, claim_ids): values of the others in order of first observation."""
    per = fields.filter("multi").groupBy("subject_id", "entity_type", "field", "value").agg(F.min("observed_at").alias("o"), F.collect_set("claim_id").alias("ids"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("o").isNull().alias("z"), "o", "value")))
    return per.groupBy("subject_id", "entity_type", "field").agg(F.array_join(F.transform(ordered, lambda x: x["value"]), "|").alias("value"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("claim_ids"))


def entity_fields(resolved: DataFrame) -> DataFrame:
    """(subject_id, entity_type, field, value, conflicts, claim_ids): the fields of every entity.

    conflicts: the other values of a single-valued field, best first; for names and
    titles these are alternates, a field of their own, and no conflict.
    """
    fields = field_claims(resolved)
    ranked = ranked_values(fields)
    key = ["subject_id", "entity_type", "field"]
    others = lambda: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("place") > 1, F.struct("place", "value")))), lambda x: x["value"]), "|")
    one = ranked.groupBy(*key).agg(F.max(F.when(F.col("place") == 1, F.col("value"))).alias("value"), others().alias("rest"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("claim_ids")))).alias("claim_ids"))
    alternate = F.lit(None).cast("string")
    for f, a in ALTERNATES.items():
        alternate = F.when(F.col("field") == f, a).otherwise(alternate)
    one = one.withColumn("alt", alternate)
    main = one.select(*key, "value", F.when(F.col("alt").isNull(), F.nullif("rest", F.lit(""))).alias("conflicts"), "claim_ids")
    alts = one.filter("alt IS NOT NULL AND rest <> ''").select("subject_id", "entity_type", F.col("alt").alias("field"), F.col("rest").alias("value"), F.lit(None).cast("string").alias("conflicts"), "claim_ids")
    many = several_values(fields).select(*key, "value", F.lit(None).cast("string").alias("conflicts"), "claim_ids")
    return main.unionByName(alts).unionByName(many)


def build_entities(resolved: DataFrame, documents: DataFrame) -> DataFrame:
    """(canonical_id, entity_type, label, n_fields, n_conflicts, first_observed_at, last_verified_at, n_refs):
    entities that have a label; observation times come from pages of the web only. An id of two types is left out."""
    fields = entity_fields(resolved)
    label = F.lit(False)
    for t, f in LABELS.items():
        label = label | ((F.col("entity_type") == t) & (F.col("field") == f))
    e = fields.groupBy("subject_id", "entity_type").agg(F.max(F.when(label, F.col("value"))).alias("label"), F.count(F.lit(1)).alias("n_fields"), F.count("conflicts").alias("n_conflicts")).filter("label IS NOT NULL")
    once = e.groupBy("subject_id").agg(F.count(F.lit(1)).alias("types")).filter("types = 1").select("subject_id")
    web = documents.filter("document_id IS NOT NULL AND url IS NOT NULL AND NOT startswith(url, 'repo://')").select("document_id").distinct()
    c = resolved.filter("object IS NULL AND subject_id IS NOT NULL").select("subject_id", F.col("subject.entity_type").alias("entity_type"), "observed_at", "document_id", F.col("subject.source_ref").alias("ref"))
    times = salted_join(c, web, "document_id", "left_semi").groupBy("subject_id", "entity_type").agg(F.min("observed_at").alias("first_observed_at"), F.max("observed_at").alias("last_verified_at"))
    refs = resolved.filter("subject_id IS NOT NULL").groupBy("subject_id").agg(F.countDistinct("subject.source_ref").alias("n_refs"))
    return e.join(once, "subject_id", "left_semi").join(times, ["subject_id", "entity_type"], "left").join(refs, "subject_id", "left").select(F.col("subject_id").alias("canonical_id"), "entity_type", "label", "n_fields", "n_conflicts", "first_observed_at", "last_verified_at", F.coalesce("n_refs", F.lit(0)).alias("n_refs"))


def build_issues(resolved: DataFrame, entities: DataFrame, relations: DataFrame, known: DataFrame) -> DataFrame:
    """(check, key): what the build leaves out, each with its claim, entity or relation. known (id): entities of other tables."""
    claim = lambda name, where: resolved.filter(where).select(F.lit(name).alias("check"), F.col("claim_id").alias("key"))
    mapped = [p for preds in FIELDS.values() for p in preds]
    ids = entities.select(F.col("canonical_id").alias("id")).unionByName(known.select("id")).distinct()
    ends = relations.select("relation_id", F.explode(F.array("subject_id", "object_id")).alias("id"))
    dangling = salted_join(ends, ids, "id", "left_anti").select(F.lit("dangling_relation").alias("check"), F.col("relation_id").alias("key"))
    subjects = resolved.filter("object IS NULL AND subject_id IS NOT NULL").select(F.col("subject_id").alias("key")).distinct()
    unlabelled = subjects.join(entities.select(F.col("canonical_id").alias("key")), "key", "left_anti").select(F.lit("entity_without_label").alias("check"), "key")
    parts = [
        claim("unresolved_subject", "subject_id IS NULL"), claim("unresolved_object", "object IS NOT NULL AND subject_id IS NOT NULL AND object_id IS NULL"),
        claim("self_loop_after_resolution", "object IS NOT NULL AND subject_id = object_id"), resolved.filter(F.col("object").isNull() & F.col("value").isNotNull() & ~F.col("predicate").isin(*mapped)).select(F.lit("unmapped_predicate").alias("check"), F.col("claim_id").alias("key")),
        unlabelled, dangling,
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def contexts(claims: DataFrame) -> DataFrame:
    """(source_ref, relation, target_id, roles, valid_from, valid_until, snippet, n_claims): what pages say of a record."""
    c = claims.filter("subject.source_ref IS NOT NULL AND object.canonical_id IS NOT NULL").select(
        F.col("subject.source_ref").alias("source_ref"), F.col("predicate").alias("relation"), F.col("object.canonical_id").alias("target_id"), F.try_element_at("qualifiers", F.lit("role")).alias("role"), "valid_from", "valid_until", "snippet", "observed_at", "claim_id")
    return c.groupBy("source_ref", "relation", "target_id").agg(
        F.array_join(F.array_sort(F.collect_set("role")), "|").alias("roles"), F.min("valid_from").alias("valid_from"), F.max("valid_until").alias("valid_until"),
        F.min_by("snippet", F.when(F.col("snippet").isNotNull(), F.struct(F.col("observed_at").isNull().alias("z"), "observed_at", "claim_id"))).alias("snippet"), F.count(F.lit(1)).alias("n_claims"))
