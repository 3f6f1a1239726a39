"""Queries of the general data-upkeep operators: orphans, histories, snapshot changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomgraph.functions.lists import list_form
from loomgraph.operators.history import attribute_versions
from loomgraph.operators.references import REPORT, KnowledgeTables, orphan_cascade, orphan_counts
from loomgraph.operators.snapshots import snapshot_changes
from loomgraph.sources.tables import read_table


def _tables(spark: SparkSession, d: str) -> KnowledgeTables:
    return KnowledgeTables(
        relations=read_table(spark, d, "relations", "relation_id", "source_id", "target_id", "last_observed_at", "claim_ids"),
        claims=read_table(spark, d, "claims", "claim_id", "document_id", "observed_at", "derived_from"),
        person=read_table(spark, d, "person", "canonical_id", "snapshot_date"),
        project=read_table(spark, d, "project", "canonical_id"),
        org_units=read_table(spark, d, "org_units", "canonical_id"),
        documents=read_table(spark, d, "documents", "document_id", "retrieved_at"),
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """References that do not hold: the direct orphans of the cascade."""
    return orphan_cascade(_tables(spark, d)).filter("orphan_kind = 'direct'").select(*REPORT)


def p2_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Direct and inherited orphans with the depth at which they were reached."""
    return orphan_cascade(_tables(spark, d))


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table, field, month, state and kind."""
    return orphan_counts(orphan_cascade(_tables(spark, d)))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Versions of each person's position titles with their days."""
    rows = read_table(spark, d, "person", "canonical_id", "position_titles", "first_observed_at", "last_verified_at", "snapshot_date", "loaded_at")
    return attribute_versions(rows, "canonical_id", list_form("position_titles"), "last_verified_at", "snapshot_date", "loaded_at", "first_observed_at")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Persons added, removed or changed between consecutive snapshots."""
    rows = read_table(spark, d, "person", "canonical_id", "position_titles", "snapshot_date", "loaded_at")
    return snapshot_changes(rows, "canonical_id", "snapshot_date", "loaded_at", list_form("position_titles"))


QUERIES = {"p2_found": p2_found, "p2_counts": p2_counts, "p2_cascade": p2_cascade, "p3_found": p3_found, "p7_found": p7_found}

_LIST = """array_to_string(list_sort(list_distinct([trim(regexp_replace(lower(x), ' +', ' ', 'g'))
 for x in coalesce(position_titles, []) if x IS NOT NULL])), chr(1))"""

_DIRECT = """
keys AS (SELECT k, max(h) AS h FROM (
   SELECT canonical_id AS k, CASE WHEN snapshot_date = (SELECT max(snapshot_date) FROM person) THEN 1 ELSE 0 END AS h FROM person
   UNION ALL SELECT canonical_id, 1 FROM project UNION ALL SELECT canonical_id, 1 FROM org_units) GROUP BY k),
refs AS (SELECT 'source_id' AS f, relation_id, source_id AS k, last_observed_at FROM relations WHERE source_id IS NOT NULL
   UNION ALL SELECT 'target_id', relation_id, target_id, last_observed_at FROM relations WHERE target_id IS NOT NULL),
docs AS (SELECT document_id, min(retrieved_at) AS first_at FROM documents WHERE document_id IS NOT NULL GROUP BY 1),
direct AS (SELECT DISTINCT * FROM (
   SELECT 'relations' AS table_name, f AS field_name, relation_id AS row_key,
     coalesce(strftime(last_observed_at AT TIME ZONE 'UTC', '%Y-%m'), 'unknown') AS ref_month,
     CASE WHEN keys.k IS NULL THEN 'missing' WHEN h = 0 THEN 'gone' END AS ref_state
   FROM refs LEFT JOIN keys ON refs.k = keys.k
   UNION ALL
   SELECT 'claims', 'document_id', claim_id, coalesce(strftime(observed_at AT TIME ZONE 'UTC', '%Y-%m'), 'unknown'),
     CASE WHEN d.document_id IS NULL THEN 'missing' WHEN first_at > observed_at THEN 'late' END
   FROM claims c LEFT JOIN docs d ON c.document_id = d.document_id WHERE c.document_id IS NOT NULL) WHERE ref_state IS NOT NULL)"""

_CASCADE = """,
links AS (SELECT DISTINCT claim_id AS child, p AS parent FROM (SELECT claim_id, unnest(derived_from) AS p FROM claims) WHERE p IS NOT NULL AND p <> claim_id AND claim_id IS NOT NULL),
reached(id, depth) AS (SELECT DISTINCT row_key, 0 FROM direct WHERE table_name = 'claims'
   UNION SELECT l.child, r.depth + 1 FROM reached r JOIN links l ON l.parent = r.id WHERE r.depth < 3000),
orphans AS (SELECT id, min(depth) AS depth FROM reached GROUP BY id),
report AS (SELECT *, 0 AS depth, 'direct' AS orphan_kind FROM direct
   UNION ALL SELECT DISTINCT 'claims', 'derived_from', id, coalesce(strftime(observed_at AT TIME ZONE 'UTC', '%Y-%m'), 'unknown'), 'inherited', depth, 'inherited'
     FROM orphans JOIN claims ON claim_id = id WHERE depth > 0
   UNION ALL SELECT 'relations', 'claim_ids', relation_id, m, 'inherited', min(depth) + 1, 'inherited'
     FROM (SELECT relation_id, coalesce(strftime(last_observed_at AT TIME ZONE 'UTC', '%Y-%m'), 'unknown') AS m, unnest(claim_ids) AS id FROM relations) JOIN orphans USING (id) GROUP BY relation_id, m)"""

ORACLES = {
    "p2_found": f"WITH {_DIRECT} SELECT * FROM direct",
    "p2_cascade": f"WITH RECURSIVE {_DIRECT}{_CASCADE} SELECT table_name, field_name, row_key, ref_month, ref_state, orphan_kind, depth FROM report",
    "p2_counts": f"""WITH RECURSIVE {_DIRECT}{_CASCADE} SELECT table_name, field_name, ref_month, ref_state, orphan_kind,
        count(*) AS n_refs, count(DISTINCT row_key) AS n_rows FROM report GROUP BY ALL""",
    "p3_found": f"""WITH s AS (SELECT canonical_id, coalesce(last_verified_at AT TIME ZONE 'UTC', CAST(snapshot_date AS TIMESTAMP)) AS t, loaded_at, {_LIST} AS p FROM person),
        u AS (SELECT canonical_id, t, p FROM s WHERE t IS NOT NULL AND canonical_id IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY canonical_id, t ORDER BY loaded_at DESC NULLS LAST, p DESC) = 1),
        g AS (SELECT *, lag(p) OVER w AS before, row_number() OVER w AS k FROM u WINDOW w AS (PARTITION BY canonical_id ORDER BY t)),
        v AS (SELECT canonical_id, t, k FROM g WHERE k = 1 OR p <> before),
        f AS (SELECT canonical_id, min(first_observed_at) AT TIME ZONE 'UTC' AS f FROM person GROUP BY 1),
        n AS (SELECT v.canonical_id, t, CASE WHEN k = 1 THEN least(strftime(t, '%Y-%m-%d'), coalesce(strftime(f, '%Y-%m-%d'), '9')) ELSE strftime(t, '%Y-%m-%d') END AS valid_from FROM v JOIN f USING (canonical_id))
        SELECT canonical_id, valid_from, coalesce(lead(strftime(t, '%Y-%m-%d')) OVER (PARTITION BY canonical_id ORDER BY t), 'open') AS valid_until FROM n""",
    "p7_found": f"""WITH r AS (SELECT canonical_id, snapshot_date AS d, {_LIST} AS p FROM person WHERE canonical_id IS NOT NULL AND snapshot_date IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY canonical_id, snapshot_date ORDER BY loaded_at DESC NULLS LAST, p DESC) = 1),
        dates AS (SELECT d, lag(d) OVER (ORDER BY d) AS before FROM (SELECT DISTINCT d FROM r)),
        cur AS (SELECT r.*, before FROM r JOIN dates USING (d) WHERE before IS NOT NULL),
        prev AS (SELECT canonical_id, dates.d AS d, p FROM r JOIN dates ON r.d = dates.before)
        SELECT canonical_id, strftime(coalesce(cur.d, prev.d), '%Y-%m-%d') AS snapshot_date,
          CASE WHEN prev.d IS NULL THEN 'added' WHEN cur.d IS NULL THEN 'removed' ELSE 'changed' END AS change_type
        FROM cur FULL JOIN prev USING (canonical_id, d) WHERE prev.d IS NULL OR cur.d IS NULL OR cur.p <> prev.p""",
}
