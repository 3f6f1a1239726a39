"""Schemas of the staged and released files, as Spark DDL."""

from __future__ import annotations

from pyspark.sql import types as T

REF = "struct<entity_type: string, source_ref: string, canonical_id: string>"
# The columns of each kind of file.
DDL = {
    "documents": "document_id string, source_id string, url string, final_url string, canonical_url string, retrieved_at timestamp, http_status int, content_type string, content_sha256 string,"
    " raw_path string, page_title string, source_type string, institution_id string, fetcher_version string, synthetic boolean",
    "records": f"ref {REF}, label string, document_id string, hints map<string, string>, identity_anchor string",
    "claims": f"claim_id string, subject {REF}, predicate string, value string, object {REF}, qualifiers map<string, string>, valid_from string, valid_until string, temporal_basis string,"
    " observed_at timestamp, document_id string, locator string, snippet string, extraction_method string, parser string, parser_version string, epistemic_status string, assertion_type string,"
    " derivation_method string, derived_from array<string>, confidence double, review_status string",
    "relations": "relation_id string, type string, source_id string, target_id string, qualifiers map<string, array<string>>, valid_from string, valid_until string, temporal_basis string,"
    " first_observed_at timestamp, last_observed_at timestamp, epistemic_status string, assertion_types array<string>, derivation_method string, confidence double, claim_ids array<string>, document_ids array<string>",
    "matches": "left string, right string, entity_type string, status string, method string, score double, signals map<string, string>, left_label string, right_label string",
    "identity_map": "source_ref string, entity_type string, canonical_id string, assigned_at timestamp, previous_id string",
    "errors": "url string, error string",
    "frontier": "url string, kind string, host string, stated_urls array<string>, scope string, owner_source string, decision string, reason string, host_status string",
    "diagnostics": "document_id string, url string, source_id string, page_type string, parser string, status string, fields map<string, int>, unmapped_labels array<string>, error string",
}
#: Files whose malformed lines fail a read; the others are read leniently.
STRICT = ["records", "claims", "documents"]
#: What identifies a row of a staged file delivered again.
KEYS = {"claims": ["claim_id"], "documents": ["document_id"], "diagnostics": ["document_id", "page_type"]}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[name])
