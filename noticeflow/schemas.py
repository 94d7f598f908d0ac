"""Explicit schemas of the logical tables."""

from __future__ import annotations

from . import rules

SEARCH_HIT = (
    "run_id string, query_no int, query string, pos int, url string, title string, site_name string, publish_time string, auth_info_level int, "
    "auth_info_des string, rank_score double, summary string, content string, error string"
)
CANDIDATE_INDEX = (
    "ord bigint, candidate_id string, title string, title_fingerprint string, site_name string, url string, publish_time string, "
    "auth_info_level int, auth_info_des string, rank_score double, found_by_query array<int>, teaser string, content_path string"
)
CANDIDATE_CONTENT = "candidate_id string, title string, source_url string, summary string, content string"
EVIDENCE = "source_verified boolean, verification_level string, content_path string, checked_at string, field_evidence map<string,string>"
RECEIPT = "schema_version int, flow string, candidate_id string, payload_path string, payload_sha256 string, http_status int, remote_code int, confirmed_at string"
LEDGER = "flow string, candidate_id string, record_id string, payload_sha256 string, found_by_query array<int>, confirmed_at string, run_id string"
QUERY_STATS = "day string, query_no int, raw bigint, unique bigint, pushed bigint"


def record_type(fields: tuple[str, ...]) -> str:
    kinds = dict.fromkeys(rules.NUMBER_FIELDS, "double") | dict.fromkeys(rules.BOOL_FIELDS, "boolean") | {"days_left": "int"}
    return ", ".join(f"{f} {kinds.get(f, 'string')}" for f in fields)


SEEN = record_type(rules.CREATE_FIELDS) + ", dedup_key string, first_seen string, last_seen string, pushed boolean, found_by_query array<int>"
