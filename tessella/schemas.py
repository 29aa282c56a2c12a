"""Declared schemas: one superset for each kind of record, as DDL, so that reads never infer."""

from __future__ import annotations

SEGMENT = "struct<id: int, start: double, end: double, text: string, avg_logprob: double>"
METRICS = "struct<global_uwr: double, tail_uwr: double, cps: double, glued_count: int, min_sliding_uwr: double, prompt_contamination: boolean, error: string>"
# The field names of stored documents.
METADATA = (
    "struct<video_id: string, title: string, channel: string, duration: double, timestamp: string, omega_certified: boolean, omega_timestamp: string, omega_merge_notes: string,"
    " omega_quarantine_reason: string, omega_original_text_len: bigint, omega_golden_text_len: bigint, audit_verified: boolean, audit_timestamp: string>"
)
TRANSCRIPT = (f"metadata {METADATA}, full_text string, raw_text string, sentry_status string, segments array<{SEGMENT}>, audit struct<category: string, metrics: {METRICS}>")
MANIFEST_ENTRY = "struct<timestamp: double, filepath: string, title: string, category: string, duration: double, in_escrow: boolean, sentry_status: string>"
REPORT = ("vid_id string, filepath string, category string, in_escrow string, global_uwr double, tail_uwr double, cps double, glued_count int, min_sliding_uwr double, prompt_contamination boolean, error string")
CHUNK = ("id string, document string, source_title string, source_url string, video_id string, chunk_index int")
VERDICT = "certainty_score double, verdict string, failure_reason string, clean_cut_index int, reasoning string"
CONSENSUS = "verdict string, similarity_pct double, golden_text string, merge_notes string"
CORRECTIONS = "array<struct<id: int, original: string, corrected: string>>"
CATEGORIES = ("SUCCESS", "GHOST", "SYLLABLE_TRAP", "PROMPT_CONTAMINATED", "SANDWICH_LOOP", "TERMINAL_LOOP")
