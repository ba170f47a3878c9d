"""Schemas of the registry and profile tables (Spark DDL)."""

from __future__ import annotations

REGISTRY = {
    "instruments": "id string, document_type string, number string, year int, title string, jurisdiction string, issuing_body string, status string, metadata_json string, created_at string, updated_at string",
    "source_observations": "id bigint, instrument_id string, provider string, source_url string, source_id string, retrieved_at string, content_sha256 string, mime_type string, raw_path string, metadata_json string",
    "source_fetch_events": "id bigint, instrument_id string, provider string, source_url string, source_id string, retrieved_at string, content_sha256 string, mime_type string, raw_path string, metadata_json string",
    "source_records": "provider string, source_id string, detail_url string, title_hint string, instrument_id string, first_seen_at string, last_seen_at string, last_checked_at string, latest_detail_sha256 string, metadata_json string",
    "document_references": "provider string, source_id string, source_url string, target_source_id string, target_url string, target_label string, context_label string, raw_context string, instrument_id string, observed_at string, metadata_json string",
    "objects": "sha256 string, mime_type string, logical_size bigint, stored_size bigint, compression string, path string, first_seen_at string",
    "acquisition_runs": "id bigint, mode string, provider string, from_year int, to_year int, snapshot_cutoff string, status string, created_at string, started_at string, finished_at string, metadata_json string, scope_json string, scope_fingerprint string, frozen_at string",
    "run_segments": "run_id bigint, year int, next_page int, status string, reported_total bigint, discovered_count bigint, updated_at string",
    "manifest_items": "id bigint, run_id bigint, provider string, source_id string, detail_url string, title_hint string, year int, status string, attempts int, instrument_id string, last_error string, metadata_json string, updated_at string, detail_sha256 string",
    "discovery_partitions": "run_id bigint, group string, type_id string, year int, next_page int, status string, reported_total bigint, discovered_count bigint, last_signature string, last_error string, updated_at string",
    "discovery_memberships": "run_id bigint, provider string, source_id string, group string, type_id string, year int",
    "document_files": "provider string, source_id string, detail_sha256 string, url string, status string, sha256 string, error string, metadata_json string",
}

PROFILE = {
    "inventory": "path string, sha256 string, logical_size bigint, stored_size bigint, sources array<struct<source_id:string,document_type:string,year:int,title:string,detail_url:string>>",
    "files": "sha256 string, status string, source_bytes bigint, page_count int, sources array<struct<source_id:string,document_type:string,year:int,title:string,detail_url:string>>, encoded_bytes_by_category struct<image:bigint,font:bigint,content:bigint,other:bigint>, residual_file_bytes bigint, repaired boolean, encrypted boolean, xref_objects int, xref_unresolved int, font_program_count int, image_object_count int, content_stream_count int, pdf_version string, metadata map<string,string>, warnings array<string>, incremental_updates int, profile_seconds double, error string",
    "pages": "sha256 string, page_number int, width double, height double, rotation int, text_chars int, text_blocks int, text_pattern_fingerprint string, image_count int, image_coverage double, images array<struct<xref:int,width:int,height:int,bpc:int,colorspace:string,filtercodec:string>>, font_count int, class_name string, full_page_raster boolean",
    "objects": "file_sha256 string, xref int, category string, encoded_bytes bigint, sha256 string, filters array<string>, dictionary_sha256 string",
    "images": "file_sha256 string, xref int, width int, height int, bpc int, colorspace string, filters array<string>, encoded_bytes bigint, encoded_sha256 string, page_numbers array<int>, fullscan boolean, fullscan_pages array<int>, usage string",
    "fonts": "file_sha256 string, xref int, base_font string, name string, subset string, embedded boolean, program_xref int, encoded_bytes bigint, encoded_sha256 string, font_type string, page_numbers array<int>",
}

BENCHMARK = (
    "mode string, method string, unit_id string, status string, input_bytes bigint, payload_bytes bigint, manifest_bytes bigint, output_bytes bigint, "
    "encode_seconds double, decode_seconds double, encode_mib_s double, decode_mib_s double, ratio double, saving double, exact boolean, independent_access boolean, "
    "peak_rss_bytes bigint, member_sha256 array<string>, error string"
)

#: Statuses of manifest items that a run still works on, and those that a retry takes up again.
OPEN = ("pending", "running")
RETRY = ("failed", "partial", "unresolved", "no_file")
