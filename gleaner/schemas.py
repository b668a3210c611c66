"""Schemas and closed vocabularies of the curated layer. Never inferred."""

from __future__ import annotations

# Fixed values.
SOURCES = ["openverse", "wikimedia_commons"]
STAGES = ["ingest", "download", "validate", "dedupe", "normalize", "select", "split", "export"]
RUN_STATUS = ["running", "success", "partial", "failed"]
SPLITS = ["train", "val"]
REASONS = {
    "ingest": ["MISSING_IMAGE_URL", "MISSING_LICENSE", "UNRECOGNISED_LICENSE", "PARSE_ERROR"],
    "normalize": ["LICENSE_NOT_PERMITTED"],
    "download": ["HTTP_ERROR", "TIMEOUT", "TOO_LARGE", "EMPTY_RESPONSE", "NOT_AN_IMAGE"],
    "validate": [
        "UNREADABLE_IMAGE", "TRUNCATED_IMAGE", "EXTENSION_MISMATCH", "UNSUPPORTED_FORMAT", "DIMENSIONS_TOO_SMALL", "DIMENSIONS_TOO_LARGE",
        "ASPECT_RATIO_EXTREME", "FILESIZE_TOO_SMALL", "IMAGE_BOMB",
    ],
    "dedupe": ["EXACT_DUPLICATE", "NEAR_DUPLICATE"],
    "select": ["OVER_TARGET"],
}

#: A candidate before any bytes; payload is JSON text, read with variant functions.
CANDIDATE = (
    "source string, class_label string, image_url string, source_id string, landing_url string, license_raw string, "
    "license_url string, attribution string, title string, payload string, fetched_at timestamp"
)
REJECTION = "run_id string, stage string, source string, class_label string, source_id string, source_url string, reason_code string, detail string, occurred_at timestamp"
METRIC = "run_id string, stage string, metric string, value long"
RUN = "run_id string, started_at timestamp, finished_at timestamp, status string, trigger string, config_snapshot string, git_commit string, error_message string, notes string"
RAW = "run_id string, source string, source_id string, class_label string, payload string, fetched_at timestamp"
#: duplicate_of holds the original's sha256, which is the key of a row here.
IMAGE = (
    "sha256 string, phash string, class_label string, source string, source_id string, source_url string, origin_url string, license string, "
    "license_url string, attribution string, storage_path string, format string, width int, height int, file_size_bytes long, split string, "
    "duplicate_of string, duplicate_distance int, first_seen_run_id string, last_seen_run_id string, retrieved_at timestamp, created_at timestamp, updated_at timestamp"
)
TABLES = {"pipeline_runs": RUN, "raw_records": RAW, "images": IMAGE, "rejections": REJECTION, "run_stage_metrics": METRIC}
EXPORT_COLUMNS = [
    "sha256", "class_label", "split", "relative_path", "source", "source_id", "source_url", "origin_url", "license", "license_url",
    "attribution", "format", "width", "height", "file_size_bytes", "retrieved_at",
]


def columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]
