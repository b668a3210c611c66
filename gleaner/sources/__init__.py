"""Readers and parsers of landed payloads, pages and image bytes."""
