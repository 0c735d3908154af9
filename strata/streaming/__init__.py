"""Structured Streaming form of the page ingest."""

from strata.streaming.landing import start_bad_page_capture, start_page_ingest

__all__ = ["start_bad_page_capture", "start_page_ingest"]
