"""Readers (S1-S5) and writers (K1-K4)."""

from pagesmith.sources.files import (scan_html_pages, scan_json_batches, scan_json_tolerant,
                                     scan_url_list, scan_manifest)
from pagesmith.sources.sinks import (sink_json_batches, sink_text_lines, sink_json_single,
                                     sink_stored_objects)

__all__ = ["scan_html_pages", "scan_json_batches", "scan_json_tolerant", "scan_url_list", "scan_manifest",
           "sink_json_batches", "sink_text_lines", "sink_json_single", "sink_stored_objects"]
