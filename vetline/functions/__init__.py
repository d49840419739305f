from vetline.functions.html import text_nodes, unescape, visible_text_lines
from vetline.functions.jsonfields import bool_or_null, empty_json_to_null, json_fields
from vetline.functions.names import (
    date_prefix,
    entity_hash,
    normalize_name,
    normalize_name_ascii,
    packed_trigrams,
    person_name,
    safe_text,
    trigram_similarity,
    trigrams,
)
from vetline.functions.status import classify_http_reason, coverage_severity, screening_verdict
from vetline.functions.text import clean_html_spaced, display_text, strip_tags

__all__ = [
    "bool_or_null",
    "classify_http_reason",
    "clean_html_spaced",
    "coverage_severity",
    "date_prefix",
    "display_text",
    "empty_json_to_null",
    "entity_hash",
    "json_fields",
    "normalize_name",
    "normalize_name_ascii",
    "packed_trigrams",
    "person_name",
    "safe_text",
    "screening_verdict",
    "strip_tags",
    "text_nodes",
    "trigram_similarity",
    "trigrams",
    "unescape",
    "visible_text_lines",
]
