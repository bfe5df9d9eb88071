from .parse import count_value, line_fields, strip_line
from .text import (
    index_tokens,
    norm_referrer,
    norm_resource,
    norm_term,
    term_words,
    title_case,
    display_name,
)

__all__ = [
    "count_value",
    "display_name",
    "index_tokens",
    "line_fields",
    "norm_referrer",
    "norm_resource",
    "norm_term",
    "strip_line",
    "term_words",
    "title_case",
]
