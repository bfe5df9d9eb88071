from .answers import answer_stream
from .jobs import (
    console_stream,
    edge_stream,
    index_stream,
    overwrite_stream,
    pair_stream,
    total_stream,
    trending_stream,
    word_count_stream,
)
from .metrics import BatchCounters, counted

__all__ = [
    "BatchCounters",
    "answer_stream",
    "console_stream",
    "counted",
    "edge_stream",
    "index_stream",
    "overwrite_stream",
    "pair_stream",
    "total_stream",
    "trending_stream",
    "word_count_stream",
]
