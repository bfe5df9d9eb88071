from .edges import (
    fold_edges,
    key_report,
    last_write_wins,
    last_writes,
    merge_edges,
    newest_totals,
    newest_writes,
    pairs,
    symmetric_pairs,
    trending,
    trending_by_window,
    word_count,
)
from .index import build_index, new_index_rows
from .joins import lookup_join
from .ranking import number_rows
from .search import (
    Bucketed,
    Keyed,
    SearchTables,
    by_traffic,
    direct_lookup,
    incoming,
    outgoing,
    prepare_terms,
    ranked_pages,
    related_pages,
    response_pages,
    response_json,
    response_rows,
    response_text,
    resolve_terms,
    search,
    select_first,
    select_pages,
    top_pages,
    traffic_series,
)

__all__ = [
    "Bucketed",
    "Keyed",
    "SearchTables",
    "build_index",
    "by_traffic",
    "direct_lookup",
    "fold_edges",
    "incoming",
    "key_report",
    "last_write_wins",
    "last_writes",
    "lookup_join",
    "merge_edges",
    "newest_totals",
    "newest_writes",
    "new_index_rows",
    "number_rows",
    "outgoing",
    "pairs",
    "prepare_terms",
    "ranked_pages",
    "related_pages",
    "response_json",
    "response_pages",
    "resolve_terms",
    "response_rows",
    "response_text",
    "search",
    "select_first",
    "select_pages",
    "symmetric_pairs",
    "top_pages",
    "traffic_series",
    "trending",
    "trending_by_window",
    "word_count",
]
