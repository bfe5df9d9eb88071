from .lines import (
    parse_lines,
    read_dumps,
    read_folder,
    rejected,
    accepted,
    valid_edges,
)
from .ledger import (
    anchor_texts,
    export_ledger,
    listed_months,
    merge_ledger,
    new_months,
    read_ledger_file,
    read_ledger_table,
)
from .topic import publish_to_files, publish_to_topic, read_topic, stream_topic, stream_files

__all__ = [
    "accepted",
    "anchor_texts",
    "export_ledger",
    "listed_months",
    "merge_ledger",
    "new_months",
    "parse_lines",
    "publish_to_files",
    "publish_to_topic",
    "read_dumps",
    "read_folder",
    "read_ledger_file",
    "read_ledger_table",
    "read_topic",
    "rejected",
    "stream_files",
    "stream_topic",
    "valid_edges",
]
