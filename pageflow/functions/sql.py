"""The name and line expressions as functions of the session, for users who write SQL text.

They are SQL functions, not Python ones: Spark puts their bodies into the plan of
the statement that calls them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import FIELD_DELIMITER, INDEX_EXCLUDES, SENTINEL_REFERRERS
from .parse import LINE_BLANKS, count_value


def _list(items: tuple[str, ...]) -> str:
    return ", ".join(f"'{i}'" for i in items)


def _blanks() -> str:
    return "".join(f"\\u{ord(c):04x}" for c in LINE_BLANKS)


_LINE = "referrer STRING, resource STRING, type STRING, count BIGINT, n_fields INT"

SCALAR = {
    "norm_resource(name STRING)": ("STRING", r"lower(regexp_replace(name, '\\P{Alnum}', ' '))"),
    "norm_referrer(name STRING)": ("STRING", f"CASE WHEN name IN ({_list(SENTINEL_REFERRERS)}) THEN name ELSE norm_resource(name) END"),
    "norm_term(term STRING)": ("STRING", r"trim(regexp_replace(regexp_replace(lower(term), '\\P{Alnum}', ' '), ' +', ' '))"),
    "kept_words(words ARRAY<STRING>)": ("ARRAY<STRING>", f"filter(words, w -> w NOT IN ('', {_list(INDEX_EXCLUDES)}))"),
    "index_tokens(name STRING)": (
        "ARRAY<STRING>",
        r"array_distinct(kept_words(transform(kept_words(split(regexp_replace(name, '\\P{Alnum}', ' '), ' ')), w -> lower(w))))",
    ),
    "title_case(name STRING)": ("STRING", r"initcap(regexp_replace(lower(name), '[\\s_-]+', ' '))"),
    "display_name(name STRING)": ("STRING", f"CASE WHEN name IN ({_list(SENTINEL_REFERRERS)}) THEN name ELSE title_case(name) END"),
    "strip_line(value STRING)": ("STRING", f"trim(BOTH '{_blanks()}' FROM value)"),
}

TABLE = {
    "index_words(name STRING)": ("word STRING", "SELECT explode(t) FROM (SELECT index_tokens(name) AS t)"),
    "term_words(term STRING)": ("position INT, word STRING", "SELECT posexplode(t) FROM (SELECT split(norm_term(term), ' ') AS t)"),
    "both_ways(a STRING, b STRING)": (
        "referrer STRING, resource STRING", "SELECT inline(array(named_struct('x', a, 'y', b), named_struct('x', b, 'y', a)))"
    ),
    "line_fields(value STRING)": (
        _LINE,
        f"SELECT get(f, 0), get(f, 1), get(f, 2), {count_value('get(f, 3)')}, size(f) "
        f"FROM (SELECT explode(array(f)) AS f FROM (SELECT split(strip_line(value), '{FIELD_DELIMITER}') AS f))",
    ),
}


def register_functions(spark: SparkSession) -> None:
    """Create the functions as temporary ones of this session; doing so again changes nothing."""
    for signature, (kind, body) in SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    for signature, (columns, body) in TABLE.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS TABLE ({columns}) RETURN {body}")
