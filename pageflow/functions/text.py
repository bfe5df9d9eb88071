"""Page-name and search-term expressions. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import INDEX_EXCLUDES, SENTINEL_REFERRERS


# Any character but an ASCII letter or digit. The class by name is matched several
# times faster than the same class written as three ranges.
NOT_ALNUM = r"\P{Alnum}"


def is_sentinel(name: Column) -> Column:
    return name.isin(*SENTINEL_REFERRERS)


def norm_resource(name: Column) -> Column:
    """One space per character that is no ASCII letter or digit, then lower case; spaces are not collapsed."""
    return F.lower(F.regexp_replace(name, NOT_ALNUM, " "))


def norm_referrer(name: Column) -> Column:
    """Like :func:`norm_resource`, but sentinels pass through unchanged."""
    return F.when(~is_sentinel(name), norm_resource(name)).otherwise(name)


def norm_term(term: Column) -> Column:
    """Lower case first, then clean, collapse and trim."""
    cleaned = F.regexp_replace(F.lower(term), NOT_ALNUM, " ")
    return F.trim(F.regexp_replace(cleaned, " +", " "))


def term_words(normalised_term: Column) -> Column:
    """Query words of a normalised term. Stop words stay; a blank term gives ``['']``."""
    return F.split(normalised_term, " ")


def _kept(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin(["", *INDEX_EXCLUDES]))


def index_tokens(name: Column) -> Column:
    """Distinct index words of a page name, tested against the stop list before and after lower-casing."""
    words = F.split(F.regexp_replace(name, NOT_ALNUM, " "), " ")
    return F.array_distinct(_kept(F.transform(_kept(words), F.lower)))


def title_case(name: Column) -> Column:
    """Words split on runs of blanks, ``_`` and ``-``, each capitalised, joined by one space."""
    return F.initcap(F.regexp_replace(F.lower(name), r"[\s_-]+", " "))


def display_name(name: Column) -> Column:
    """:func:`title_case` for pages; sentinels are shown as they are."""
    return F.when(is_sentinel(name), name).otherwise(title_case(name))
