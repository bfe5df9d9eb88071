"""Table contracts and the fixed word lists shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# Referrers that stand for traffic from outside the page graph.
# They are never normalised and never title-cased.
SENTINEL_REFERRERS = (
    "other-internal",
    "other-search",
    "other-external",
    "other-empty",
    "other-other",
)

# Words left out of the inverted index. The capital "I" is part
# of the contract: pages are lower-cased before indexing, so "i" is indexed.
STOP_WORDS = (
    "a", "an", "the", "and", "or", "but", "is", "are", "was", "were",
    "be", "been", "being", "have", "has", "had", "do", "does", "did",
    "not", "no", "of", "off", "in", "on", "at", "by", "with", "about",
    "into", "to", "from", "up", "out", "over", "under",
    "I", "you", "he", "she", "it", "we", "they", "me", "my", "mine",
    "our", "ours", "your", "yours", "his", "her", "its", "their", "theirs",
)

INDEX_EXCLUDES = STOP_WORDS + SENTINEL_REFERRERS

FIELD_DELIMITER = "\t"
MONTH_PREFIX = "20"

# Fixed value: naming of the monthly dump files below their month folder.
DUMP_FILE_NAME = "clickstream-{edition}-{month}.tsv.gz"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


LINE = T.StructType(_strings("value"))

# key: (referrer, resource)
EDGE = T.StructType(
    _strings("referrer", "resource", "type") + [T.StructField("count", T.LongType())]
)

# key: (word, resource)
SEARCH_INDEX = T.StructType(_strings("word", "resource"))

# key: date
LEDGER = T.StructType(_strings("date"))

# key: (search_term, source, type), last write wins
RESOURCE_DESTINATION = T.StructType(
    _strings("search_term", "source", "type") + [T.StructField("count", T.LongType())]
)

# key: search_term
TRENDING = T.StructType(
    _strings("search_term") + [T.StructField("traffic_count", T.LongType())]
)

PAIR = T.StructType(_strings("referrer", "resource"))

EDGE_KEY = ("referrer", "resource")
INDEX_KEY = ("word", "resource")
DESTINATION_KEY = ("search_term", "source", "type")
