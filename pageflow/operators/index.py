"""The inverted word index over page names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import index_tokens
from ..schemas import INDEX_KEY


def build_index(edges: DataFrame) -> DataFrame:
    """``(word, resource)`` for every page that receives traffic; on a stream, for every page not seen before.

    Pages are made distinct before they are taken apart. Words are distinct
    within a page, so the result needs no second shuffle.
    """
    return (
        edges.select("resource")
        .dropDuplicates(["resource"])
        .select(F.explode(index_tokens(F.col("resource"))).alias("word"), "resource")
    )


def new_index_rows(index: DataFrame, candidates: DataFrame, distinct: bool = False) -> DataFrame:
    """Rows of ``candidates`` that the index does not hold yet, each once.

    ``distinct`` says that no candidate is repeated, as in what :func:`build_index` makes; that saves a shuffle.
    """
    fresh = candidates if distinct else candidates.distinct()
    return fresh.join(index, list(INDEX_KEY), "left_anti")
