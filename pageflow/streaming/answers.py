"""Search of terms as they arrive: a stream of terms against the stored tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import fits_broadcast
from ..operators.search import (
    PAGE_ROWS, SearchTables, findings, fitting, normal_terms, query_words, ranked_findings, response_pages, select_fitting,
)
from ..plans.store import replace_partitions
from ..session import pin
from .jobs import start

#: One row per finding; one without a section per term, found or not.
ANSWER = (
    "term", "status", "selected", "section", "weight", "tie", "resource", "referrer", "type", "count", "batch_id",
)


def answer_stream(terms: DataFrame, tables: SearchTables, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Answer each term of a stream (``term``) and append what is found, one row per finding.

    The lookup of words is a join of the stream with the stored index; with
    :class:`Bucketed` tables only the batch's words move. What a batch finds is kept
    for the selection and the traffic of the selected pages, and written once. A term
    that comes again is answered again; :func:`answers` reads the newest answer.
    """
    prepared = normal_terms(terms.select("term"))
    hits = tables.index.match(query_words(prepared))
    asked = prepared.withColumns(
        {"position": F.lit(None).cast("int"), "word": F.lit(None).cast("string"), "resource": F.lit(None).cast("string")}
    )
    both = hits.select(*asked.columns).unionByName(asked)

    def answer(batch: DataFrame, batch_id: int) -> None:
        batch = batch.distinct().persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = fitting(batch.where(F.col("resource").isNotNull()))
            named = batch.where(F.col("resource").isNull()).select("term", "norm", "words", "status")
            resolved = pin(named.join(select_fitting(found).select("term", "selected"), "term", "left"), "answered-terms")
            fits = fits_broadcast(resolved)
            rows = findings(tables, resolved, found, fits)
            each = resolved.select("term", "status", "selected")
            written = rows.unionByName(each, allowMissingColumns=True).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            replace_partitions(written.select(*ANSWER), path, "batch_id")
        finally:
            batch.unpersist()

    return start(both.writeStream.foreachBatch(answer), checkpoint, once)


def answers(rows: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Nested answers from what :func:`answer_stream` wrote: of each term the newest, in pages."""
    newest = rows.where(F.col("section").isNull()).groupBy("term").agg(F.max(F.struct("batch_id", "status", "selected")).alias("last"))
    newest = pin(newest.select("term", "last.*"), "newest-answers")
    current = newest.select("term", "batch_id")
    current = F.broadcast(current) if fits_broadcast(current) else current
    held = rows.where(F.col("section").isNotNull()).join(current, ["term", "batch_id"]).drop("batch_id")
    return response_pages(ranked_findings(held), newest, page_rows)
