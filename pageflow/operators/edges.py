"""Keyed totals over traffic edges.

Every aggregate here combines on the map side and is associative, so a key that
holds a large share of all rows leaves each task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import DESTINATION_KEY, EDGE_KEY


def arrival(*columns: str) -> Column:
    """Arrival order as one comparable value."""
    return F.struct(*columns)


def fold_edges(edges: DataFrame, order: Sequence[str]) -> DataFrame:
    """Additive upsert of edge rows: summed count and first-seen type per pair.

    ``ord`` stays in the result, which makes it a partial that
    :func:`merge_edges` can fold again with others.
    """
    return _fold(edges.withColumn("ord", arrival(*order)))


def merge_edges(partials: DataFrame) -> DataFrame:
    return _fold(partials)


def _fold(rows: DataFrame) -> DataFrame:
    # A buffer that holds strings is aggregated by sorting. With a hash as the first key, rows are told apart by
    # eight bytes instead of by names that start alike. It decides nothing; the state of a stream does without.
    keys = [*EDGE_KEY] if rows.isStreaming else [F.xxhash64(*EDGE_KEY).alias("_hash"), *EDGE_KEY]
    folded = rows.groupBy(*keys).agg(
        F.min_by("type", "ord").alias("type"),
        F.sum("count").alias("count"),
        F.min("ord").alias("ord"),
    )
    return folded.select(*EDGE_KEY, "type", "count", "ord")


def last_write_wins(edges: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows keyed by page, source and type; the latest arrival overwrites the count."""
    return last_writes(edges, order).drop("ord")


def last_writes(edges: DataFrame, order: Sequence[str]) -> DataFrame:
    """:func:`last_write_wins` with the arrival ``ord`` of each row, for :func:`newest_writes` to fold again."""
    return newest_writes(edges.select(
        F.col("resource").alias("search_term"),
        F.col("referrer").alias("source"),
        "type",
        "count",
        arrival(*order).alias("ord"),
    ))


def newest_writes(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*DESTINATION_KEY).agg(F.max_by("count", "ord").alias("count"), F.max("ord").alias("ord"))


def newest_totals(rows: DataFrame) -> DataFrame:
    """The edge table from totals written batch by batch (``batch_id``): of each pair the last."""
    last = F.max_by(F.struct("type", "count"), "batch_id").alias("last")
    return rows.groupBy(*EDGE_KEY).agg(last).select(*EDGE_KEY, "last.type", "last.count")


def trending(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("resource").alias("search_term")).agg(F.sum("count").alias("traffic_count"))


def trending_by_window(edges: DataFrame, event_time: str, width: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Traffic per page and tumbling window; on a stream, windows close once the watermark passes them."""
    return (
        edges.withWatermark(event_time, late)
        .groupBy(F.window(event_time, width).alias("w"), F.col("resource").alias("search_term"))
        .agg(F.sum("count").alias("traffic_count"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "search_term",
            "traffic_count",
        )
    )


def pairs(edges: DataFrame) -> DataFrame:
    return edges.select("referrer", "resource")


def symmetric_pairs(edges: DataFrame) -> DataFrame:
    """Each pair in both directions, in one pass over the input."""
    a, b = F.col("referrer"), F.col("resource")
    both = F.array(
        F.struct(a.alias("referrer"), b.alias("resource")),
        F.struct(b.alias("referrer"), a.alias("resource")),
    )
    return edges.select(F.inline(both))


def word_count(texts: DataFrame, text: str, within: Sequence[str] = ()) -> DataFrame:
    """Words split on a single space: case is kept and empty strings count. Counted apart by the columns ``within``."""
    return (
        texts.select(*within, F.explode(F.split(F.col(text), " ")).alias("word"))
        .groupBy(*within, "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def key_report(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Row count, distinct key count and the number of rows in excess of one per key."""
    per_key = table.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_excess"),
    )
