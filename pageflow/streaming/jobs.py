"""Streaming jobs over traffic lines. Each query has a checkpoint folder of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.edges import fold_edges, last_writes, trending_by_window, word_count
from ..operators.index import build_index
from ..plans.store import EdgeStore, replace_partitions
from ..sources.lines import accepted, normalise, parse_lines, parse_pairs, rejected, valid_edges


STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def start(writer: DataStreamWriter, checkpoint: str, once: bool) -> StreamingQuery:
    """``once`` takes all input there is and stops; otherwise the query keeps running."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_with_state(lines: DataFrame, writer: DataStreamWriter, checkpoint: str, once: bool) -> StreamingQuery:
    """Start a query whose state may outgrow the executors' memory: it is kept in RocksDB, with changes uploaded per batch.

    The provider and the number of state partitions (``spark.sql.shuffle.partitions``) are fixed by the first run.
    """
    conf = lines.sparkSession.conf
    before = {name: conf.get(name, None) for name in STATE_SETTINGS}
    try:
        for name, value in STATE_SETTINGS.items():
            conf.set(name, value)
        return start(writer, checkpoint, once)  # the query copies the session's settings when it starts
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def edge_stream(lines: DataFrame, store: EdgeStore, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Normalise lines and upsert them into the store; bad lines go to quarantine.

    ``lines`` carries ``value`` and the arrival columns of the store. A batch is
    fetched and parsed once and kept for both writes. :func:`index_stream` keeps the index.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        number = F.lit(batch_id).cast("bigint")
        parsed = parse_lines(batch).withColumn("batch_id", number).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            store.write_delta(fold_edges(normalise(accepted(parsed)), store.order), batch_id)
            bad = rejected(parsed).select("value", *{*store.order, "batch_id"})
            replace_partitions(bad, store.quarantine, "batch_id")
        finally:
            parsed.unpersist()

    return start(lines.writeStream.foreachBatch(upsert), checkpoint, once)


def total_stream(lines: DataFrame, path: str, order: list[str], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Additive upsert with the totals in Spark's state store: each batch writes the pairs it changed, as they are now.

    What a batch costs follows from its own pairs, not from the table. Its rows lie
    apart by ``batch_id``, so a replayed batch replaces its own;
    :func:`pageflow.operators.edges.newest_totals` reads the table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_partitions(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, "batch_id")

    totals = fold_edges(valid_edges(lines), order).drop("ord")
    return start_with_state(lines, totals.writeStream.outputMode("update").foreachBatch(write), checkpoint, once)


def index_stream(lines: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Insert-if-absent into the word index: pages seen for the first time are taken apart and appended.

    The pages seen before are in the state store, so a batch reads nothing of the index.
    """
    words = build_index(valid_edges(lines))
    return start_with_state(lines, words.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint, once)


def pair_stream(
    lines: DataFrame, table_path: str, document_path: str, checkpoint: str, once: bool = False, aside_path: str | None = None
) -> StreamingQuery:
    """Raw pairs to a table and to JSON documents from one read of the source.

    Any line with two fields has a pair. With ``aside_path``, the other lines are
    kept there. All sinks lie apart by ``batch_id``: a batch that fails between two
    of them is written again as a whole, and replaces what it wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_pairs(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = accepted(parsed).select("referrer", "resource", "batch_id")
            replace_partitions(found, table_path, "batch_id")
            replace_partitions(found, document_path, "batch_id", format="json")
            if aside_path:
                replace_partitions(rejected(parsed).select("value", "batch_id"), aside_path, "batch_id")
        finally:
            parsed.unpersist()

    return start(lines.writeStream.foreachBatch(write), checkpoint, once)


def overwrite_stream(lines: DataFrame, path: str, order: list[str], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Keyed overwrite: the last write per key of each batch, kept apart by ``batch_id``.

    A replayed batch replaces its own rows. ``newest_writes`` reads the table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        last = last_writes(valid_edges(batch), order).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        replace_partitions(last, path, "batch_id")

    return start(lines.writeStream.foreachBatch(write), checkpoint, once)


def word_count_stream(
    texts: DataFrame, text: str, path: str, checkpoint: str, once: bool = False, within: Sequence[str] = ()
) -> StreamingQuery:
    """Word counts of each micro-batch, kept apart by ``batch_id``.

    A micro-batch has fixed costs of seconds. Where counts of small units are
    wanted, let it take many of them, named by the columns ``within``: each is counted on its own.
    """

    def count(batch: DataFrame, batch_id: int) -> None:
        counted = word_count(batch, text, within).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        replace_partitions(counted, path, "batch_id")

    return start(texts.writeStream.foreachBatch(count), checkpoint, once)


def trending_stream(
    lines: DataFrame, event_time: str, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Traffic per page and ten-minute window, appended when the window closes."""
    totals = trending_by_window(valid_edges(lines), event_time)
    return start(totals.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint, once)


def console_stream(rows: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Print what arrives, for a look at a running stream."""
    return start(rows.writeStream.format("console").outputMode("append"), checkpoint, once)
