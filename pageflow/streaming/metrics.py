"""Counters of a running stream: one row per batch, taken while the batch runs."""

from __future__ import annotations

import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sources.lines import accepted, normalise, parse_lines
from .jobs import start_with_state

COUNTERS = "batch_id BIGINT, n_lines BIGINT, n_valid BIGINT, n_quarantined BIGINT, traffic BIGINT, n_late BIGINT"
OBSERVED = "line counters"


def counted(parsed: DataFrame, name: str = OBSERVED) -> DataFrame:
    """Parsed lines whose counters come with each batch's progress, without a pass of their own."""
    valid = F.col("valid")
    return parsed.observe(
        name,
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(valid).alias("n_valid"),
        F.count_if(~valid).alias("n_quarantined"),
        F.coalesce(F.sum(F.when(valid, F.col("count"))), F.lit(0)).alias("traffic"),
    )


class BatchCounters(StreamingQueryListener):
    """Collects the counters of every batch with input, of any query that :func:`counted` is part of.

    ``n_late`` are the rows that stateful operators left out as older than the
    watermark. Register it with ``spark.streams.addListener``. The newest ``keep``
    batches are held on the driver, one small row each.
    """

    def __init__(self, name: str = OBSERVED, keep: int = 100_000):
        self.name, self.rows, self._ended, self._changed = name, deque(maxlen=keep), set(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        if seen is None or not progress.numInputRows:
            return
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        self.rows.append((progress.batchId, seen["n_lines"], seen["n_valid"], seen["n_quarantined"], seen["traffic"], late))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the last batch of an ended query has been counted: events arrive after the fact, in order."""
        query.awaitTermination()
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError("the end of the query was not announced")

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), COUNTERS)


def load_once_stream(
    lines: DataFrame, key: str, event_time: str, path: str, checkpoint: str, late: str = "10 minutes", once: bool = False
) -> StreamingQuery:
    """Valid lines to a table, each message once: one that is delivered again within ``late`` is left out.

    Messages older than the watermark can no longer be told from repeats and are left out, too;
    :class:`BatchCounters` counts them. ``key`` names the message.
    """
    parsed = counted(parse_lines(lines.withWatermark(event_time, late)))
    fresh = normalise(accepted(parsed)).drop("value").dropDuplicatesWithinWatermark([key])
    return start_with_state(lines, fresh.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint, once)
