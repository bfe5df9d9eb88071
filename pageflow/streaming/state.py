"""A look into the state that a streaming query keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Windows that a query by :func:`pageflow.streaming.trending_stream` holds back, with their traffic so far.

    Read from the state store after the last finished batch, or after ``batch_id``.
    With the windows given out already they make up the whole of the input that was not late.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    window, term = (F.col("key")[name] for name in state.schema["key"].dataType.names)
    total = F.col("value")[state.schema["value"].dataType.names[0]]
    return state.select(
        window["start"].alias("window_start"), window["end"].alias("window_end"), term.alias("search_term"), total.alias("traffic_count")
    )
