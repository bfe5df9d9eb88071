"""Bounded, reproducible samples of labelled rows, and parameters averaged over shards."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .shipping import ship

SHARD_ROWS = 2_500


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds


def bounded_sample(rows: DataFrame, id_column: str, limit: int) -> DataFrame:
    """The ``limit`` rows with the lowest hash of the id, as a new sample of equal size at every scale.

    ``rows`` should be narrow. The result is small by its bound and may be broadcast.
    """
    return rows.orderBy(F.xxhash64(F.lit("sample"), F.col(id_column)), id_column).limit(limit)


def one_per_id(rows: DataFrame, *labels: str) -> DataFrame:
    """``doc_id``, ``text`` and labels of one row per id: the text with the least hash. Combined within tasks first."""
    first = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return rows.groupBy("doc_id", *labels).agg(first)


def train_shards(
    examples: DataFrame, order: str, fit: Callable, start: np.ndarray, rounds: int, shard_rows: int = SHARD_ROWS
) -> np.ndarray:
    """Train on shards of a stored, bounded sample at once, and average what they learn after each round.

    ``fit(pandas rows in order, parameters, round)`` returns new parameters. A
    shard holds about ``shard_rows`` rows, by the hash of ``order``. The average
    counts shards by their rows. Only parameter vectors come to the driver.
    """
    ship(examples.sparkSession)
    shards = max(1, -(-examples.count() // shard_rows))
    sharded = examples.withColumn("_shard", F.pmod(F.xxhash64(F.lit("shard"), F.col(order)), F.lit(shards)))
    context, now = examples.sparkSession.sparkContext, start.astype(np.float32)
    for turn in range(rounds):
        given = context.broadcast(now)
        found = sharded.groupBy("_shard").applyInPandas(_learner(fit, given, turn, order), "n long, learned binary").collect()
        if not found:
            return now
        found.sort(key=lambda r: bytes(r["learned"]))  # a fixed order of summing
        total = sum(r["n"] for r in found)
        now = sum(np.frombuffer(r["learned"], np.float32) * np.float32(r["n"] / total) for r in found)
        given.unpersist()
    return now


def _learner(fit: Callable, given, turn: int, order: str) -> Callable:
    def run(rows):
        rows = rows.sort_values(order, kind="stable")
        learned = fit(rows, given.value.copy(), turn).astype(np.float32)
        return pd.DataFrame({"n": [len(rows)], "learned": [learned.tobytes()]})

    return run
