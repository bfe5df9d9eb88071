"""Equi-joins of a large table with a lookup table of checked size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

from ..session import pin

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_SPLIT = 2_000_000


def _row_bytes(df: DataFrame) -> Column:
    width = F.lit(16 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, ArrayType):
            width = width + F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0))
    return width.cast("bigint")


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` by row count and bytes; each task sends one row of sums."""
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return seen["n"] <= rows and (seen["b"] or 0) <= size


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_split: int = ROWS_PER_SPLIT,
    fits: bool | None = None,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join on the columns ``on``.

    A lookup table measured as small is broadcast, so the big side is not moved
    and no key is hot. Any other is joined by a shuffle in which keys that are
    frequent on either side are spread over several tasks. ``fits`` is the outcome
    of an earlier :func:`fits_broadcast` on rows at least as many and as wide;
    ``spread`` is that of :func:`split_join`.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(lookup, broadcast_rows) if fits is None else fits:
        return big.join(F.broadcast(lookup), keys)
    return split_join(big, lookup, keys, rows_per_split, spread)


def _hot_keys(df: DataFrame, keys: list[str], limit: int, slices: str) -> DataFrame:
    """Keys with more rows than the limit, and how many slices each needs."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > limit)
        .select(*keys, F.ceil(F.col("n") / limit).cast("int").alias(slices))
    )


def split_join(
    big: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    rows_per_split: int = ROWS_PER_SPLIT,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join that cuts keys with many rows on either side into slices.

    Each row takes one slice of its own side and is copied to every slice of the
    other, so that any two rows of a key meet in exactly one task. Keys that are
    hot on neither side are neither cut nor copied. The limit is fixed, so a slice
    never grows with the table. At most one key per ``rows_per_split`` rows is hot;
    their list is stored and broadcast if it is small, else joined by a shuffle.

    A slice follows from a hash that a retried task finds again. ``spread`` names
    columns of the big side that tell rows of a key apart; then nothing of it is
    stored, and only its keys are read beforehand to count them. Without, and
    always for the lookup side, rows are stored with a number that gives the
    slice: rows that agree in all columns spread too.
    """
    keys = list(on)
    lookup = pin(lookup.withColumn("_row", F.monotonically_increasing_id()), "join-lookup")
    if spread is None:
        big = pin(big.withColumn("_row", F.monotonically_increasing_id()), "join-big")
    else:
        big = big.withColumn("_row", F.xxhash64(*spread))
    hot = pin(
        _hot_keys(big, keys, rows_per_split, "big_slices").join(
            _hot_keys(lookup, keys, rows_per_split, "lookup_slices"), keys, "full"
        ),
        "join-hot",
    )
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot

    def place(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("_row"), F.coalesce(f"{own}_slices", F.lit(1))).cast("int")
        copies = F.sequence(F.lit(0), F.coalesce(f"{other}_slices", F.lit(1)) - 1)
        return (
            df.join(hot, keys, "left")
            .withColumn(f"{own}_slice", mine)
            .withColumn(f"{other}_slice", F.explode(copies))
            .drop("big_slices", "lookup_slices", "_row")
        )

    slices = ["big_slice", "lookup_slice"]
    return place(big, "big", "lookup").join(place(lookup, "lookup", "big"), [*keys, *slices]).drop(*slices)
