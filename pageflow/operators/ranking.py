"""Row numbers within groups, whatever the size of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import pin
from .joins import fits_broadcast


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rank", stored: bool = False
) -> DataFrame:
    """Number the rows of each group from 1 in the given (total) order.

    A window over the group would sort a whole group in one task. Here rows are
    range-partitioned by group *and* order, so a large group covers many tasks in
    sequence. Ids of a slice are consecutive, so a row's number is its id less the
    first id of its group in the slice, plus the rows of the group in earlier
    slices. Both are one row per group and slice; joined back by broadcast if they
    are few. Group columns must not be NULL.

    Range partitioning samples its input, so ``df`` is stored first unless the
    caller says that it is a stored table already.
    """
    keys = [F.col(c) for c in group]
    source = df if stored else pin(df, "unnumbered")
    laid_out = pin(
        source.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_at", 33)),
        "numbered",
    )
    sizes = laid_out.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1 - F.col("_first")
    starts = pin(sizes.select(*group, "_slice", shift.alias("_shift")), "slice-starts")
    starts = F.broadcast(starts) if fits_broadcast(starts) else starts
    return (
        laid_out.join(starts, [*group, "_slice"])
        .withColumn(name, F.col("_at") + F.col("_shift"))
        .drop("_shift", "_at", "_slice")
    )
