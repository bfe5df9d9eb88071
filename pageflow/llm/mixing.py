"""Mix sources to target weights by capped water-filling.

A source's target is its weight's share of all words, but at most ``max_epochs``
times what the source holds. What a capped source cannot take is shared among
the others by weight until no target is above its cap. Whole documents are then
taken: ``floor(target / held)`` times each, and once more for an evenly spread,
seeded part of the documents that covers the fraction.

Only DataFrame functions are used. Hot sources are no single group anywhere:
documents are cut into cells of like size by two digits of a hash, and only
counts of cells are added up per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import fits_broadcast
from ..operators.ranking import number_rows
from ..session import pin

# Fixed value: what a word is.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 17


def word_count(text: str | Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def with_size(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", word_count("text"))


def _source_key(source: Column) -> Column:
    """A text that is never null and sorts by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _cells(sized: DataFrame, id_column: str, seed: int) -> DataFrame:
    """Add the source key, a seeded mark, and the cell: digits, leading two digits, part of the mark."""
    digits = F.col("size").cast("string")
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))
    return (
        sized.withColumn("_source", _source_key(F.col("source")))
        .withColumn("_mark", mark)
        .withColumn("_class", F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int"))
        .withColumn("_part", F.substring("_mark", 1, 2))
    )


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to rows of (``_source``, ``source_size``, ``weight``).

    Each round fixes the sources that the present level takes to their cap and
    raises the level for the rest. Two sums per round come to the driver.
    """
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        row = sources.agg(F.sum(F.when(full, cap)).alias("fixed"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if row["open"] is None:
            break
        raised = (total - (row["fixed"] or 0)) / row["open"]
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))


def mix_sources(
    sized: DataFrame,
    id_column: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """Add ``source_size``, ``target``, ``copies`` and ``taken`` to rows with ``source`` and ``size``.

    ``weights`` repeat over the sources in code point order, null last. Of a
    source's documents in order of size, every one that carries the running
    fraction over a whole number is taken once more, so the words taken differ
    from the target by half the largest document at most. Then one document per
    source, whose size is nearest to what is still missing or too much, changes
    sides. The input is read twice, so it should be a stored table.

    Null ids, sources and repeated rows are kept: rows that agree in all columns
    are interchangeable. A source without words has target 0. An empty input
    gives an empty result. Other columns pass through; names that begin with
    ``_`` are reserved, and input columns with the names of the four added ones
    are replaced.
    """
    sized = sized.drop("source_size", "target", "copies", "taken")
    marked = _cells(sized, id_column, seed)
    cell = ["_source", "_class", "_part"]
    cells = pin(
        marked.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_words")), "mix-cells"
    )
    held = pin(cells.groupBy("_source").agg(F.sum("_words").alias("source_size")), "mix-sources")
    turn = (F.col("_turn") - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    sources = pin(number_rows(held, [], [F.col("_source")], "_turn").withColumn("weight", weight), "mix-weights")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    filled = water_fill(sources, max_epochs).select("_source", "source_size", "target", rate.alias("_rate"))
    earlier = Window.partitionBy("_source").orderBy("_class", "_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(filled, "_source")
    at = F.row_number().over(Window.partitionBy(*cell).orderBy("size", "_mark", id_column)) + F.col("_before")
    whole = F.floor("_rate")
    part = F.col("_rate") - whole
    extra = F.floor(part * at + 0.5) - F.floor(part * (at - 1) + 0.5)
    decided = pin(
        marked.join(placed.drop("_n", "_words"), cell)
        .withColumn("_at", at)
        .withColumn("_extra", F.floor(part * F.col("_at") + 0.5) - F.floor(part * (F.col("_at") - 1) + 0.5))
        .withColumn("copies", (whole + F.col("_extra")).cast("bigint")),
        "mix-decided",
    )
    changes = _changes(decided, filled)
    changes = F.broadcast(changes) if fits_broadcast(changes) else changes
    return (
        decided.join(changes, ["_source", "_at"], "left")
        .withColumn("copies", F.col("copies") + F.coalesce("_change", F.lit(0)))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(*sized.columns, "source_size", "target", "copies", "taken")
    )


def _changes(decided: DataFrame, filled: DataFrame) -> DataFrame:
    """For each source the one document, by its place, whose change of sides brings the mix nearest to the target."""
    taken = decided.groupBy("_source").agg(F.sum(F.col("copies") * F.col("size")).alias("_taken"))
    missing = filled.join(taken, "_source").select("_source", (F.col("target") - F.col("_taken")).alias("_missing"))
    side = F.when(F.col("_missing") > 0, F.lit(0)).otherwise(F.lit(1))
    left = F.abs(F.abs("_missing") - F.col("size"))
    return (
        decided.where(F.col("_rate") > F.floor("_rate"))
        .select("_source", "_at", "size", "_extra")
        .join(missing, "_source")
        .where((F.col("_extra") == side) & (left < F.abs("_missing")))
        .groupBy("_source")
        .agg(F.min(F.struct(left.alias("left"), F.col("_at"), F.signum("_missing").cast("int").alias("_change"))).alias("best"))
        .select("_source", "best._at", "best._change")
    )


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """One row per copy that the mix takes, numbered in ``copy`` from 1."""
    return mixed.where(F.col("copies") > 0).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
