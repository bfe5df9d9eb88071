"""From a listing page to published lines: find new months, read their dumps, record them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import strip_line
from ..operators.joins import lookup_join
from ..schemas import DUMP_FILE_NAME, LEDGER, LINE
from ..session import pin
from ..sources.ledger import append_ledger, listed_months, new_months, read_ledger_table
from ..sources.lines import folder_of_path, list_files, month_of_path, valid_edges
from .store import replace_partitions


@dataclass(frozen=True)
class Ingested:
    """Names that had lines and are now in the ledger, and listed names without a file, as tables of ``date``."""

    loaded: DataFrame
    missing: DataFrame


def ingest_months(
    spark: SparkSession,
    listing: DataFrame,
    ledger_path: str,
    dump_root: str,
    publish: Callable[[DataFrame], None],
    edition: str = "*",
    partitions: int | None = None,
    file_pattern: str | None = None,
) -> Ingested:
    """Publish the lines of every new listed name in one job and record the names that had lines.

    A name is the folder its files lie in; any name the listing offers counts. One
    whose file is missing is not recorded, so a later run tries it again; it comes
    back in ``missing``. Only file names are listed before the new ones are read.
    """
    fresh = pin(new_months(listed_months(listing), read_ledger_table(spark, ledger_path)), "fresh")
    pattern = file_pattern or DUMP_FILE_NAME.format(edition=edition, month="*")
    try:
        files = list_files(spark, dump_root, pattern)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path STRING, folder STRING")
    wanted = pin(lookup_join(files, fresh.select(F.col("date").alias("folder")), "folder"), "dump-files")
    there = wanted.select(F.col("folder").alias("date")).distinct()
    absent = fresh.join(there, "date", "left_anti")
    paths = [row["path"] for row in wanted.select("path").collect()]  # file names, as the scan's own planning holds them
    if not paths:
        return Ingested(spark.createDataFrame([], LEDGER), absent)
    lines = spark.read.schema(LINE).text(paths).select(
        folder_of_path(F.col("_metadata.file_path")).alias("date"), strip_line(F.col("value")).alias("value")
    )
    lines = lines.repartition(partitions) if partitions else lines
    seen = Observation("months read")
    publish(lines.observe(seen, F.collect_set("date").alias("dates")).select("value"))
    loaded = spark.createDataFrame([(d,) for d in sorted(seen.get["dates"])], LEDGER)
    if seen.get["dates"]:
        append_ledger(loaded, ledger_path)
    return Ingested(loaded, absent)


def ingest_metrics(parsed: DataFrame, write: Callable[[DataFrame], None]) -> DataFrame:
    """Counters of one load, taken while ``write`` runs, without a pass of their own."""
    seen = Observation("ingest")
    valid = F.col("valid")
    counted = parsed.observe(
        seen,
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(valid).alias("n_valid"),
        F.count_if(~valid).alias("n_quarantined"),
        F.coalesce(F.sum(F.when(valid, F.col("count"))), F.lit(0)).alias("traffic"),
    )
    write(counted)
    names = ["n_lines", "n_valid", "n_quarantined", "traffic"]
    row = tuple(seen.get[name] for name in names)
    return parsed.sparkSession.createDataFrame([row], ", ".join(f"{n} BIGINT" for n in names))


def ingest_stream(
    spark: SparkSession,
    dump_root: str,
    path: str,
    ledger_path: str,
    checkpoint: str,
    file_pattern: str | None = None,
    archive: str | None = None,
    files_per_trigger: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Load each dump file below ``dump_root`` once, as files appear, and record the months that had lines.

    The checkpoint holds the source's own log of files seen, so no listing is
    compared with the ledger and no file is read twice. Edges of a batch lie in their
    own ``batch_id`` (:func:`pageflow.plans.store.replace_partitions`), the
    ledger takes a month any number of times; a replayed batch changes neither. With
    ``archive``, a folder outside of ``dump_root``, files of finished batches are
    moved there.
    """
    reader = spark.readStream.schema(LINE).option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", file_pattern or DUMP_FILE_NAME.format(edition="*", month="*"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    lines = reader.format("text").load(dump_root).select(
        month_of_path(F.col("_metadata.file_path")).alias("month"), strip_line(F.col("value")).alias("value")
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        edges = valid_edges(batch).groupBy("month", "referrer", "resource", "type").agg(
            F.sum("count").alias("count"), F.count(F.lit(1)).alias("n_lines")
        )
        replace_partitions(edges.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, "batch_id")
        done = spark.read.schema("month STRING, batch_id BIGINT").parquet(path).where(F.col("batch_id") == batch_id)
        append_ledger(done.select(F.col("month").alias("date")), ledger_path)

    writer = lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
