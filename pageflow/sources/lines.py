"""Traffic lines: file scans, parsing, and the split into valid and quarantined rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.parse import count_value, line_fields, strip_line
from ..functions.text import norm_referrer, norm_resource
from ..schemas import DUMP_FILE_NAME, LINE

MONTH_IN_PATH = r".*[/=-](\d{4}-\d{2})(?:[./]|$)"


def read_folder(spark: SparkSession, folder: str, suffix: str = ".tsv") -> DataFrame:
    """Lines of every file in a folder whose name ends in ``suffix``; gzip is decoded by the source."""
    return (
        spark.read.schema(LINE)
        .option("pathGlobFilter", f"*{suffix}")
        .text(folder)
        .select(strip_line(F.col("value")).alias("value"))
    )


def dump_path(root: str, month: str, edition: str) -> str:
    return f"{root}/{month}/{DUMP_FILE_NAME.format(edition=edition, month=month)}"


def month_of_path(path: Column) -> Column:
    """The last ``yyyy-MM`` that stands alone in a path."""
    return F.regexp_extract(path, MONTH_IN_PATH, 1)


#: What orders lines of dump files: the file, the part of it that one task reads, the line in that part.
DUMP_ORDER = ("file", "block", "line")


def folder_of_path(path: Column) -> Column:
    """Name of the folder a file lies in; of a partition folder, its value."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -2), "^[^=]*=", "")


def list_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """``path`` and ``folder`` of all files below ``root`` with a name that fits; contents are not read."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    )
    return found.select("path", folder_of_path(F.col("path")).alias("folder"))


def read_dumps(
    spark: SparkSession, paths: str | Iterable[str], partitions: int | None = None, ordered: bool = False
) -> DataFrame:
    """All dump files at once as ``(month, value)``; with ``ordered``, also the arrival columns ``DUMP_ORDER``.

    A gzip file is one task however large it is, so give ``partitions`` to spread
    the decoded lines before heavy work. Line numbers rise within the part of a
    file that a task reads; they are not consecutive.
    """
    place = [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ]
    wanted = [paths] if isinstance(paths, str) else list(paths)
    lines = (
        spark.read.schema(LINE)
        .option("recursiveFileLookup", "true")
        .text(wanted)
        .select(
            month_of_path(F.col("_metadata.file_path")).alias("month"),
            strip_line(F.col("value")).alias("value"),
            *(place if ordered else []),
        )
    )
    return lines.repartition(partitions) if partitions else lines


def parse_pairs(lines: DataFrame) -> DataFrame:
    """Add ``referrer, resource, valid`` from the first two fields of any line; other columns are kept."""
    kept = [c for c in lines.columns if c != "value"]
    taken_apart = lines.select(*kept, strip_line(F.col("value")).alias("value")).select(
        *kept, "value", F.explode(F.array(line_fields(F.col("value")))).alias("fields")
    )
    parsed = taken_apart.selectExpr(*kept, "value", "get(fields, 0) AS referrer", "get(fields, 1) AS resource")
    return parsed.withColumn("valid", F.expr("coalesce(referrer, '') <> '' AND coalesce(resource, '') <> ''"))


def parse_lines(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``referrer, resource, type, count, valid``; other columns are kept.

    Lenient mode ignores fields after the fourth, strict mode wants exactly four.
    The fields pass through a one-element explode: a later filter on them then
    reads the split result, where Catalyst would else push it below the split and
    take the line apart again for every condition.
    """
    kept = [c for c in lines.columns if c != "value"]
    taken_apart = lines.select(*kept, strip_line(F.col("value")).alias("value")).select(
        *kept, "value", F.explode(F.array(line_fields(F.col("value")))).alias("fields")
    )
    parsed = taken_apart.selectExpr(
        *kept,
        "value",
        "get(fields, 0) AS referrer",
        "get(fields, 1) AS resource",
        "get(fields, 2) AS type",
        f"{count_value('get(fields, 3)')} AS count",
        "size(fields) AS n_fields",
    )
    valid = "count IS NOT NULL AND coalesce(referrer, '') <> '' AND coalesce(resource, '') <> ''"
    if strict:
        valid += " AND n_fields = 4"
    return parsed.withColumn("valid", F.expr(valid)).drop("n_fields")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("valid").drop("valid")


def rejected(parsed: DataFrame) -> DataFrame:
    """The quarantine: exactly the lines :func:`accepted` leaves out."""
    return parsed.where(~F.col("valid")).drop("valid")


def normalise(edges: DataFrame) -> DataFrame:
    return edges.withColumn("referrer", norm_referrer(F.col("referrer"))).withColumn(
        "resource", norm_resource(F.col("resource"))
    )


def valid_edges(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Lines to normalised edge rows, one per valid line."""
    return normalise(accepted(parse_lines(lines, strict))).drop("value")
