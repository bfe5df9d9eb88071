"""The edge store that a stream fills batch by batch, and the layouts a search reads.

Only files and partition overwrites are needed. A batch is folded to one row per
pair and written to its own ``batch_id`` partition. Writing the same batch again
replaces that partition, so a replay after a failure changes nothing. The edge
table is the fold of all batches.

Search layouts are written from an edge table by a job of their own, on whatever
schedule suits: as folders by key hash (:func:`write_search_tables`), as tables
that Spark keeps in buckets (:func:`write_bucketed_tables`), or as one sorted
copy with Bloom filters for single lookups (:func:`write_point_tables`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.edges import merge_edges
from ..operators.index import build_index
from ..operators.search import Bucketed, Keyed, SearchTables, bucket_of
from ..schemas import EDGE, LEDGER, RESOURCE_DESTINATION, SEARCH_INDEX, TRENDING

#: The batch comes first: what a later batch brings never changes a type.
TOPIC_ORD = "batch_id BIGINT, timestamp TIMESTAMP, partition INT, offset BIGINT"
BUCKETS = 64
SLICES = 8


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace_partitions(df: DataFrame, path: str, *columns: str, format: str = "parquet") -> None:
    """Overwrite just the partitions that ``df`` holds; they appear when the job commits."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .format(format)
        .save(path)
    )


@dataclass(frozen=True)
class EdgeStore:
    """Folders of one store. ``ord`` is the DDL of the arrival order kept with each partial."""

    root: str
    ord: str = TOPIC_ORD

    @property
    def order(self) -> list[str]:
        return T.StructType.fromDDL(self.ord).fieldNames()

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def deltas(self) -> str:
        return f"{self.root}/edges_delta"

    def write_delta(self, partial: DataFrame, batch_id: int) -> None:
        replace_partitions(partial.withColumn("batch_id", F.lit(batch_id).cast("bigint")), self.deltas, "batch_id")

    def read_deltas(self, spark: SparkSession) -> DataFrame:
        schema = [*EDGE.fields, T.StructField("ord", T.StructType.fromDDL(self.ord)), T.StructField("batch_id", T.LongType())]
        return read_or_empty(spark, self.deltas, T.StructType(schema))

    def edges(self, spark: SparkSession) -> DataFrame:
        return merge_edges(self.read_deltas(spark).drop("batch_id")).drop("ord")

    def rebase(self, spark: SparkSession, root: str) -> EdgeStore:
        """A new store that starts from this one's fold, so that its batches need not be kept.

        Stop the stream, rebase, and start it with the new store and the old
        checkpoint: its next batch has a number that no batch of the new store has.
        """
        fresh = EdgeStore(root, self.ord)
        fresh.write_delta(merge_edges(self.read_deltas(spark).drop("batch_id")), -1)
        return fresh


# --- folders by key hash


def write_layout(table: DataFrame, key: str, other: str, path: str, buckets: int) -> None:
    """Store a table for lookups by ``key``.

    Files are cut by range of ``(bucket, key, other)``. That pair is unique, so a
    key with very many rows spreads over several tasks and files of its bucket,
    while each task writes only a few neighbouring buckets.
    """
    placed = table.withColumn("bucket", bucket_of(F.col(key), buckets))
    (
        placed.repartitionByRange("bucket", key, other)
        .sortWithinPartitions("bucket", key, other)
        .write.partitionBy("bucket")
        .parquet(path)
    )


def _read_layout(spark: SparkSession, path: str, schema: T.StructType, key: str, other: str, buckets: int) -> Keyed:
    placed = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    return Keyed(spark.read.schema(placed).parquet(path), key, other, buckets)


def write_search_tables(edges: DataFrame, root: str, buckets: int = BUCKETS) -> SearchTables:
    """Lay edges out by each end, build the index from their pages, and open all three.

    Give a stored table: each layout reads its keys once to find the ranges and
    then all columns once to write, and a plan in its place would run each time.
    The bucket count is stored with the layouts; it should follow the table's size,
    not the cluster's.
    """
    spark = edges.sparkSession
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{root}/settings")
    table = edges.select(*EDGE.fieldNames())
    write_layout(table, "resource", "referrer", f"{root}/by_resource", buckets)
    write_layout(table, "referrer", "resource", f"{root}/by_referrer", buckets)
    write_layout(build_index(table), "word", "resource", f"{root}/search_index", buckets)
    return open_search_tables(spark, root)


def open_search_tables(spark: SparkSession, root: str) -> SearchTables:
    """Layouts that :func:`write_search_tables` wrote, in the buckets they were written in."""
    buckets = spark.read.parquet(f"{root}/settings").first()["buckets"]
    return SearchTables(
        _read_layout(spark, f"{root}/by_resource", EDGE, "resource", "referrer", buckets),
        _read_layout(spark, f"{root}/by_referrer", EDGE, "referrer", "resource", buckets),
        _read_layout(spark, f"{root}/search_index", SEARCH_INDEX, "word", "resource", buckets),
    )


# --- tables in Spark's own buckets


def write_bucketed(table: DataFrame, key: str, other: str, name: str, path: str, buckets: int, slices: int) -> None:
    """Store ``table`` as the catalog table ``name`` in buckets by ``(key, slice)``, one sorted file per bucket.

    The slice is a hash of ``other``, so a key's rows lie in up to ``slices`` buckets.
    """
    placed = table.withColumn("slice", F.pmod(F.xxhash64(other), F.lit(slices)).cast("int"))
    (
        placed.repartition(buckets, key, "slice")
        .write.bucketBy(buckets, key, "slice")
        .sortBy(key, "slice", other)
        .option("path", path)
        .saveAsTable(name)
    )


def write_bucketed_tables(
    edges: DataFrame, prefix: str, root: str, buckets: int = BUCKETS, slices: int = SLICES
) -> SearchTables:
    """Bucketed tables ``<prefix>_by_resource``, ``_by_referrer`` and ``_index`` with files below ``root``.

    Lookups of any number against them move the wanted keys only. Choose ``buckets``
    so that one has some hundred megabytes: a bucket is read by one task.
    """
    spark, table = edges.sparkSession, edges.select(*EDGE.fieldNames())
    write_bucketed(table, "resource", "referrer", f"{prefix}_by_resource", f"{root}/by_resource", buckets, slices)
    write_bucketed(table, "referrer", "resource", f"{prefix}_by_referrer", f"{root}/by_referrer", buckets, slices)
    write_bucketed(build_index(table), "word", "resource", f"{prefix}_index", f"{root}/search_index", buckets, slices)
    for name in ("by_resource", "by_referrer", "index"):
        spark.sql(f"ALTER TABLE {prefix}_{name} SET TBLPROPERTIES ('slices' = '{slices}')")
    return open_bucketed_tables(spark, prefix)


def open_bucketed_tables(spark: SparkSession, prefix: str) -> SearchTables:
    """Tables that :func:`write_bucketed_tables` made, found by their names."""

    def opened(name: str, key: str, other: str) -> Bucketed:
        slices = spark.sql(f"SHOW TBLPROPERTIES {prefix}_{name} ('slices')").first()["value"]
        return Bucketed(spark.table(f"{prefix}_{name}"), key, other, slices=int(slices))

    return SearchTables(
        opened("by_resource", "resource", "referrer"), opened("by_referrer", "referrer", "resource"), opened("index", "word", "resource")
    )


# --- single lookups


def write_point_table(table: DataFrame, order: Sequence[str], found_by: Sequence[str], path: str, group_bytes: int = 8 << 20) -> None:
    """Store ``table`` sorted by ``order`` in small row groups, with Bloom filters on the columns ``found_by``.

    A lookup by the first column of the order is answered by the row groups' bounds.
    One by any other column has bounds that say nothing, since its values lie
    everywhere; there the filters tell which row groups cannot hold the value. So one
    copy serves lookups by either end.
    """
    writer = table.repartitionByRange(*order).sortWithinPartitions(*order).write
    writer = writer.option("parquet.block.size", group_bytes)
    for column in found_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def write_point_tables(edges: DataFrame, root: str, group_bytes: int = 8 << 20) -> SearchTables:
    """Edges and index for lookups of one value at a time (:meth:`Keyed.find_one`); edges are stored once."""
    spark, table = edges.sparkSession, edges.select(*EDGE.fieldNames())
    write_point_table(table, ["referrer", "resource"], ["referrer", "resource"], f"{root}/edges", group_bytes)
    write_point_table(build_index(table), ["word", "resource"], ["word"], f"{root}/search_index", group_bytes)
    return SearchTables.of(
        spark.read.schema(EDGE).parquet(f"{root}/edges"), spark.read.schema(SEARCH_INDEX).parquet(f"{root}/search_index")
    )


def create_tables(spark: SparkSession, database: str, folders: dict[str, str]) -> None:
    """Catalog tables over the folders that jobs write, by the contract's table name, for users who work by name."""
    contracts = {
        "referrer_resource": EDGE,
        "search_index": SEARCH_INDEX,
        "dates": LEDGER,
        "resource_destination": RESOURCE_DESTINATION,
        "trending_topics": TRENDING,
    }
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, folder in folders.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contracts[name].fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet LOCATION '{folder}'")
