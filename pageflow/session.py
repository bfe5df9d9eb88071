"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}
_pinned: list[str] = []


def local_session(app: str = "pageflow", cpus: str | int = "*", shuffle: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, where driver and tasks share one disk, may fall back to
    a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="pageflow-")
    return _local_root[app]


def work_path(spark: SparkSession, label: str) -> str:
    """A path below the working folder that nothing else uses."""
    return f"{work_root(spark)}/pageflow/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table that outlives lost executors, and fixes values
    that must not change between two uses of the same plan. :func:`dropping_pins`
    deletes what a piece of work has written, but for tables to ``keep``.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    if not keep:
        _pinned.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def dropping_pins(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, every table that :func:`pin` has written in it and was not told to keep.

    Results are lazy, so write, collect or keep them inside the block.
    """
    first = len(_pinned)
    try:
        yield
    finally:
        for path in _pinned[first:]:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        del _pinned[first:]


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer tasks than the cluster has cores one task per core.

    For small or coarse files ahead of heavy per-row work. A table large enough
    to fill the cluster is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
