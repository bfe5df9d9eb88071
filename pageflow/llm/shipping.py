"""Send this package to the Python workers, which need not have it installed."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

_shipped: set[str] = set()

#: A batch ends at 10,000 rows by default, however long their texts are; a task holds several on both sides of the pipe.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Hand the package to Spark once per application; executors fetch it from Spark, not from a folder."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / "package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "pageflow").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def _give_back() -> None:
    """Return freed memory: workers are used again and would hold it through the stages after this one."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def bound_batches(spark: SparkSession) -> None:
    """Have Arrow batches end at ``BATCH_BYTES`` too, unless the session has a limit of its own. No row is cut."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def map_arrow(df: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        _give_back()

    ship(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)
