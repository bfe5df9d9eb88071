"""Message topics, with file folders standing in where no broker is at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.parse import strip_line

# Delivery settings of the line publisher.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
    "kafka.buffer.memory": "33554432",
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.compression.type": "gzip",
}

# Columns that order the messages of a topic.
TOPIC_ORDER = ("timestamp", "partition", "offset")


def reader_options(
    servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def _messages(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("value").cast("string").alias("value"), *TOPIC_ORDER)


def stream_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None
) -> DataFrame:
    """Unbounded messages of a topic; needs the Kafka connector on the class path."""
    options = reader_options(servers, topic, starting, max_per_trigger)
    return _messages(spark.readStream.format("kafka").options(**options).load())


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything in a topic as one batch, for backfills."""
    options = reader_options(servers, topic, "earliest")
    return _messages(spark.read.format("kafka").options(**options).load())


def stream_files(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None, format: str = "parquet"
) -> DataFrame:
    """A growing folder as a stream."""
    reader = spark.readStream.format(format).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def encoded_lines(lines: DataFrame) -> DataFrame:
    """Message form of traffic lines: stripped, UTF-8 bytes."""
    return lines.select(F.encode(strip_line(F.col("value")), "UTF-8").alias("value"))


def publish_to_topic(lines: DataFrame, servers: str, topic: str) -> None:
    (
        encoded_lines(lines)
        .write.format("kafka")
        .options(**PRODUCER_OPTIONS)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_to_files(lines: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """The same messages as gzip text files."""
    (
        encoded_lines(lines)
        .select(F.decode(F.col("value"), "UTF-8").alias("value"))
        .write.option("maxRecordsPerFile", rows_per_file)
        .option("compression", "gzip")
        .text(path)
    )
