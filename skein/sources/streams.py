"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

def stream_lines(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None) -> DataFrame:
    """New text files of a folder, one row per line in column ``value``."""
    return _limited(spark, max_files_per_trigger, max_bytes_per_trigger).text(folder)


def stream_table(spark: SparkSession, folder: str, schema: StructType | str, glob: str = "*.parquet",
                 max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder."""
    reader = _limited(spark, max_files_per_trigger, max_bytes_per_trigger)
    return reader.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket. For trials only: nothing can be replayed after a failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def stream_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Topic values as text with arrival time. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return with_arrival_time(reader.load().select(F.col("value").cast("string")))


def with_arrival_time(stream: DataFrame, name: str = "event_time") -> DataFrame:
    """Add the processing time of the micro-batch."""
    return stream.withColumn(name, F.current_timestamp())


def _limited(spark: SparkSession, files: int | None, size: int | None):
    """Reader whose batches are bounded by a number of files or by bytes where one is given (the source takes one)."""
    if files:
        return spark.readStream.option("maxFilesPerTrigger", files)
    return spark.readStream.option("maxBytesPerTrigger", size) if size else spark.readStream
