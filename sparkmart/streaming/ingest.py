"""File-arrival ingest: new files of a landing folder are loaded once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def landing_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                   files_per_batch: int | None = None, **options: str) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def ingest_files(stream: DataFrame, target: str, checkpoint: str,
                 transform: Callable[[DataFrame], DataFrame] | None = None, every: str | None = None) -> StreamingQuery:
    """Append arriving files to ``target``. Without ``every`` it drains what is there and stops."""
    df = transform(stream) if transform else stream
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(target)
