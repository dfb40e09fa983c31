"""Structured Streaming: file arrival and continuous incremental load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators.state import StateTable
from sparkmart.queries.registry import query, table
from sparkmart.runtime import scratch_path
from sparkmart.streaming.ingest import ingest_files, landing_stream
from sparkmart.streaming.upsert import IncrementalSink, upsert_stream


def _land(events: DataFrame, folder: str, files: int = 4) -> None:
    """Events as files of a landing folder, by time."""
    events.repartitionByRange(files, "event_id").write.parquet(folder)


@query("stream_file_ingest", "SELECT * REPLACE (value * 2 AS value) FROM events")
def stream_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are picked up in two arrivals; the second run only sees the new ones."""
    events = table(spark, sf_dir, "events")
    landing, target, checkpoint = (scratch_path(spark, x) for x in ("landing", "ingested", "offsets"))
    middle = events.agg(F.expr("max(event_id) div 2")).first()[0]
    for i, part in enumerate((F.col("event_id") <= middle, F.col("event_id") > middle)):
        _land(events.filter(part), f"{landing}/{i}")
        stream = landing_stream(spark, f"{landing}/*", events.schema, files_per_batch=3)
        double = lambda df: df.withColumn("value", F.col("value") * 2)
        ingest_files(stream, target, checkpoint, double).awaitTermination()
    return spark.read.schema(events.schema).parquet(target)


@query("stream_upsert", "SELECT * FROM events")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event arrives twice, in different files; the target holds it once."""
    events = table(spark, sf_dir, "events")
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "offsets")
    _land(events, f"{landing}/0")
    _land(events, f"{landing}/1", files=3)
    state = StateTable(spark, scratch_path(spark, "state"))
    sink = IncrementalSink(spark, scratch_path(spark, "upserted"), events.schema, "event_id", ["user_id"], state)
    stream = landing_stream(spark, f"{landing}/*", events.schema, files_per_batch=2)
    upsert_stream(stream, sink, checkpoint).awaitTermination()
    return sink.rows(spark).drop("batch_id")
