"""Continuous incremental load, exactly once by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkmart.operators.quality import keep_first
from sparkmart.operators.state import StateTable

BATCH = "batch_id"


class IncrementalSink:
    """Appends the rows of each micro-batch whose key the target folder does not hold yet.

    A batch writes its own partition of the target, so a batch repeated after a failure replaces what
    it wrote before. Which batches are done is kept in the state table.
    """

    def __init__(self, spark: SparkSession, target: str, schema: T.StructType, key: str, order_by: Sequence[str],
                 state: StateTable):
        self.target, self.key, self.schema = target, key, schema
        self.order_by, self.state = list(order_by), state
        # an empty partition lets the first batch read the folder
        spark.createDataFrame([], schema).write.mode("ignore").parquet(self.partition(-1))

    def partition(self, batch_id: int) -> str:
        return f"{self.target}/{BATCH}={batch_id}"

    def rows(self, spark: SparkSession) -> DataFrame:
        with_batch = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        return spark.read.schema(with_batch).parquet(self.target)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read twice
        try:
            self._write(batch, batch_id)
        finally:
            batch.unpersist()

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        low, high = batch.agg(F.min(self.key), F.max(self.key)).first()
        if low is None:
            return
        # only the key range of the batch is looked up: other row groups of the target are skipped
        held = (
            self.rows(batch.sparkSession)
            .filter((F.col(BATCH) != batch_id) & F.col(self.key).between(low, high))
            .select(self.key)
        )
        fresh = keep_first(batch, [self.key], self.order_by).join(held, self.key, "left_anti")
        fresh.select(self.schema.names).write.mode("overwrite").parquet(self.partition(batch_id))
        self.state.set("last_batch", batch_id, seq=batch_id)


def upsert_stream(stream: DataFrame, sink: IncrementalSink, checkpoint: str, every: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(sink.write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
