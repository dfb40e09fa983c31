"""Persisted job state: named JSON values where the last write wins, and versions of which each is written once."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "key string, value string, updated_at timestamp, seq long"


def latest_state(log: DataFrame, order: tuple[str, ...] = ("updated_at", "seq")) -> DataFrame:
    """The current value of every key of a write log."""
    last = F.max_by(F.struct("value", "updated_at"), F.struct(*order)).alias("last")
    return log.groupBy("key").agg(last).select("key", "last.value", "last.updated_at")


class StateTable:
    """Small table of (key, JSON value); each write appends a row, reads take the last one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], _SCHEMA).write.mode("ignore").parquet(path)

    def log(self) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).parquet(self.path)

    def set(self, key: str, value: object, seq: int = 0) -> None:
        now = datetime.now(timezone.utc)
        row = self.spark.createDataFrame([(key, json.dumps(value), now, seq)], _SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)

    def set_all(self, rows: DataFrame) -> None:
        """Append many writes at once; ``rows`` has key, value (JSON text), updated_at and seq."""
        rows.select("key", "value", F.col("updated_at").cast("timestamp").alias("updated_at"), "seq").write.mode(
            "append"
        ).parquet(self.path)

    def get(self, key: str, default: object = None) -> object:
        row = latest_state(self.log().filter(F.col("key") == key)).first()
        return default if row is None else json.loads(row["value"])

    def current(self) -> DataFrame:
        return latest_state(self.log())


class VersionTaken(RuntimeError):
    """Another writer has written this version first."""


class CommitLog:
    """Numbered versions of a JSON value, one small file each, created only if it is absent.

    The file system lets one of several writers create a file, so a version is the commit point of whoever made it:
    read the latest, prepare what follows from it, and commit the next number. A writer that ended between creating and
    filling its file leaves a number without a value, which readers pass over.
    """

    def __init__(self, spark: SparkSession, folder: str):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path(folder)
        self._child = lambda name: jvm.org.apache.hadoop.fs.Path(self._path, name)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._utf8 = jvm.java.nio.charset.StandardCharsets.UTF_8
        self._text = jvm.org.apache.commons.io.IOUtils.toString

    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._path):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def latest(self, default: object = None) -> tuple[int, object]:
        """The highest number given out, and the value of the last version that has one."""
        numbers = self._numbers()
        for number in reversed(numbers):
            stream = self._fs.open(self._child(f"{number:020d}.json"))
            try:
                text = self._text(stream, self._utf8)
            finally:
                stream.close()
            if text.endswith("\n"):
                return numbers[-1], json.loads(text)
        return (numbers[-1] if numbers else 0), default

    def commit(self, number: int, value: object) -> None:
        """Write version ``number``; VersionTaken if it exists."""
        at = self._child(f"{number:020d}.json")
        try:
            stream = self._fs.create(at, False)
        except Py4JJavaError as error:
            if self._fs.exists(at):
                raise VersionTaken(f"version {number} has been written meanwhile") from error
            raise
        stream.write(bytearray((json.dumps(value) + "\n").encode()))
        stream.close()

    def forget(self, before: int) -> None:
        """Remove the versions below ``before``, which must have a value or a later one."""
        for number in self._numbers():
            if number < before:
                self._fs.delete(self._child(f"{number:020d}.json"), False)
