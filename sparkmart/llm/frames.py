"""Small helpers for frames with unknown columns."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column is called so (Spark compares names without case)."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its plain name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def by_size(df: DataFrame, key: str, count: int) -> DataFrame:
    """Deal ``df`` by ``key`` into ``count`` partitions, or the session's number where that is larger."""
    most = max(count, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(most, col(key))


def shared_uri(spark: SparkSession, path: str) -> str:
    """``path`` as a URI that pyarrow's file systems know; without a scheme it lies in the default file system."""
    if ":/" not in path:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        path = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    return path.replace(f"{scheme}:", "s3:", 1) if scheme in ("s3a", "s3n") else path
