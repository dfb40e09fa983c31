"""Relational databases through Spark's JDBC source."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession


@dataclass(frozen=True)
class Connection:
    """Where a database is; ``properties`` holds user, password and driver class."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class KeyRange:
    """Splits a scan into ``partitions`` ranges of a numeric, date or timestamp column."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def jdbc_options(connection: Connection, relation: str, fetch_size: int, split: KeyRange | None) -> dict[str, str]:
    """Options of a streamed read. ``relation`` is a table name or a SELECT statement."""
    is_query = relation.lstrip().lower().startswith(("select", "with"))
    # a partitioned read needs dbtable, so a query becomes a derived table
    target = {"dbtable": f"({relation}) q" if is_query else relation}
    return {
        "url": connection.url,
        **connection.properties,
        **target,
        "fetchsize": str(fetch_size),
        **(split.options() if split else {}),
    }


def jdbc_reader(
    spark: SparkSession, connection: Connection, relation: str, fetch_size: int = 10_000, split: KeyRange | None = None
) -> DataFrameReader:
    return spark.read.format("jdbc").options(**jdbc_options(connection, relation, fetch_size, split))


def read_jdbc(
    spark: SparkSession, connections: dict[str, Connection], conn_id: str, relation: str,
    fetch_size: int = 10_000, split: KeyRange | None = None,
) -> DataFrame:
    """Scan a table or query of the connection named ``conn_id``.

    Rows are fetched in batches; with ``split`` the scan runs as that many parallel range queries,
    without it the whole result comes through one task.
    """
    return jdbc_reader(spark, connections[conn_id], relation, fetch_size, split).load()
