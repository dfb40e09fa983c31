"""Declared sources: a logical name for a group of physical tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

try:
    import yaml
except ImportError:  # the registry also takes plain dictionaries
    yaml = None


def load_declaration(text: str) -> dict:
    """Parse a YAML (or JSON, its subset) declaration."""
    if yaml is None:
        raise RuntimeError("reading YAML needs the yaml package; pass a dictionary instead")
    return yaml.safe_load(text)


def table_names(declaration: dict) -> dict[str, list[str]]:
    """source name -> its table names, from ``{sources: [{name, tables: [{name}]}]}``."""
    return {
        source["name"]: [t["name"] if isinstance(t, dict) else t for t in source["tables"]]
        for source in declaration["sources"]
    }


def table_set(spark: SparkSession, database: str, only: Sequence[str] | None = None,
              renames: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The tables of a database by name, limited to ``only`` and renamed by old -> new, as table sets are compared."""
    renames = renames or {}
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return {
        renames.get(n, n): spark.table(f"{database}.{n}") for n in sorted(names) if only is None or n in only
    }


def register_sources(spark: SparkSession, declaration: dict, locations: dict[str, str]) -> dict[tuple[str, str], DataFrame]:
    """Bind every declared table to its parquet folder and expose it as the view ``source__table``."""
    bound = {}
    for source, tables in table_names(declaration).items():
        for table in tables:
            df = spark.read.parquet(locations[table])
            df.createOrReplaceTempView(f"{source}__{table}")
            bound[(source, table)] = df
    return bound
