"""Extract and load of many tables from a list."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators.loads import load
from sparkmart.operators.quality import concat_reports
from sparkmart.sources.registry import load_declaration


@dataclass(frozen=True)
class TableSpec:
    """A table to copy: its name, load mode and key; ``columns`` limits what is read."""

    name: str
    ingest_type: str = "full"
    key: str = "id"
    columns: tuple[str, ...] = ()


def specs_from(text: str) -> list[TableSpec]:
    """Specs from a YAML or JSON list of names or of ``{name, ingest_type, key, columns}``."""
    return [
        TableSpec(item) if isinstance(item, str) else TableSpec(**{**item, "columns": tuple(item.get("columns", ()))})
        for item in load_declaration(text)
    ]


def extract_load(spark: SparkSession, specs: Sequence[TableSpec], read: Callable[[str], DataFrame], database: str,
                 parallel: int = 4) -> DataFrame:
    """Load every listed table and report its row count. The loads are independent jobs of one session."""

    def one(spec: TableSpec) -> None:
        source = read(spec.name)
        load(source.select(*spec.columns) if spec.columns else source, f"{database}.{spec.name}", spec.ingest_type, spec.key)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(one, specs))
    counts = [
        spark.table(f"{database}.{s.name}").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(s.name).alias("table_name"), "row_count"
        )
        for s in specs
    ]
    return concat_reports(counts)


def user_step(df: DataFrame, fn: Callable[..., DataFrame], *args, **kwargs) -> DataFrame:
    """Run a user function with parameters as a step of a chain."""
    return df.transform(fn, *args, **kwargs)


def param_query(spark: SparkSession, query: str, defaults: dict, overrides: dict | None = None) -> DataFrame:
    """Run SQL with named parameters; ``overrides`` replaces defaults, unknown names are an error."""
    overrides = overrides or {}
    unknown = set(overrides) - set(defaults)
    if unknown:
        raise KeyError(f"unknown parameters {sorted(unknown)}")
    return spark.sql(query, args={**defaults, **overrides})
