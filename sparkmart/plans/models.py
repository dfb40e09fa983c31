"""SQL-style models as Python functions: dependencies, materialisation, column tests."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators.loads import create_as
from sparkmart.operators.quality import concat_reports, violations_not_null, violations_unique


@dataclass(frozen=True)
class Model:
    """A named query over sources and other models.

    ``build`` receives its inputs in the order of ``refs`` (models) followed by ``sources``.
    """

    name: str
    build: Callable[..., DataFrame]
    refs: tuple[str, ...] = ()
    sources: tuple[str, ...] = ()
    materialized: str | None = None
    folder: str | None = None
    tests: tuple[tuple[str, str], ...] = ()


@dataclass
class Project:
    """A set of models with default materialisations per folder."""

    models: dict[str, Model] = field(default_factory=dict)
    folder_defaults: dict[str, str] = field(default_factory=dict)
    default: str = "view"

    def add(self, model: Model) -> None:
        if model.name in self.models:
            raise ValueError(f"model {model.name!r} is declared twice")
        self.models[model.name] = model

    def materialization(self, name: str) -> str:
        """The model's own setting, else its folder's, else the project default."""
        model = self.models[name]
        chosen = model.materialized or self.folder_defaults.get(model.folder or "") or self.default
        if chosen not in ("table", "view"):
            raise ValueError(f"unknown materialization {chosen!r} of model {name!r}")
        return chosen

    def order(self, select: Sequence[str] | None = None) -> list[str]:
        """Build order of the selected models and everything they depend on."""
        wanted: set[str] = set()
        open_names = list(select) if select is not None else list(self.models)
        while open_names:
            name = open_names.pop()
            if name not in wanted:
                wanted.add(name)
                open_names.extend(self.models[name].refs)
        graph = {n: self.models[n].refs for n in self.models if n in wanted}
        return [n for n in TopologicalSorter(graph).static_order() if n in wanted]

    def plan(self, sources: dict[str, DataFrame], select: Sequence[str] | None = None) -> dict[str, DataFrame]:
        """All selected models as one lazy plan, nothing is written."""
        built: dict[str, DataFrame] = {}
        for name in self.order(select):
            model = self.models[name]
            built[name] = model.build(*[built[r] for r in model.refs], *[sources[s] for s in model.sources])
        return built

    def run(self, spark: SparkSession, sources: dict[str, DataFrame], database: str,
            select: Sequence[str] | None = None) -> dict[str, DataFrame]:
        """Write ``table`` models into ``database`` and register ``view`` models; later models read those."""
        built: dict[str, DataFrame] = {}
        for name in self.order(select):
            model = self.models[name]
            df = model.build(*[built[r] for r in model.refs], *[sources[s] for s in model.sources])
            if self.materialization(name) == "table":
                create_as(df, f"{database}.{name}")
                built[name] = spark.table(f"{database}.{name}")
            else:
                df.createOrReplaceTempView(name)
                built[name] = df
        return built

    def test(self, built: dict[str, DataFrame]) -> DataFrame:
        """(model, column, test, violations) of every declared column test."""
        lines = [run_test(built[n], n, c, t) for n in built for c, t in self.models[n].tests]
        return concat_reports(lines)


TESTS: dict[str, Callable[[DataFrame, str], DataFrame]] = {
    "unique": violations_unique,
    "not_null": violations_not_null,
}


def run_test(df: DataFrame, model: str, column: str, test: str) -> DataFrame:
    return TESTS[test](df, column).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"), "violations"
    )
