"""Registered queries of the library and their SQL for DuckDB.

A query is a function of Tables, which reads the driver's tables and the views of plans.fixtures by name. Its SQL may use
the same names: the views it needs are put in front of it as common table expressions."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "agg_01_check_report"
MODULES: tuple[str, ...] = ("schema", "projections", "rows", "checks", "suites", "aggregates", "merging", "events", "functions", "pipelines", "storage")
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


class Tables:
    """Tables of a folder and views over them, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        from .plans.fixtures import VIEWS, needs

        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in VIEWS:
                self._made[name] = self.spark.sql(VIEWS[name], **{n: getattr(self, n) for n in needs(name)})
            else:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._made[name]


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of Tables under a name, with the SQL that gives the same rows."""

    def put(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            from .plans.fixtures import with_views

            _SQL[name] = with_views(sql)
        return f

    return put


def _load() -> None:
    for module in MODULES:
        import_module(f"quarrykit.plans.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
