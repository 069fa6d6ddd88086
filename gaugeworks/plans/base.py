"""Registering queries with the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import load, shared_dir

Query = Callable[[SparkSession, str], DataFrame]


class Module:
    """Queries and SQL of one module."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Callable], Callable]:
        """Register a function of a table loader, ``f(t)``: ``t("events")`` is that table, ``t.spark`` the session."""

        def register(f: Callable) -> Callable:
            self.queries[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
            if sql:
                self.oracle[name] = sql
            return f

        return register


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)

    def scratch(self, name: str) -> str:
        """A path in the shared folder, for queries that write and read again."""
        import uuid

        return f"{shared_dir(self.spark)}/gaugeworks/{uuid.uuid4().hex}/{name}"


def rounded(col: Column | str, digits: int = 6) -> Column:
    """Rounded, NaN as null: floats of another order of summation come out the same."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.when(~F.isnan(c), c), digits)


def with_rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: rounded(c) for c in columns})
