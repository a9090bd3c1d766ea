"""A small registry: a query function and the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Register:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None, lists: tuple[str, ...] = ()) -> Callable[[Query], Query]:
        """``lists`` names array columns that come out as text joined by commas on both
        sides, so that they compare as plain values."""

        def add(f: Query) -> Query:
            def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
                df = f(spark, sf_dir)
                return df.withColumns({c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in lists}) if lists else df

            self.queries[f.__name__] = shown
            if sql:
                text = ", ".join(f"coalesce(array_to_string({c}, ','), '') as {c}" for c in lists)
                self.sql[f.__name__] = f"select * replace ({text}) from ({sql})" if lists else sql
            return f

        return add
