"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


class Tables:
    """The test tables of a folder, read when they are asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def views(self, *names: str) -> None:
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, oracle: str | None = None):
        def register(f: Callable[[Tables], DataFrame]):
            self.queries[name] = lambda spark, folder: f(Tables(spark, folder))
            if oracle:
                self.oracles[name] = oracle
            return f

        return register
