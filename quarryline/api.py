"""Session facade: table views, SQL text, named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarryline.plans import registry
from quarryline.plans.base import TABLES, Tables


class Engine:
    """A folder of tables under one session.

    >>> engine = Engine(spark, "/data/sf1")
    >>> engine.sql("select lang, count(*) from documents group by lang")
    >>> engine.named("q14_idf")
    """

    def __init__(self, spark: SparkSession, folder: str, tables: list[str] | None = None) -> None:
        self.spark, self.folder = spark, folder
        Tables(spark, folder).views(*(tables or TABLES))

    def sql(self, text: str, **parameters) -> DataFrame:
        """Read-only SQL over the views; parameters are bound by name (``:name``)."""
        if text.lstrip().split(None, 1)[0].lower() not in ("select", "with", "values", "from", "describe", "explain", "show"):
            raise ValueError("only queries are allowed")
        return self.spark.sql(text, args=parameters or None)

    def names(self) -> list[str]:
        return sorted(registry.queries())

    def named(self, name: str) -> DataFrame:
        return registry.queries()[name](self.spark, self.folder)
