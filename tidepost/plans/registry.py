"""Where queries are registered: key -> (function of the given tables, check SQL)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost.functions import text as tx
from tidepost.operators import prepare
from tidepost.plans import sql as q
from tidepost.sources import tables


@dataclass
class Given:
    """The given tables and the posts derived from them; everything is lazy."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.sf_dir, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @cached_property
    def posts(self) -> DataFrame:
        return tables.posts_from_events(self.events)

    @cached_property
    def prepared(self) -> DataFrame:
        """Dataset labels."""
        return prepare.prepare_posts(self.posts)

    @cached_property
    def scored(self) -> DataFrame:
        """Labels of the valence engine."""
        return prepare.score_sentiment(self.prepared)

    @cached_property
    def docs(self) -> DataFrame:
        return self.documents.withColumn("clean_text", tx.clean_text(F.col("text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(given) -> DataFrame`` under ``name``, with the SQL it has to agree with."""

    def register(fn: Callable[[Given], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Given(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = q.query(sql)
        return fn

    return register


def second(ts: str = "timestamp"):
    """Time as text, to the second: independent of zone and unit."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias(ts)


SECOND_SQL = "strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS \"timestamp\""
