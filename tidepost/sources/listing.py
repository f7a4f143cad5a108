"""Nested JSON listings of live posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepost.functions.text import joined_text

# Payload layout and the site that permalinks belong to.
CHILD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("selftext", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("permalink", T.StringType()),
        T.StructField("subreddit", T.StringType()),
    ]
)
LISTING_SCHEMA = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "children",
                        T.ArrayType(T.StructType([T.StructField("data", CHILD)])),
                    )
                ]
            ),
        )
    ]
)
SITE = "https://www.reddit.com"


def read_listing(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(LISTING_SCHEMA).option("multiLine", multi_line).json(path)


def stream_listing(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(LISTING_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )


def flatten_listing(df: DataFrame) -> DataFrame:
    """One row per child with text, in no order; works on batch and streaming frames alike.
    :func:`newest` puts the newest first."""
    child = df.select(F.explode("data.children").alias("c")).select("c.data.*")
    created = F.coalesce(F.col("created_utc"), F.lit(0.0))
    return child.select(
        "id",
        joined_text(F.col("title"), F.col("selftext")).alias("text"),
        "author",
        created.alias("created_utc"),
        F.timestamp_seconds(created).alias("timestamp"),
        F.concat(F.lit(SITE), F.col("permalink")).alias("url"),
        "subreddit",
    ).filter(F.col("text") != "")


def newest(df: DataFrame, n: int, ts="timestamp", key="id") -> DataFrame:
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(key)).limit(n)


def matches(text: Column, query: str, literal: bool = False) -> Column:
    """Case-insensitive search; null text does not match."""
    hit = F.contains(F.lower(text), F.lit(query.lower())) if literal else text.rlike(f"(?i){query}")
    return F.coalesce(hit, F.lit(False))


def search_newest(
    df: DataFrame, query: str, n: int = 30, text="text", ts="timestamp", key="id", literal=True
) -> DataFrame:
    return newest(df.filter(matches(F.col(text), query, literal)), n, ts, key)
