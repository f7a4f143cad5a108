"""Streaming plans. The builders take and return streaming DataFrames and start nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions.labels import classify
from tidepost.functions.lexicon import raw_valence_score
from tidepost.functions.text import excerpt
from tidepost.operators.entities import tag_entities
from tidepost.operators.prepare import keep_where
from tidepost.sources.tables import posts_from_events

# Fixed value: length of an excerpt.
ALERT_EXCERPT = 50


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, schema taken from the table."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_posts(spark: SparkSession, events_dir: str, max_files: int | None = 10_000) -> DataFrame:
    """Posts of a folder of event files as a stream; ``timestamp`` has a zone, as watermarks require."""
    return posts_from_events(stream_table(spark, events_dir, max_files))


def score_live(df: DataFrame, text: str = "text", inclusive: bool = True) -> DataFrame:
    """Raw text scored with capitals counted, on batches and streams; stateless.

    The live view has inclusive thresholds, the comparison of entities strict ones.
    """
    return df.withColumn("sentiment_score", raw_valence_score(F.col(text))).withColumn(
        "sentiment_label", classify(F.col("sentiment_score"), inclusive=inclusive)
    )


def alerts(scored: DataFrame, level: float = rules.ALERT_LEVEL, text: str = "text") -> DataFrame:
    """Posts with extreme scores, with a short excerpt of the text."""
    s = F.col("sentiment_score")
    return keep_where(scored, (s >= level) | (s <= -level)).select(
        "*",
        F.when(s > 0, "High Positive").otherwise("High Negative").alias("alert"),
        excerpt(F.col(text), ALERT_EXCERPT, "...").alias("excerpt"),
    )


def windowed_totals(
    scored: DataFrame, length: str = "1 hour", slide: str | None = None, delay: str = "10 minutes",
    ts: str = "timestamp",
) -> DataFrame:
    """Posts, score sum and labels per time window; rows later than ``delay`` are too late."""
    span = F.window(ts, length, slide) if slide else F.window(ts, length)
    return (
        scored.withWatermark(ts, delay)
        .groupBy(span.alias("w"))
        .agg(
            F.count("*").alias("posts"),
            F.sum("sentiment_score").alias("score_sum"),
            *[F.count_if(F.col("sentiment_label") == x).alias(x.lower()) for x in rules.LABELS],
        )
        .select(F.col("w.start").alias("window_start"), "posts", "score_sum", *[x.lower() for x in rules.LABELS])
    )


def deduplicated(
    df: DataFrame, key: str = "post_id", ts: str = "timestamp", delay: str = "1 hour", salts: int = 16
) -> DataFrame:
    """Repeated deliveries of a post out; state is dropped once the watermark passes it.

    Copies of one post are first thinned out under (id, salt), so that a post delivered
    very often is spread over ``salts`` tasks; the second step alone decides what stays.
    """
    marked = df.withWatermark(ts, delay)
    if salts > 1:
        salted = marked.withColumn("_salt", F.floor(F.rand() * salts).cast("int"))
        marked = salted.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark([key])


def entity_totals(scored: DataFrame, entities) -> DataFrame:
    """Running totals per entity named in the posts."""
    return (
        tag_entities(scored, entities)
        .groupBy("entity")
        .agg(
            F.count("*").alias("volume"),
            F.sum("sentiment_score").alias("score_sum"),
            F.count_if(F.col("sentiment_label") == "Positive").alias("positive"),
        )
    )
