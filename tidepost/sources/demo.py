"""Demo posts generated on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.sources.tables import SENTENCES, pick

# Cumulated label shares, and the score range of each label.
POSITIVE_SHARE, NEGATIVE_SHARE = 0.4, 0.3
SCORE_RANGE = {"positive": (0.1, 1.0), "negative": (-1.0, -0.1), "neutral": (-0.1, 0.1)}
MAX_LIKES, MAX_SHARES = 5000, 2000
MIN_FOLLOWERS, MAX_FOLLOWERS = 50, 500_000
DAYS = 30


def demo_posts(
    spark: SparkSession, n: int = 500, seed: int = 42, start: str = "2024-01-01", partitions: int | None = None
) -> DataFrame:
    """``n`` posts over thirty days, ordered by time; the same seed gives the same mix."""
    ids = spark.range(n) if partitions is None else spark.range(0, n, 1, partitions)

    def whole(low: int, high: int, salt: int):
        return (F.lit(low) + F.floor(F.rand(seed + salt) * (high - low + 1))).cast("bigint")

    drawn = ids.select(
        F.col("id"),
        F.rand(seed).alias("mood"),
        F.rand(seed + 1).alias("level"),
        whole(0, len(rules.DEMO_TOPICS) - 1, 2).alias("t"),
        whole(0, len(rules.PLATFORMS) - 1, 3).alias("p"),
        whole(0, 10_000, 4).alias("s"),
        whole(0, DAYS * 24 * 60 + 24 * 60 - 1, 5).alias("minute"),
        whole(0, MAX_LIKES, 6).alias("likes"),
        whole(0, MAX_SHARES, 7).alias("shares"),
        whole(MIN_FOLLOWERS, MAX_FOLLOWERS, 8).alias("user_followers"),
    )
    labelled = drawn.withColumn(
        "sentiment_label",
        F.when(F.col("mood") < POSITIVE_SHARE, "positive")
        .when(F.col("mood") < POSITIVE_SHARE + NEGATIVE_SHARE, "negative")
        .otherwise("neutral"),
    ).withColumn("topic", pick(rules.DEMO_TOPICS, F.col("t")))

    score, sentence = F, F
    for (label, (low, high)), kind in zip(SCORE_RANGE.items(), ("up", "down", "flat")):
        is_label = F.col("sentiment_label") == label
        score = score.when(is_label, F.round(low + F.col("level") * (high - low), 3))
        sentence = sentence.when(is_label, pick(SENTENCES[kind], F.col("s")))
    return labelled.select(
        (F.to_timestamp(F.lit(start)) + F.make_interval(mins=F.col("minute").cast("int"))).alias("timestamp"),
        pick(rules.PLATFORMS, F.col("p")).alias("platform"),
        "topic",
        F.replace(sentence, F.lit("{topic}"), F.col("topic")).alias("text"),
        "sentiment_label",
        score.alias("sentiment_score"),
        "likes",
        "shares",
        "user_followers",
    ).orderBy("timestamp")
