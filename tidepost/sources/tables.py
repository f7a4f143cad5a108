"""Given parquet tables, and posts derived from ``events`` row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost import rules

# Own sentences. ``{topic}`` is replaced; links, mentions, tags, emoji, negation, degree words
# and contrast are there on purpose.
SENTENCES = {
    "up": (
        "Really excited about {topic}, GREAT progress this week! https://news.example.org/a?b=1",
        "@maria_9 the new {topic} report is excellent and very helpful 🚀",
        "I love what people build for #{topic}!! So proud of this team",
        "Not bad at all, {topic} is slightly better than last month",
        "The start was slow but {topic} is now a wonderful success",
    ),
    "down": (
        "The {topic} plan is terrible and a waste of money, see www.example.com/plan today",
        "@dev.lee this {topic} update is not good, really disappointing 😤",
        "Very bad week for #{topic}: another crash, awful support!!!",
        "I hate how {topic} was mishandled. Worst call so far",
        "It looked promising but {topic} is completely broken and useless",
    ),
    "flat": (
        "Reading an article about {topic} on the train",
        "What is the latest on {topic}? @anna asks",
        "Summary of #{topic} numbers for this month: https://example.org/sum",
        "{topic} meeting moved to Tuesday, same room as before",
        "New report on {topic} is out. Thoughts?",
    ),
}

TARGET_OF_EVENT = {"purchase": 4, "signup": 4, "error": 0}
MOOD_OF_EVENT = {"purchase": "up", "signup": "up", "error": "down"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as it is stored: filters and column pruning reach the scan, and nothing is dealt
    out anew."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values, index: Column) -> Column:
    """The value at ``index`` modulo the number of values."""
    listed = F.array(*[F.lit(v) for v in values])
    return F.get(listed, F.pmod(index, F.lit(len(values))).cast("int"))


def posts_from_events(events: DataFrame) -> DataFrame:
    """Posts in raw form (text, dataset code, engagement), one per event, no shuffle."""
    mood = F
    target = F
    for name, kind in MOOD_OF_EVENT.items():
        mood = mood.when(F.col("event_type") == name, pick(SENTENCES[kind], F.col("event_id")))
        target = target.when(F.col("event_type") == name, F.lit(TARGET_OF_EVENT[name]))
    sentence = mood.otherwise(pick(SENTENCES["flat"], F.col("event_id")))
    topic = pick(rules.DEMO_TOPICS, F.col("event_id"))
    return events.select(
        F.col("event_id").alias("post_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"),
        pick(rules.PLATFORMS, F.col("user_id")).alias("platform"),
        topic.alias("topic_seed"),
        F.replace(sentence, F.lit("{topic}"), topic).alias("text"),
        target.otherwise(F.lit(2)).alias("target"),
        engagement(F.col("event_id"), F.col("user_id")).alias("engagement"),
        F.col("value"),
    ).select("*", "engagement.*").drop("engagement")


def engagement(row_id: Column, user_id: Column) -> Column:
    """Likes, shares and followers as plain arithmetic on ids: same input, same result."""
    row_id, user_id = row_id.cast("bigint"), user_id.cast("bigint")
    return F.struct(
        F.pmod(row_id * 37, F.lit(5000)).alias("likes"),
        F.pmod(row_id * 17, F.lit(2000)).alias("shares"),
        (F.lit(50) + F.pmod(user_id * 7919, F.lit(499950))).alias("user_followers"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_from_events(table(spark, sf_dir, "events"))
