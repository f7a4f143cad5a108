"""Dashboard totals kept up to date: stored daily partial sums that new slices are added to.

A slice of posts becomes one row per day, platform, topic and label, with counts, an exact decimal
sum of scores, the first and last time, and a sketch of its users. Each slice owns a folder, so
running it again replaces it. Rows of a day may come in any slice. Reading adds the partial rows up,
so that the totals cost as much as there are days and keys, whatever the number of posts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost import rules

KEYS = ("day", "platform", "topic", "sentiment_label")
#: Scores are rounded to four digits, so that a decimal holds them exactly.
SCORE = "decimal(20,4)"


def daily_partials(df: DataFrame, score: str = "sentiment_score", ts: str = "timestamp", user: str = "user") -> DataFrame:
    """One row per ``KEYS``; posts without a time have a null day, a null score adds nothing."""
    return df.groupBy(F.to_date(ts).alias("day"), *KEYS[1:]).agg(
        F.count("*").alias("posts"),
        F.count(score).alias("scored"),
        F.sum(F.col(score).cast(SCORE)).alias("score_sum"),
        F.min(ts).alias("first_post"),
        F.max(ts).alias("last_post"),
        F.hll_sketch_agg(F.coalesce(F.col(user).cast("string"), F.lit(""))).alias("users"),
    )


def merged(parts: DataFrame) -> DataFrame:
    """Partial rows of any number of slices, added up."""
    return parts.groupBy(*KEYS).agg(
        F.sum("posts").alias("posts"), F.sum("scored").alias("scored"), F.sum("score_sum").alias("score_sum"),
        F.min("first_post").alias("first_post"), F.max("last_post").alias("last_post"), F.hll_union_agg("users").alias("users"),
    )


class Rollup:
    """Partial rows in a folder, by slice."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, posts: DataFrame, slice_id: int, **columns) -> None:
        daily_partials(posts, **columns).write.mode("overwrite").parquet(f"{self.path}/slice={slice_id}")

    def rows(self) -> DataFrame:
        return merged(self.spark.read.parquet(self.path).drop("slice"))

    def compacted(self, path: str) -> Rollup:
        """All slices as the first one of another folder; new slices go there."""
        self.rows().write.mode("overwrite").parquet(f"{path}/slice=-1")
        return Rollup(self.spark, path)


def daily_trend(rows: DataFrame) -> DataFrame:
    return rows.groupBy("day", "sentiment_label").agg(F.sum("posts").alias("n"))


def dashboard_kpis(rows: DataFrame) -> DataFrame:
    """One row, as ``summaries.dashboard_kpis`` over the posts."""
    labels = [x.lower() for x in rules.LABELS]
    counts = [
        F.coalesce(F.sum(F.when(F.col("sentiment_label") == x, F.col("posts"))), F.lit(0)).alias(x.lower()) for x in rules.LABELS
    ]
    totals = rows.agg(
        F.coalesce(F.sum("posts"), F.lit(0)).alias("total"), *counts, F.sum("score_sum").alias("_sum"), F.sum("scored").alias("_scored"),
        F.countDistinct("platform").alias("platforms"), F.countDistinct("topic").alias("topics"),
    )
    mean = F.when(F.col("_scored") > 0, F.col("_sum").cast("double") / F.col("_scored")).otherwise(0.0)
    whole = F.greatest("total", F.lit(1))
    percents = [F.floor(100 * F.col(x) / whole).alias(f"{x}_pct") for x in labels]
    ratio = F.round(F.col("positive") / F.greatest("negative", F.lit(1)), 6)
    return totals.select(
        "total", *labels, F.round(mean, 6).alias("avg_score"), "platforms", "topics", *percents, ratio.alias("pos_neg_ratio")
    )


def profile(rows: DataFrame) -> DataFrame:
    """One row: posts, topics, first and last time."""
    return rows.agg(
        F.coalesce(F.sum("posts"), F.lit(0)).alias("rows"), F.countDistinct("topic").alias("topics"),
        F.min("first_post").alias("first_post"), F.max("last_post").alias("last_post"),
    )


def daily_users(rows: DataFrame) -> DataFrame:
    """Estimated number of different users by day, from the merged sketches."""
    return rows.groupBy("day").agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))
