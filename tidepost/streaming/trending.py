"""Trending phrases of a stream: mergeable heavy-hitter sketches for each time window.

A sketch of a window and a batch keeps the ``size`` most frequent phrases of the batch with their
counts, and ``missed``, the largest count that it left out. Sketches of a window add up: a phrase
has at least the sum of its kept counts, and at most that plus ``missed`` of each sketch that does
not hold it, which over all batches is no more than posts' phrases / (size + 1). Leaders by that upper
bound are counted again in the posts of their window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepost.functions.text import phrases
from tidepost.streaming.sinks import _finish, _start

SKETCH_SIZE = 1000
WINDOW = "1 day"


def windowed_phrases(posts: DataFrame, window: str = WINDOW, text: str = "text", ts: str = "timestamp") -> DataFrame:
    """``window_start, phrase``, one row per occurrence; posts without a time do not take part."""
    start = F.window(ts, window)["start"].alias("window_start")
    return posts.where(F.col(ts).isNotNull()).select(start, F.explode(phrases(F.col(text))).alias("phrase"))


def sketch(found: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """``window_start, phrase, n, missed`` of one batch.

    Counts are folded in the map tasks; ``rank <= size + 1`` is cut there too, so that no window's
    phrases meet in one task.
    """
    counts = found.groupBy("window_start", "phrase").agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy("window_start").orderBy(F.desc("n"), "phrase"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= size + 1)
    missed = F.max(F.when(F.col("rank") > size, F.col("n"))).over(W.partitionBy("window_start"))
    return top.withColumn("missed", F.coalesce(missed, F.lit(0))).where(F.col("rank") <= size).drop("rank")


def merged(sketches: DataFrame) -> DataFrame:
    """``window_start, phrase, low, high``: bounds of the count of each phrase that any sketch
    (``batch``) of its window holds, and ``unseen``, the most that any other phrase can have."""
    batches = sketches.groupBy("window_start", "batch").agg(F.max("missed").alias("missed"))
    windows = batches.groupBy("window_start").agg(F.sum("missed").alias("unseen"))
    kept = sketches.groupBy("window_start", "phrase").agg(F.sum("n").alias("low"), F.sum("missed").alias("held"))
    both = kept.join(windows, "window_start")
    return both.select("window_start", "phrase", "low", (F.col("low") + F.col("unseen") - F.col("held")).alias("high"), "unseen")


def candidates(bounds: DataFrame, n: int) -> DataFrame:
    """Phrases that may be among the ``n`` most frequent of their window: those whose upper bound
    reaches the ``n``-th lower bound. ``certain`` tells that no phrase outside the sketches can."""
    rank = F.row_number().over(W.partitionBy("window_start").orderBy(F.desc("low"), "phrase"))
    top = bounds.withColumn("rank", rank).where(F.col("rank") <= n)
    least = top.groupBy("window_start").agg(F.when(F.count("*") == n, F.min("low")).otherwise(0).alias("least"))
    rows = bounds.join(least, "window_start").where(F.col("high") >= F.col("least"))
    return rows.withColumn("certain", (F.col("unseen") == 0) | (F.col("unseen") < F.col("least"))).drop("least", "unseen")


def leaders(posts: DataFrame, chosen: DataFrame, n: int, window: str = WINDOW, text: str = "text", ts: str = "timestamp") -> DataFrame:
    """``window_start, rank, phrase, tag, n, certain``: the candidates counted again in their posts."""
    found = windowed_phrases(posts, window, text, ts).groupBy("window_start", "phrase").agg(F.count("*").alias("n"))
    counted = found.join(chosen.select("window_start", "phrase", "certain"), ["window_start", "phrase"])
    rank = F.row_number().over(W.partitionBy("window_start").orderBy(F.desc("n"), "phrase"))
    tag = F.concat(F.lit("#"), F.replace("phrase", F.lit(" "), F.lit("")))
    top = counted.withColumn("rank", rank).where(F.col("rank") <= n)
    return top.select("window_start", "rank", "phrase", tag.alias("tag"), "n", "certain")


class TrendingPhrases:
    """Writes the sketch of each batch under its id, so that a repeated batch replaces itself."""

    def __init__(self, path: str, size: int = SKETCH_SIZE, window: str = WINDOW, text: str = "text", ts: str = "timestamp"):
        self.path, self.size, self.window, self.text, self.ts = path, size, window, text, ts

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        found = windowed_phrases(batch, self.window, self.text, self.ts)
        sketch(found, self.size).write.mode("overwrite").parquet(f"{self.path}/sketches/batch={batch_id}")

    def run_available(self, df: DataFrame, seconds: int | None = None) -> None:
        writer = df.writeStream.outputMode("append").foreachBatch(self)
        _finish(_start(writer, df.sparkSession, f"{self.path}/checkpoint", None), seconds)

    def bounds(self, spark: SparkSession) -> DataFrame:
        return merged(spark.read.parquet(f"{self.path}/sketches"))
