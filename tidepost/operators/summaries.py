"""Counts, shares, pivots and profiles. All of them are one pass with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepost import rules
from tidepost.functions.labels import floor_percent


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def with_share(counts: DataFrame, n: str = "n", name: str = "share") -> DataFrame:
    """Part of the total, for a table of counts with one row per label (a handful of rows)."""
    return counts.withColumn(name, F.round(F.col(n) / F.sum(n).over(W.partitionBy()), 6))


def sentiment_distribution(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    return with_share(count_by(df, label)).orderBy(F.desc("n"), label)


def daily_trend(df: DataFrame, ts: str = "timestamp", label: str = "sentiment_label") -> DataFrame:
    return count_by(df.select(F.to_date(ts).alias("day"), label), "day", label)


def histogram(
    df: DataFrame, score: str, bins: int = 40, low: float = -1.0, high: float = 1.0, by: tuple = ()
) -> DataFrame:
    """Equal bins over [low, high]; the top edge belongs to the last bin."""
    width = (high - low) / bins
    slot = F.floor((F.col(score) - low) / width).cast("int")
    bounded = F.greatest(F.least(slot, F.lit(bins - 1)), F.lit(0))
    # posts without a score count 0; a test on the count is not pushed below the score
    return (
        df.groupBy(*by, F.when(slot.isNotNull(), bounded).alias("bin"))
        .agg(F.count(score).alias("n"))
        .filter(F.col("n") > 0)
        .withColumn("bin_start", F.round(F.lit(low) + F.col("bin") * width, 6))
    )


def label_pivot(df: DataFrame, by: str = "topic", label: str = "sentiment_label") -> DataFrame:
    """One row per value, one column per label, zero where nothing was found."""
    columns = [F.count_if(F.lower(label) == v.lower()).alias(v.lower()) for v in rules.LABELS]
    return df.groupBy(by).agg(*columns)


def topic_stats(df: DataFrame, topic: str = "topic", score: str = "sentiment_score") -> DataFrame:
    return df.groupBy(topic).agg(
        F.count("*").alias("n"), F.round(F.avg(score), 6).alias("avg_score")
    )


def topic_breakdown(df: DataFrame) -> DataFrame:
    """Posts, mean score and likes per topic, largest first, under display names."""
    return (
        df.groupBy("topic")
        .agg(
            F.count("*").alias("count"),
            F.round(F.avg("sentiment_score"), 6).alias("avg_score"),
            F.sum("likes").alias("total_likes"),
        )
        .withColumnsRenamed(
            {"topic": "Topic", "count": "Posts", "avg_score": "Avg Score", "total_likes": "Total Likes"}
        )
        .orderBy(F.desc("Posts"), "Topic")
    )


def week_grid(spark: SparkSession) -> DataFrame:
    """The 168 hours of a week (a fixed number of rows)."""
    names = F.array(*[F.lit(d) for d in rules.WEEKDAYS])
    slot = F.col("id")
    return spark.range(0, 168, 1, 1).select(
        F.floor(slot / 24).cast("int").alias("day_index"),
        F.get(names, F.floor(slot / 24).cast("int")).alias("day"),
        (slot % 24).cast("int").alias("hour"),
    )


def hour_heatmap(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Posts per weekday and hour, empty hours as 0."""
    seen = count_by(
        df.filter(F.col(ts).isNotNull()).select(
            F.weekday(ts).alias("day_index"), F.hour(ts).alias("hour")
        ),
        "day_index",
        "hour",
    )
    # at most 168 rows on either side
    return (
        week_grid(df.sparkSession)
        .join(F.broadcast(seen), ["day_index", "hour"], "left")
        .select("day_index", "day", "hour", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    )


def hour_heatmap_wide(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    grid = hour_heatmap(df, ts)
    wide = grid.groupBy("day_index", "day").pivot("hour", list(range(24))).agg(F.first("n"))
    return wide.withColumnsRenamed({str(h): f"h{h:02d}" for h in range(24)})


def dashboard_kpis(df: DataFrame) -> DataFrame:
    """Totals of the dashboard in one row.

    Rows are first reduced to one per platform, topic and label. The names of platforms and topics are
    short lists, which that small table gives as sets, so that nothing is multiplied or dealt again.
    """
    small = df.groupBy("platform", "topic", F.lower("sentiment_label").alias("label")).agg(
        F.count("*").alias("n"),
        F.sum("sentiment_score").alias("s"),
        F.count("sentiment_score").alias("scored"),
    )

    def of(label: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("label") == label, F.col("n"))), F.lit(0)).alias(label)

    totals = small.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        of("positive"),
        of("negative"),
        of("neutral"),
        F.coalesce(F.round(F.try_divide(F.sum("s"), F.sum("scored")), 6), F.lit(0.0)).alias("avg_score"),
        F.size(F.collect_set("platform")).cast("bigint").alias("platforms"),
        F.size(F.collect_set("topic")).cast("bigint").alias("topics"),
    )
    total = F.col("total")
    return totals.select(
        "*",
        *[floor_percent(F.col(x), total).alias(f"{x}_pct") for x in ("positive", "negative", "neutral")],
        F.round(F.col("positive") / F.greatest("negative", F.lit(1)), 6).alias("pos_neg_ratio"),
    )


def result_summary(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    return df.agg(
        F.count("*").alias("results"),
        *[F.count_if(F.lower(label) == x.lower()).alias(x.lower()) for x in rules.LABELS],
    )


def live_kpis(df: DataFrame, *by: str) -> DataFrame:
    grouped = df.groupBy(*by) if by else df
    return grouped.agg(
        F.count("*").alias("posts"),
        F.round(F.avg("sentiment_score"), 6).alias("avg_score"),
        *[F.count_if(F.lower("sentiment_label") == x.lower()).alias(x.lower()) for x in rules.LABELS],
    )


def dataset_profile(df: DataFrame, topic: str = "topic", ts: str = "timestamp") -> DataFrame:
    """Rows, distinct topics, first and last time; distinct topics from a per-topic reduction."""
    return (
        df.groupBy(topic)
        .agg(F.count("*").alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(topic).alias("topics"),
            F.min("lo").alias("first_post"),
            F.max("hi").alias("last_post"),
        )
    )


def column_profile(df: DataFrame, sample_length: int = 80) -> DataFrame:
    """Name, type, non-null rows and a sample value of every column, in one pass."""
    facts = df.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(df.columns)],
        *[
            F.min(F.substring(_as_text(f), 1, sample_length)).alias(f"v_{i}")
            for i, f in enumerate(df.schema.fields)
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f"n_{i}").alias("non_null"),
                F.col(f"v_{i}").alias("sample"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return facts.select(F.inline(rows))


def _as_text(field: T.StructField) -> Column:
    plain = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(plain)
    return plain.cast("string")


def long_form(df: DataFrame, ids, values, name: str = "Metric", value: str = "Score") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def engagement_points(df: DataFrame) -> DataFrame:
    return df.select("likes", "shares", "user_followers", "sentiment_label", "platform", "topic")


def engagement_bins(df: DataFrame, likes_width: int = 250, shares_width: int = 100) -> DataFrame:
    """The same picture as counts per cell: bounded, whatever the number of posts."""
    return (
        df.groupBy(
            F.floor(F.col("likes") / likes_width).cast("int").alias("likes_bin"),
            F.floor(F.col("shares") / shares_width).cast("int").alias("shares_bin"),
            "sentiment_label",
        )
        .agg(F.count("*").alias("n"), F.max("user_followers").alias("max_followers"))
    )
