"""Comparison of entities (brands, topics) by the posts that name them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.operators.summaries import histogram
from tidepost.sources.listing import matches

# Posts per entity in a comparison, and the name of an undecided one.
LATEST = 50
TIE = "It's a Tie"


def tag_entities(df: DataFrame, entities, text: str = "text", literal: bool = True) -> DataFrame:
    """One row per post and entity found in it, from a single scan. Tag before scoring, so that
    only posts that name an entity are scored."""
    found = F.array_compact(
        F.array(*[F.when(matches(F.col(text), e, literal), F.lit(e)) for e in entities])
    )
    return df.withColumn("entity", F.explode(found))


def latest_per_entity(tagged: DataFrame, n: int = LATEST, ts: str = "timestamp", key: str = "post_id") -> DataFrame:
    """Newest n posts of each entity; cut per map task before the shuffle."""
    w = W.partitionBy("entity").orderBy(F.col(ts).desc_nulls_last(), F.col(key))
    return tagged.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def union_entities(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables of several entities below each other, each row tagged."""
    out = None
    for name, df in tables.items():
        part = df.withColumn("entity", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def entity_compare(tagged: DataFrame, entities) -> DataFrame:
    """Mean score, positive posts, volume and positive percent; entities without posts stay."""
    spark = tagged.sparkSession
    listed = spark.createDataFrame([(e,) for e in entities], "entity string")
    stats = tagged.groupBy("entity").agg(
        F.count("*").alias("volume"),
        F.round(F.avg("sentiment_score"), 6).alias("avg_score"),
        F.count_if(F.lower("sentiment_label") == "positive").alias("positive"),
    )
    volume = F.coalesce("volume", F.lit(0))
    positive = F.coalesce("positive", F.lit(0))
    # one row per named entity on both sides
    return listed.join(F.broadcast(stats), "entity", "left").select(
        "entity",
        volume.alias("volume"),
        F.coalesce("avg_score", F.lit(0.0)).alias("avg_score"),
        positive.alias("positive"),
        F.round(F.when(volume > 0, 100.0 * positive / volume).otherwise(0.0), 4).alias("positive_pct"),
    )


def entity_winner(compared: DataFrame, a: str, b: str, margin: float = rules.WIN_MARGIN) -> DataFrame:
    """One row: both scores and who is ahead by more than the margin."""
    scores = compared.agg(
        F.coalesce(F.max(F.when(F.col("entity") == a, F.col("avg_score"))), F.lit(0.0)).alias("score_a"),
        F.coalesce(F.max(F.when(F.col("entity") == b, F.col("avg_score"))), F.lit(0.0)).alias("score_b"),
        F.coalesce(F.sum("volume"), F.lit(0)).alias("posts"),
    )
    return scores.withColumn(
        "winner",
        F.when(F.col("score_a") > F.col("score_b") + margin, F.lit(a))
        .when(F.col("score_b") > F.col("score_a") + margin, F.lit(b))
        .otherwise(F.lit(TIE)),
    )


def entity_histogram(tagged: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(tagged, "sentiment_score", bins, by=("entity",))
