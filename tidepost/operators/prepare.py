"""From raw posts to prepared and scored posts. Every step is a projection: no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepost import rules
from tidepost.functions import labels, lexicon, text as tx, times
from tidepost.functions.binding import bind
from tidepost.sources.tables import engagement

# Layout of prepared posts.
PREPARED_COLUMNS = (
    "timestamp", "platform", "topic", "text", "clean_text", "tokens", "word_count",
    "sentiment_label", "sentiment_score", "likes", "shares", "user_followers", "user",
)

ENGINES = ("dataset", "valence", "polarity")


def drop_blank_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(~tx.is_blank(F.col(text)))


def drop_null_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.dropna(subset=[text])


def prepare_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Null texts out; ``clean_text`` and ``tokens`` added."""
    return (
        drop_null_text(df, text)
        .withColumn("clean_text", tx.clean_text(F.col(text)))
        .withColumn("tokens", tx.tokens(F.col("clean_text")))
    )


def prepare_posts(df: DataFrame, platform: str | None = "Twitter", whole_word: bool = False) -> DataFrame:
    """Raw posts to the prepared layout, ids kept where there are any.

    Input has ``text`` and ``target`` and either ``timestamp`` or a ``date`` string. What is
    missing of platform and engagement is added (constant, arithmetic on the id).
    """
    key = "post_id" if "post_id" in df.columns else "ids"
    out = drop_blank_text(df)
    if "timestamp" not in df.columns:
        out = out.withColumn("timestamp", times.post_timestamp(F.col("date")))
    if "platform" not in df.columns:
        out = out.withColumn("platform", F.lit(platform))
    if "likes" not in df.columns:
        out = out.withColumn("_e", engagement(F.col(key), F.col(key))).select("*", "_e.*").drop("_e")
    out = (
        out.withColumn("sentiment_label", labels.target_label(F.col("target")))
        .withColumn("sentiment_score", labels.target_score(F.col("target")))
        .withColumn("clean_text", tx.clean_text(F.col("text")))
        .withColumn("tokens", tx.tokens(F.col("clean_text")))
        .withColumn("word_count", F.size("tokens"))
        .withColumn("topic", tx.topic_of(F.col("clean_text"), whole_word=whole_word))
    )
    extra = [c for c in ("value",) if c in df.columns]
    return out.select(F.col(key).alias("post_id"), *PREPARED_COLUMNS, *extra)


def score_sentiment(df: DataFrame, text: str = "clean_text", engine: str = "valence") -> DataFrame:
    """Replace score and label by those of a lexicon engine."""
    score = {"valence": lexicon.valence_score, "polarity": lexicon.polarity_score}[engine](F.col(text))
    return df.withColumn("sentiment_score", score).withColumn(
        "sentiment_label", labels.classify(F.col("sentiment_score"))
    )


def run_pipeline(raw: DataFrame, engine: str = "dataset", limit: int | None = None) -> DataFrame:
    """Load limit, preparation and the chosen engine in one lazy plan."""
    if engine not in ENGINES:
        raise ValueError(f"engine is one of {ENGINES}, not {engine!r}")
    prepared = prepare_posts(raw.limit(limit) if limit else raw)
    return prepared if engine == "dataset" else score_sentiment(prepared, engine=engine)


def score_with(df: DataFrame, scorer: Callable, text: str = "text", score: str = "sentiment_score") -> DataFrame:
    """Hook for a third-party scorer: ``scorer(pandas.Series of texts) -> scores``.

    Runs over Arrow batches inside the tasks; nothing is grouped or moved.
    """
    schema = T.StructType(
        [f for f in df.schema.fields if f.name != score] + [T.StructField(score, T.DoubleType())]
    )
    names = schema.fieldNames()

    def run(batches):
        for batch in batches:
            yield batch.assign(**{score: scorer(batch[text])})[names]

    return df.mapInPandas(run, schema)


def engine_row(valence: Column, polarity: Column) -> Column:
    """Array with one struct per lexicon engine: name, score, label and what else it reports."""

    def engine(name: str, score: Column, details: dict[str, Column]) -> Column:
        return F.struct(
            F.lit(name).alias("engine"),
            score.alias("score"),
            labels.classify(score).alias("label"),
            F.map_from_arrays(
                F.array(*[F.lit(k) for k in details]),
                F.array(*[v.cast("string") for v in details.values()]),
            ).alias("details"),
        )

    shares = {k: valence[k] for k in ("compound", "positive", "neutral", "negative")}
    parts = {k: polarity[k] for k in ("polarity", "subjectivity")}
    return F.array(engine("valence", valence["compound"], shares), engine("polarity", polarity["polarity"], parts))


def engines_of(text: Column) -> Column:
    """The engines of one text, each evaluated once."""
    return bind(
        lexicon.valence_shares(text),
        lambda v: bind(lexicon.polarity_parts(text), lambda p: engine_row(v, p)),
    )


def with_engines(df: DataFrame, text: str = "clean_text") -> DataFrame:
    return df.withColumn("engines", engines_of(F.col(text)))


def engines_long(df: DataFrame, key: str = "post_id", text: str = "clean_text") -> DataFrame:
    """One row per post and engine.

    The array is built inside the generator: from a column of an earlier step Spark would
    derive a not-empty filter and evaluate the scores a second and third time for it.
    """
    return df.select(key, F.inline(engines_of(F.col(text))))


def with_consensus(df: DataFrame) -> DataFrame:
    """Mean score of the engines that did not fail, and its label; stays within the row."""
    good = F.filter("engines", lambda e: e["label"] != "Error")
    mean = F.aggregate(good, F.lit(0.0), lambda acc, e: acc + e["score"]) / F.size(good)
    return (
        df.withColumn("engine_count", F.size(good))
        .withColumn("consensus_score", F.when(F.col("engine_count") > 0, F.round(mean, 4)))
        .withColumn("consensus_label", labels.classify(F.col("consensus_score")))
    )


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """A filter on a column that was expensive to compute in the same plan.

    ``filter`` would be pushed below that column and compute it once for the test and once
    more for the output. For stored columns use ``filter``, which reaches the scan.
    """
    kept = F.when(condition, F.array(F.lit(True)))
    return df.select("*", F.explode(kept).alias("_kept")).drop("_kept")


def consensus_of_rows(results: DataFrame, key: str = "post_id") -> DataFrame:
    """The same over long engine results that come from different jobs."""
    return (
        results.filter(F.col("label") != "Error")
        .groupBy(key)
        .agg(F.round(F.avg("score"), 4).alias("consensus_score"), F.count("*").alias("engine_count"))
        .withColumn("consensus_label", labels.classify(F.col("consensus_score")))
    )
