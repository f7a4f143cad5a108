"""Filters, sorting and bounded top-k of the search page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.operators.prepare import keep_where
from tidepost.sources.listing import matches

# Sort choice -> (column, ascending); anything else means newest first.
SORTS = {
    "Most Recent": ("timestamp", False),
    "Highest Score": ("sentiment_score", False),
    "Lowest Score": ("sentiment_score", True),
    "Most Liked": ("likes", False),
    "Most Shared": ("shares", False),
}
CARDS = 20
FEED = 10


def has_sentiment(wanted, label: str = "sentiment_label") -> Column:
    return F.lower(label).isin(*[w.lower() for w in wanted])


def filter_sentiment(df: DataFrame, wanted, label: str = "sentiment_label") -> DataFrame:
    return df.filter(has_sentiment(wanted, label))


def filter_keyword(df: DataFrame, keyword: str | None, text: str = "text", literal: bool = False) -> DataFrame:
    """A regular expression by default, as users type it; no keyword keeps every row."""
    return df.filter(matches(F.col(text), keyword, literal)) if keyword else df


def filter_topics(df: DataFrame, topics, topic: str = "topic", stored: bool = False) -> DataFrame:
    """``stored`` tells that topics come from a scan, which the filter then reaches; a topic computed
    in the same plan is tested where it stands, so that texts are cleaned once."""
    if not topics:
        return df
    wanted = F.col(topic).isin(*topics)
    return df.filter(wanted) if stored else keep_where(df, wanted)


def distinct_topics(df: DataFrame, topic: str = "topic") -> DataFrame:
    return df.select(topic).distinct().orderBy(topic)


def sort_column(by: str = "Most Recent") -> str:
    return SORTS.get(by, SORTS["Most Recent"])[0]


def sort_order(by: str = "Most Recent", key: str = "post_id") -> list[Column]:
    """Nulls last both ways, ties by id."""
    column, ascending = SORTS.get(by, SORTS["Most Recent"])
    first = F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last()
    return [first, F.col(key)]


def sorted_posts(df: DataFrame, by: str = "Most Recent", n: int | None = CARDS, key: str = "post_id") -> DataFrame:
    ordered = df.orderBy(*sort_order(by, key))
    return _first(ordered, n) if n else ordered


def _first(ordered: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows. What is computed of them later stays above a generator: Spark would move
    the limit below such projections, away from its sort, and then sort everything."""
    return keep_where(ordered.limit(n), F.lit(True))


def search(df: DataFrame, keyword=None, topics=(), sentiments=(), literal: bool = False, stored: bool = False) -> DataFrame:
    out = filter_topics(filter_keyword(df, keyword, literal=literal), topics, stored=stored)
    if not sentiments:
        return out
    return filter_sentiment(out, sentiments) if stored else keep_where(out, has_sentiment(sentiments))


def live_feed(df: DataFrame, n: int = FEED, key: str = "post_id") -> DataFrame:
    ordered = df.orderBy(F.col("timestamp").desc_nulls_last(), F.col(key))
    return _first(ordered, n).withColumn("clock", F.date_format("timestamp", "HH:mm:ss"))
