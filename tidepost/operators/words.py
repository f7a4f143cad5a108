"""Keyword, phrase and lexicon-hit operators, and the word co-occurrence graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions.binding import bind
from tidepost.functions.lexicon import lexicon_words
from tidepost.functions.text import letter_words, phrases

SALTS = 32
#: Rows of a word table that is sent to every task.
FEW_ROWS = 20_000


def has_few_rows(df: DataFrame, most: int = FEW_ROWS) -> bool:
    """Whether a table is small enough to be sent to every task; reads ``most`` rows and one more."""
    return df.limit(most + 1).count() <= most


def salted(df: DataFrame) -> DataFrame:
    """Rows dealt to ``SALTS`` numbers by input task, so that a word found everywhere is spread."""
    return df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))


def salted_copies(df: DataFrame) -> DataFrame:
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def keywords_exploded(
    df: DataFrame, *keep: str, text: str = "text", stop_words=rules.STOP_WORDS, where: Column | None = None
) -> DataFrame:
    """One row per keyword occurrence; only ``keep`` columns travel along.

    ``where`` picks posts inside the generator, so that a computed label is computed once
    (a filter in front would be pushed below it and compute it again).
    """
    found = letter_words(F.col(text))
    found = found if where is None else F.when(where, found)
    return drop_stop_words(df.select(*keep, F.explode(found).alias("word")), stop_words)


def drop_stop_words(df: DataFrame, stop_words=rules.STOP_WORDS, word: str = "word") -> DataFrame:
    """A list becomes a constant set; a table becomes an anti join on its words.

    The join is salted, and whether the table is broadcast is left to Spark.
    """
    if not isinstance(stop_words, DataFrame):
        return df.filter(~F.col(word).isin(*stop_words))
    stops = stop_words.select(F.col(stop_words.columns[0]).alias(word)).distinct()
    return salted(df).join(salted_copies(stops), [word, "_salt"], "left_anti").drop("_salt")


def word_counts(df: DataFrame, *by: str, text: str = "text", where: Column | None = None) -> DataFrame:
    found = keywords_exploded(df, *by, text=text, where=where)
    return found.groupBy(*by, "word").agg(F.count("*").alias("n"))


def top_keywords(df: DataFrame, n: int = 20, text: str = "text", where: Column | None = None) -> DataFrame:
    return word_counts(df, text=text, where=where).orderBy(F.desc("n"), "word").limit(n)


def keywords_by_sentiment(
    df: DataFrame, n: int = 10, text: str = "text", label: str = "sentiment_label"
) -> DataFrame:
    """Top words of positive and of negative posts.

    ``row_number() <= n`` right above the window lets Spark cut each map task's output to n
    words per label before the shuffle, so no label's whole vocabulary meets in one task.
    """
    wanted = F.lower(label).isin("positive", "negative")
    w = W.partitionBy(label).orderBy(F.desc("n"), F.col("word"))
    return (
        word_counts(df, label, text=text, where=wanted)
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= n)
    )


def cloud_frequencies(
    df: DataFrame, max_words: int = 150, sentiment: str | None = None, text: str = "text",
    label: str = "sentiment_label",
) -> DataFrame:
    """Word-cloud input: the top words with their weight relative to the most frequent one."""
    where = F.lower(label) == sentiment.lower() if sentiment else None
    top = top_keywords(df, max_words, text, where)
    # the window sees at most ``max_words`` rows
    return top.withColumn("weight", F.round(F.col("n") / F.max("n").over(W.partitionBy()), 6))


def document_frequency(df: DataFrame, text: str = "text") -> DataFrame:
    """In how many posts a word occurs."""
    distinct_words = F.array_distinct(letter_words(F.col(text)))
    out = df.select(F.explode(distinct_words).alias("word"))
    return drop_stop_words(out).groupBy("word").agg(F.count("*").alias("size"))


def idf_weights(df: DataFrame, min_docs: int = 3, text: str = "text") -> DataFrame:
    """``ln((N+1)/(df+1))``, 0 for words in fewer than ``min_docs`` posts."""
    docs = df.filter(F.col(text).isNotNull()).agg(F.count("*")).scalar()
    weight = F.log((docs + 1) / (F.col("size") + 1))
    return document_frequency(df, text).withColumn(
        "idf", F.when(F.col("size") >= min_docs, F.round(weight, 6)).otherwise(0.0)
    )


def trending_phrases(df: DataFrame, n: int = 6, text: str = "text") -> DataFrame:
    """Most frequent stop-word-delimited phrases, with their tag form."""
    return (
        df.select(F.explode(phrases(F.col(text))).alias("phrase"))
        .groupBy("phrase")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "phrase")
        .limit(n)
        .withColumn("tag", F.concat(F.lit("#"), F.replace("phrase", F.lit(" "), F.lit(""))))
    )


def lexicon_frame(spark) -> DataFrame:
    """The shipped lexicon as a table (a fixed number of rows)."""
    rows = [(w, *map(float, v)) for w, v in rules.LEXICON.items()]
    return spark.createDataFrame(rows, "token string, valence double, polarity double, subjectivity double")


def lexicon_hits(df: DataFrame, lexicon: DataFrame, key: str = "post_id", text: str = "text") -> DataFrame:
    """Lexicon words per post with their count and summed valence, for any lexicon table.

    Few rows (counted up to ``FEW_ROWS``) are sent to all tasks. Beyond that the join is on
    (token, salt) by merging, so that a word found in every post is spread over ``SALTS`` tasks. Spark
    itself would go by estimated sizes, in which exploded words weigh no more than the posts.
    """
    found = df.select(key, F.explode(lexicon_words(F.col(text))).alias("token"))
    unique = lexicon.dropDuplicates(["token"])
    if has_few_rows(lexicon):
        joined = found.join(F.broadcast(unique), "token")
    else:
        joined = salted(found).join(salted_copies(unique).hint("merge"), ["token", "_salt"])
    return joined.groupBy(key, "token").agg(
        F.count("*").alias("n"), F.round(F.sum("valence"), 4).alias("valence_sum")
    )


# ----- co-occurrence graph -----------------------------------------------------------------


def cooccurrence_nodes(df: DataFrame, n: int = 30, text: str = "text") -> DataFrame:
    """Top words by document frequency with their drawn size."""
    return (
        document_frequency(df, text)
        .orderBy(F.desc("size"), "word")
        .limit(n)
        .withColumn("display_size", F.least(F.greatest(F.col("size") * 2, F.lit(10)), F.lit(50)))
    )


def cooccurrence_edges(df: DataFrame, n: int = 30, text: str = "text", nodes: DataFrame | None = None) -> DataFrame:
    """Pairs of top words that share a post, with the number of posts; weight above 1.

    The top list (n words) enters as a scalar subquery, so each post is cut down to it
    inside its own row: at most n(n-1)/2 pairs per post, folded in the map task before the
    shuffle.
    """
    nodes = cooccurrence_nodes(df, n, text) if nodes is None else nodes
    top = nodes.agg(F.collect_list("word")).scalar()

    def pairs(ws: Column) -> Column:
        def with_later(w1: Column, i: Column) -> Column:
            return F.transform(F.slice(ws, i + 2, F.size(ws)), lambda w2: F.struct(w1.alias("w1"), w2.alias("w2")))

        return F.flatten(F.transform(ws, with_later))

    present = F.sort_array(F.array_intersect(letter_words(F.col(text)), top))
    return (
        df.select(present.alias("present"))
        .select(F.inline(bind(F.col("present"), pairs)))
        .groupBy("w1", "w2")
        .agg(F.count("*").alias("weight"))
        .filter(F.col("weight") > 1)
    )
