"""Lexicon engines with a caller's lexicon, a table ``token, valence, polarity, subjectivity``.

A table of few rows becomes a constant of the row-local expressions in ``functions.lexicon``. A
larger one is joined: every word of a text goes with its place, and what the lexicon has for the
places of a text comes back to it, where the words around them are looked at and the values folded
in order. Up to ``SENT_ROWS`` rows the lexicon is sent to all tasks and no word is shuffled; beyond that
words and lexicon meet on (word, salt). All ways give the same scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions import labels, lexicon as lx
from tidepost.functions.binding import bind
from tidepost.operators.prepare import engine_row
from tidepost.operators.words import has_few_rows, salted, salted_copies

#: Rows of a lexicon that becomes a constant in the plan.
LITERAL_ROWS = 1000
#: Rows of a lexicon that is sent to all tasks, some twenty megabytes.
SENT_ROWS = 200_000


def unique_lexicon(lexicon: DataFrame) -> DataFrame:
    """One row per token in lower case; of several the smallest values count. Null tokens go."""
    token = F.lower("token").alias("token")
    values = F.struct(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ("valence", "polarity", "subjectivity")))
    rows = lexicon.where("token IS NOT NULL").select(token, values.alias("v"))
    return rows.groupBy("token").agg(F.min("v").alias("v")).select("token", "v.*")


def literal_lexicon(lexicon: DataFrame, most: int | None = None) -> dict | None:
    """The lexicon as a mapping, or None if it has more than ``most`` rows; no more are read."""
    most = LITERAL_ROWS if most is None else most
    rows = unique_lexicon(lexicon.limit(most + 1)).collect() if lexicon.limit(most + 1).count() <= most else None
    # no word has a comma or colon, which stand between the parts of a constant
    return None if rows is None else {r[0]: tuple(r[1:]) for r in rows if "," not in r[0] and ":" not in r[0]}


def _hits(df: DataFrame, lexicon: DataFrame, key: str, text: str, *values: str) -> DataFrame:
    """``_key, _th, _hits``: per text the places of its lexicon words with their ``values``, in order.

    Texts that share a key are told apart by a hash, and rows that repeat give the same set.
    """
    words = lx.lexicon_words(F.coalesce(F.col(text), F.lit("")))
    found = df.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_th"), F.posexplode(words).alias("at", "token"))
    known = unique_lexicon(lexicon).select("token", *values)
    if has_few_rows(lexicon, SENT_ROWS):
        joined = found.join(F.broadcast(known), "token")
    else:
        joined = salted(found).join(salted_copies(known).hint("merge"), ["token", "_salt"])
    return joined.groupBy("_key", "_th").agg(F.sort_array(F.collect_set(F.struct("at", *values))).alias("_hits"))


def _with_hits(df: DataFrame, hits: DataFrame, key: str, text: str) -> DataFrame:
    """Adds ``_hits``, an empty list for a text without any; both sides are as many as the texts."""
    marked = df.withColumn("_mark", F.xxhash64(text))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_mark") == F.col("_th"))
    rows = marked.join(hits.hint("merge"), same, "left").drop("_key", "_th", "_mark")
    return rows.withColumn("_hits", F.coalesce("_hits", F.array().cast(hits.schema["_hits"].dataType)))


def with_valence(df: DataFrame, lexicon: DataFrame | None = None, key: str = "post_id", text: str = "clean_text") -> DataFrame:
    """Adds ``valence``, a struct of compound score and shares; every row stays.

    A null or empty text, and one without a lexicon word, has the score 0.0. ``key`` may repeat or
    be null. Without a lexicon the shipped one is used.
    """
    known = rules.LEXICON if lexicon is None else literal_lexicon(lexicon)
    if known is not None:
        return df.withColumn("valence", lx.valence_shares(F.col(text), known))

    def shares(words: Column, hits: Column) -> Column:
        def adjusted(contrast: Column) -> Column:
            return F.transform(hits, lambda h: lx.adjusted_valence(h["valence"], *lx.valence_context(words, h["at"], contrast)))

        return lx.shares_of(bind(lx.contrast_place(words), adjusted), F.size(words) - F.size(hits), F.col(text))

    rows = _with_hits(df, _hits(df, lexicon, key, text, "valence"), key, text)
    words = lx.lexicon_words(F.coalesce(F.col(text), F.lit("")))
    return rows.withColumn("valence", bind(words, lambda ws: shares(ws, F.col("_hits")))).drop("_hits")


def with_polarity(df: DataFrame, lexicon: DataFrame | None = None, key: str = "post_id", text: str = "clean_text") -> DataFrame:
    """Adds ``polarity``, a struct of polarity and subjectivity; otherwise as :func:`with_valence`."""
    known = rules.LEXICON if lexicon is None else literal_lexicon(lexicon)
    if known is not None:
        return df.withColumn("polarity", lx.polarity_parts(F.col(text), known))

    def read(words: Column) -> Column:
        def one(h: Column) -> Column:
            p = lx.adjusted_polarity(h["polarity"], *lx.polarity_context(words, h["at"]))
            return F.struct(p.alias("p"), h["subjectivity"].alias("s"))

        return F.transform("_hits", one)

    rows = _with_hits(df, _hits(df, lexicon, key, text, "polarity", "subjectivity"), key, text)
    words = lx.lexicon_words(F.coalesce(F.col(text), F.lit("")))
    return rows.withColumn("polarity", bind(words, lambda ws: lx.means_of(read(ws)))).drop("_hits")


def score_sentiment(
    df: DataFrame, lexicon: DataFrame, engine: str = "valence", key: str = "post_id", text: str = "clean_text"
) -> DataFrame:
    """Score and label of one engine with a caller's lexicon."""
    scored, part = {"valence": (with_valence, "compound"), "polarity": (with_polarity, "polarity")}[engine]
    rows = scored(df.drop(engine), lexicon, key, text)
    rows = rows.withColumn("sentiment_score", F.col(engine)[part]).drop(engine)
    return rows.withColumn("sentiment_label", labels.classify(F.col("sentiment_score")))


def engines_long(df: DataFrame, lexicon: DataFrame, key: str = "post_id", text: str = "clean_text") -> DataFrame:
    """One row per post and engine, as ``prepare.engines_long``."""
    rows = with_polarity(with_valence(df.select(key, text), lexicon, key, text), lexicon, key, text)
    return rows.select(key, F.inline(engine_row(F.col("valence"), F.col("polarity"))))
