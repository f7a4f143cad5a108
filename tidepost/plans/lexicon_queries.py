"""Scores of real texts with a lexicon that is a table, made from the words of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.functions import labels
from tidepost.functions.lexicon import lexicon_words
from tidepost.operators import entities, lexicon_table
from tidepost.plans import sql as q
from tidepost.plans.registry import Given, query
from tidepost.sources.workdir import fresh_path

#: Words of two of the languages, as entities to compare.
TURN_PAIR = ("the", "que")


def document_lexicon(g: Given) -> DataFrame:
    """A lexicon of the words that several documents share, as a stored table: values are arithmetic
    on the number of documents and the length of a word."""
    found = g.documents.select(F.explode(F.array_distinct(lexicon_words(F.col("text")))).alias("token"))
    counts = found.groupBy("token").agg(F.count("*").alias("n"))
    n, size = F.col("n"), F.length("token")
    rows = counts.where((n >= 2) & (size >= 2) & ((n + size) % 2 == 0)).select(
        "token", (((n * 37 + size * 11) % 81 - 40) / 10.0).alias("valence"),
        (((n * 53 + size * 7) % 195 - 97) / 97.0).alias("polarity"), ((n * 29 + size) % 89 / 89.0).alias("subjectivity"),
    )
    path = fresh_path(g.spark, "lexicon")
    rows.write.parquet(path)
    return g.spark.read.schema(rows.schema).parquet(path)


def turns(g: Given) -> DataFrame:
    return g.table("conversations").select(F.concat_ws("-", "conv_id", "turn").alias("turn_id"), "conv_id", "turn", "text")


@query(
    "score_valence_lexicon",
    f"""SELECT id AS doc_id, compound AS sentiment_score, positive, neutral, negative, {q.label('compound')} AS sentiment_label FROM tval""",
)
def score_valence_lexicon(g: Given):
    rows = lexicon_table.with_valence(g.documents, document_lexicon(g), "doc_id", "text")
    labelled = labels.classify(F.col("valence.compound")).alias("sentiment_label")
    return rows.select(
        "doc_id", F.col("valence.compound").alias("sentiment_score"), "valence.positive", "valence.neutral", "valence.negative", labelled
    )


@query(
    "score_polarity_lexicon",
    f"SELECT id AS turn_id, polarity, subjectivity, {q.label('polarity')} AS sentiment_label FROM tpol",
)
def score_polarity_lexicon(g: Given):
    rows = lexicon_table.with_polarity(turns(g), document_lexicon(g), "turn_id", "text")
    labelled = labels.classify(F.col("polarity.polarity")).alias("sentiment_label")
    return rows.select("turn_id", "polarity.polarity", "polarity.subjectivity", labelled)


@query(
    "multi_engine_scores_lexicon",
    f"""SELECT id AS turn_id, engine, score, {q.label('score')} AS label FROM
        (SELECT id, 'valence' AS engine, compound AS score FROM cval UNION ALL SELECT id, 'polarity', polarity FROM tpol)""",
)
def multi_engine_scores_lexicon(g: Given):
    return lexicon_table.engines_long(turns(g), document_lexicon(g), "turn_id", "text").drop("details")


@query(
    "entity_compare_turns",
    f"""SELECT e.entity, count(s.id) AS volume, coalesce(round(avg(s.compound), 6), 0.0) AS avg_score,
          count(s.id) FILTER (WHERE {q.label('s.compound')} = 'Positive') AS positive,
          round(CASE WHEN count(s.id) > 0 THEN 100.0::DOUBLE * count(s.id) FILTER (WHERE {q.label('s.compound')} = 'Positive') / count(s.id)
                ELSE 0.0 END, 4) AS positive_pct
        FROM (VALUES {', '.join(f'({q.quoted(e)})' for e in TURN_PAIR)}) AS e(entity)
          LEFT JOIN (SELECT t.text, v.* FROM turns t JOIN cval v ON v.id = t.turn_id) s ON contains(lower(s.text), e.entity)
        GROUP BY e.entity""",
)
def entity_compare_turns(g: Given):
    tagged = entities.tag_entities(turns(g), TURN_PAIR)
    scored = lexicon_table.score_sentiment(tagged, document_lexicon(g), "valence", "turn_id", "text")
    return entities.entity_compare(scored, TURN_PAIR)
