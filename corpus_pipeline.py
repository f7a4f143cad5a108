"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost.llm import contamination, languages, lines, ngram_join, packing
from tidepost.llm.common import cut, table
from tidepost.llm.queries import word_tokenizer


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay; null texts and those without a letter go."""
    found = languages.identify(docs)
    return found.where(F.col("lang_pred") != languages.UNKNOWN).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated windows of three lines go; documents of which nothing is left go too.

    ``n_chars`` follows the text.
    """
    thinned = lines.dedup_lines(docs).where((F.col("n_removed") == 0) | (F.length("text") > 0))
    if "n_chars" in docs.columns:
        thinned = thinned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return thinned.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.first_of_groups(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or an edited copy of one, go."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 2048 tokens."""
    return packing.packed_documents(docs, word_tokenizer())


STAGES = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near_copies", drop_near_copies),
    ("benchmark", decontaminate),
    ("packing", pack),
]

#: Mixtures, alignments and tokens have no SQL form; a test chains plain versions of the stages instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = cut(docs, f"stage-{name}")
    return docs
