"""Helpers shared by the operators: shared tables, Arrow tasks, bounded slices of text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost.sources.workdir import fresh_path

#: Bytes of text that a task expands into numpy arrays at once; it bounds memory, not results.
SLICE_BYTES = 1 << 20


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a lost executor costs no earlier stage.

    What is written stays there for as long as the operator runs, so it is packed more tightly than by default.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """Text as operators see it: a null is an empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def map_rows(
    df: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    return df.mapInArrow(work, schema)


def in_slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` bytes; a longer text is a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def text_hash() -> Column:
    """Tells rows that share a ``doc_id`` apart by their text."""
    return F.xxhash64(text_of())
