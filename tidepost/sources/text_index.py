"""Search that skips files: which trigrams the texts of each file have, beside the files.

The index has one bitmap of hashed trigrams per file, in rows of 32,768 bits. A search takes the
literal parts that every match of its expression must hold, reads the bitmaps, and opens only files
that may hold all their trigrams. The expression itself still decides about each row, so a filled
bitmap or an expression without literal parts costs reading and never a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost.sources.listing import matches

BITS, BUCKET = 1 << 20, 1 << 15
#: Signs of a text that are hashed at once; it bounds memory.
PART_SIGNS = 1 << 20
LEAST = 3
#: A sign of these makes an expression more than literal parts, wild signs and quantifiers.
STRUCTURE = set("|([{\\")
QUANTIFIERS = set("?*+")


def required_parts(pattern: str, literal: bool = False) -> list[str]:
    """Literal strings of three signs or more that every match holds."""
    if literal:
        return [pattern] if len(pattern) >= LEAST else []
    if STRUCTURE & set(pattern):
        return []
    parts, held = [], ""
    for i, sign in enumerate(pattern):
        after = pattern[i + 1 : i + 2]
        if sign in QUANTIFIERS or sign in ".^$":
            parts, held = [*parts, held], ""
        elif after in ("?", "*"):
            parts, held = [*parts, held], ""
        else:
            held += sign
    return [p for p in (*parts, held) if len(p) >= LEAST]


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of a text that is in lower case, with repeats."""
    signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    packed = signs[:-2] | signs[1:-1] << np.uint64(21) | signs[2:] << np.uint64(42)
    return packed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS.bit_length() + 1)


def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``file, bucket, bitmap`` of rows (file, text in lower case); rows of a file mostly come together."""
    file, flags = None, np.zeros(BITS, bool)

    def flush() -> Iterator[pa.RecordBatch]:
        rows = flags.reshape(-1, BUCKET)
        buckets = np.flatnonzero(rows.any(1))
        packed = [np.packbits(rows[b], bitorder="little").tobytes() for b in buckets]
        columns = [pa.array([file] * len(buckets), pa.string()), pa.array(buckets.astype(np.int64)), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["file", "bucket", "bitmap"])
        flags[:] = False

    for batch in batches:
        for own, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            if own != file:
                yield from flush()
                file = own
            text = data.as_py().decode("utf-8", "replace")
            for at in range(0, len(text) - LEAST + 1, PART_SIGNS):
                flags[trigrams(text[at : at + PART_SIGNS + LEAST - 1])] = True
    yield from flush()


def write_indexed(df: DataFrame, path: str, text: str = "text") -> None:
    """``df`` as Parquet in ``path/rows`` and its index in ``path/trigrams``."""
    df.write.parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    found = rows.mapInArrow(bitmaps, "file string, bucket bigint, bitmap binary")
    found.groupBy("file", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap")).write.parquet(f"{path}/trigrams")


def _bit(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2.0), place % 8)) % 2


def files_to_read(spark: SparkSession, path: str, pattern: str, literal: bool = False) -> list[str] | None:
    """Files that may hold a match, or None if the expression has no literal part to go by."""
    parts = required_parts(pattern, literal)
    if not parts:
        return None
    lower = spark.createDataFrame([(p,) for p in parts], "part string").select(F.lower("part")).collect()
    bits = np.unique(np.concatenate([trigrams(r[0]) for r in lower])).tolist()
    needed = spark.createDataFrame([(b // BUCKET, b % BUCKET) for b in bits], "bucket bigint, place int")
    wanted = len(bits)
    # a few trigrams of the expression go to all tasks
    held = spark.read.parquet(f"{path}/trigrams").join(F.broadcast(needed), "bucket")
    held = held.where(_bit(F.col("bitmap"), F.col("place")) == 1)
    return [r["file"] for r in held.groupBy("file").count().where(F.col("count") == wanted).select("file").collect()]


def search(spark: SparkSession, path: str, pattern: str, text: str = "text", literal: bool = False) -> DataFrame:
    """Rows of an indexed folder whose text matches, as ``matches`` over all of them."""
    rows = spark.read.parquet(f"{path}/rows")
    files = files_to_read(spark, path, pattern, literal)
    if files is not None:
        rows = spark.read.schema(rows.schema).parquet(*files) if files else rows.limit(0)
    return rows.where(matches(F.col(text), pattern, literal))
