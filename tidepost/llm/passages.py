"""Passages of some fifty words that occur in several places, by sampled word n-grams.

Of every ``WORDS`` consecutive n-grams of ``WORDS`` words the one with the smallest hash is taken, so
that any two equal runs of ``2 * WORDS - 1`` words have an equal n-gram taken at equal places. An
n-gram stays where it comes first, by document id, then text hash, then place; all later places count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import cut, in_slices, map_rows, text_hash
from tidepost.llm.hashing import WHITE_SPACE, ngrams, words_by_text

WORDS = 24
NAMES = ["h", "doc_id", "th", "span"]
#: A span is one number, its start and below that its length in so many bits: rows are what the disk holds.
LENGTH_BITS = 31


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~WHITE_SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(inside))
    return edges[0::2], edges[1::2]


def taken(grams: np.ndarray) -> np.ndarray:
    """Places of the smallest of every ``WORDS`` hashes in a row; of fewer, of them all."""
    width = min(WORDS, len(grams))
    if not width:
        return np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, width)
    return np.unique(windows.argmin(1) + np.arange(len(windows)))


def places(docs: DataFrame) -> DataFrame:
    """``h, doc_id, th, span``: the sampled n-grams of each document and their bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [range(n or 0) for n in pc.binary_length(batch.column(1)).to_pylist()]
            for low, high in in_slices(sizes):
                texts = [t or b"" for t in batch.column(1).slice(low, high - low).cast(pa.binary()).to_pylist()]
                words, bounds = words_by_text(texts, WHITE_SPACE)
                grams = ngrams(words, WORDS)
                found = []
                for i, text in enumerate(texts):
                    a, b = bounds[i], bounds[i + 1] - WORDS + 1
                    at = taken(grams[a:b]) if b > a else np.zeros(0, np.int64)
                    starts, ends = word_bounds(text) if len(at) else (at, at)
                    found.append((grams[a + at].view(np.int64), starts[at], ends[at + WORDS - 1] if len(at) else at))
                owner = pa.array(np.repeat(np.arange(low, high), [len(f[0]) for f in found]))
                grams, starts, ends = (np.concatenate([f[k] for f in found]).astype(np.int64) for k in range(3))
                ids = [batch.column(k).take(owner) for k in (0, 2)]
                spans = starts << LENGTH_BITS | ends - starts
                yield pa.RecordBatch.from_arrays([pa.array(grams), *ids, pa.array(spans)], NAMES)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_hash().alias("th"))
    return map_rows(rows, ", ".join(f"{c} bigint" for c in NAMES), work)


def later_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, th, passages``: byte ranges of each document that an earlier place has too.

    Hashes alone are counted; n-grams that occur once go before first places are found, by partial
    aggregation, so that places travel once.
    """
    found = cut(places(docs), "passages")
    again = cut(found.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h"), "repeated-ngrams")
    found = cut(found.join(again.hint("merge"), "h", "left_semi"), "repeated-passages")
    place = F.struct("doc_id", "th", "span")
    first = cut(found.groupBy("h").agg(F.min(place).alias("first")), "first-passages")
    later = found.join(first.hint("merge"), "h").where(~place.eqNullSafe(F.col("first")))
    start = F.shiftright("span", LENGTH_BITS)
    passage = F.struct(start.alias("start"), (start + F.col("span").bitwiseAND(F.lit((1 << LENGTH_BITS) - 1))).alias("end"))
    return later.groupBy("doc_id", "th").agg(F.collect_set(passage).alias("passages"))
