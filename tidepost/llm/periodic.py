"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of words with smallest period q, at least ``max(6, 4q)`` words long, that no
neighbouring word extends. At each scale t = 4, 8, 16, ... a synchronising set holds the positions
i at which the smallest hash of the t-word windows that start in [i, i + t] is the first or the
last of them. Whether i belongs depends on the 2t words from i alone, and in a run of period q in
[t, 2t) there is such a position every t words, so that the set holds places q apart with equal
contexts. Nearest pairs of equal contexts propose their distance as a period, and the words decide
how far it reaches.

Windows inside a region of period at most t/4 would all be members; they are left out of the scale.
Their periods are known from the scales before, and those below four from comparing neighbours.
A slice of many documents is one sequence of word hashes with a separator that occurs nowhere
else between documents, so no window and no run crosses two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import in_slices, map_rows
from tidepost.llm.hashing import M1, M2, WHITE_SPACE, mixed, words_by_text

LEAST_WORDS, LEAST_TIMES = 6, 4
FIRST_SCALE = 4
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
EXTEND_CELLS = 1 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
Regions = tuple[np.ndarray, np.ndarray, np.ndarray]  # start, length, period


def equal_stretches(words: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each longest stretch that keeps ``period``."""
    same = np.zeros(max(0, len(words) - period) + 2, np.int8)
    same[1:-1] = words[: len(words) - period] == words[period:] if len(words) > period else 0
    edges = np.flatnonzero(np.diff(same))
    start = edges[0::2]
    return start, edges[1::2] - start + period


def neighbour_periods(words: np.ndarray) -> Regions:
    """Stretches of periods below ``FIRST_SCALE``, four periods long or longer."""
    found = []
    for period in range(1, FIRST_SCALE):
        start, length = equal_stretches(words, period)
        long = length >= LEAST_TIMES * period
        start, length = start[long], length[long]
        # Periods 2 and 3 have no divisor but 1: not the smallest where all words are the same.
        own = np.ones(len(start), bool) if period == 1 else ~np.all([words[start] == words[start + k] for k in range(1, period)], axis=0)
        found.append((start[own], length[own], np.full(int(own.sum()), period)))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` values in a row; ``width`` is a power of two."""
    step = 1
    while step < width:
        values = np.minimum(values[: len(values) - step], values[step:])
        step *= 2
    return values


def synchronising_set(hashes: np.ndarray, scale: int, regions: Regions) -> np.ndarray:
    """Positions of the set at ``scale``; ``hashes`` are those of all windows of ``scale`` words."""
    keys = np.minimum(hashes, LAST - np.uint64(1))
    start, length, period = regions
    inner = (period * LEAST_TIMES <= scale) & (length >= scale)
    cover = np.zeros(len(keys) + 1, np.int32)
    np.add.at(cover, start[inner], 1)
    np.add.at(cover, np.minimum(start[inner] + length[inner] - scale + 1, len(keys)), -1)
    keys[np.cumsum(cover[:-1]) > 0] = LAST
    n = len(keys) - scale
    if n <= 0:
        return np.zeros(0, np.int64)
    least = np.minimum(window_minimum(keys, scale)[:n], keys[scale : scale + n])
    return np.flatnonzero((least < LAST) & ((keys[:n] == least) | (keys[scale : scale + n] == least)))


def proposals(places: np.ndarray, contexts: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Period and bounds of the places from which words are proposed to equal those a period on.

    Nearest places of equal contexts at a distance in [scale, 2 scale) propose it; what overlaps or
    touches with one distance is one proposal.
    """
    order = np.argsort(contexts, kind="stable")
    places, contexts = places[order], contexts[order]
    distance = np.diff(places)
    near = (contexts[1:] == contexts[:-1]) & (distance >= scale) & (distance < 2 * scale)
    start, period = places[:-1][near], distance[near]
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (period[1:] != period[:-1]) | (start[1:] > start[:-1] + 2 * scale)
    first = np.flatnonzero(fresh)
    end = start[np.append(first[1:], len(start)) - 1] + 2 * scale if len(start) else start
    return period[first], start[first], end


def reach(words: np.ndarray, at: np.ndarray, period: np.ndarray, step: int, width: int) -> np.ndarray:
    """How many places from ``at`` on (``step`` 1, or -1 backwards) equal those a period further."""
    out = np.zeros(len(at), np.int64)
    active = np.arange(len(at))
    rows = max(1, EXTEND_CELLS // width)
    while len(active):
        still = []
        for k in range(0, len(active), rows):
            some = active[k : k + rows]
            left = at[some, None] + step * (out[some, None] + np.arange(width))
            right = left + period[some, None]
            inside = (left >= 0) & (right < len(words))
            same = inside & (words[np.where(inside, left, 0)] == words[np.where(inside, right, 0)])
            whole = same.all(1)
            out[some] += np.where(whole, width, same.argmin(1))
            still.append(some[whole])
        active = np.concatenate(still)
    return out


def runs_at_scale(words: np.ndarray, hashes: np.ndarray, contexts: np.ndarray, scale: int, regions: Regions) -> Regions:
    """Runs with a period in [scale, 2 scale)."""
    places = synchronising_set(hashes, scale, regions)
    places = places[places < len(contexts)]
    period, start, end = proposals(places, contexts[places], scale)
    # In a run of four periods a proposal leaves at most ``scale`` places on either side.
    long = end - start + 2 * scale >= (LEAST_TIMES - 1) * period
    period, start, end = period[long], start[long], end[long]
    start, end = start - reach(words, start - 1, period, -1, scale), end + reach(words, end, period, 1, scale)
    long = end - start >= (LEAST_TIMES - 1) * period
    found = np.unique(np.stack([start[long], end[long], period[long]], axis=1), axis=0)
    right = [np.array_equal(words[a:b], words[a + q : b + q]) for a, b, q in found.tolist()]
    start, end, period = found[np.array(right, bool)].T if len(found) else np.zeros((3, 0), np.int64)
    return start, end - start + period, period


def sequence_runs(words: np.ndarray, bounds: np.ndarray) -> Regions:
    """Runs of a sequence of documents that start at ``bounds``, each ended by its separator."""
    regions = neighbour_periods(words)
    sizes = np.diff(bounds)
    where, scale = np.arange(len(words)), FIRST_SCALE
    hashes = words
    for width in (1, 2):
        hashes = joined(hashes, width)
    while scale * LEAST_TIMES <= sizes.max(initial=0) - 1:
        # Documents that are too short for the periods of this scale go; the others stay whole.
        enough = np.repeat(sizes > scale * LEAST_TIMES, sizes)
        if 2 * int(enough.sum()) < len(words):
            sizes = sizes[sizes > scale * LEAST_TIMES]
            words, where = words[enough], where[enough]
            hashes = hashes[enough[: len(hashes)]]
        at = np.searchsorted(where, regions[0])
        held = (at < len(where)) & (where[np.minimum(at, len(where) - 1)] == regions[0])
        contexts = joined(hashes, scale)
        start, length, period = runs_at_scale(words, hashes, contexts, scale, (at[held], regions[1][held], regions[2][held]))
        regions = tuple(np.concatenate(p) for p in zip(regions, (where[start], length, period), strict=True))
        hashes, scale = contexts, 2 * scale
    return regions


def joined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows twice as wide as the ``width`` words of ``hashes``."""
    n = max(0, len(hashes) - width)
    return mixed(hashes[:n] * M1 ^ mixed(hashes[width : width + n] + M2))


def document_runs(texts: list[bytes]) -> list[np.ndarray]:
    """(start, length, period) of the runs of each text, by start, then period."""
    words, bounds = words_by_text(texts, WHITE_SPACE)
    # A separator of its own after each document.
    separators = mixed(np.arange(1, len(texts) + 1, dtype=np.uint64) * M2)
    starts = bounds + np.arange(len(bounds))
    sequence = np.insert(words, bounds[1:], separators)
    start, length, period = sequence_runs(sequence, starts)
    long = length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    owner = np.searchsorted(starts, start, side="right") - 1
    rows = np.stack([start - starts[owner], length, period], axis=1)
    return np.split(rows, np.searchsorted(owner, np.arange(1, len(texts))))


def collapsed(text: bytes, runs: np.ndarray) -> bytes:
    """The words of ``text`` that no run holds after its first period, joined by one space."""
    words = text.split()
    if not len(runs):
        return b" ".join(words)
    drop = np.zeros(len(words), bool)
    for start, length, period in runs.tolist():
        drop[start + period : start + length] = True
    return b" ".join(word for word, gone in zip(words, drop.tolist(), strict=True) if not gone)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: one row for each row of ``docs``.

    Words are what ASCII white space leaves. ``runs`` holds (start, length, period) by start, then
    period; ``collapsed`` has each run cut down to its first period. A null or blank text has no
    words and no runs and an empty ``collapsed``. Rows are taken one by one, so ids may repeat or
    be null; an empty table gives no rows; other columns are not looked at. A task holds some
    hundred bytes for each word of the longest text, and of a slice of about a megabyte of others.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [s or 0 for s in pc.binary_length(batch.column(1)).to_pylist()]
            for start, end in in_slices([range(s) for s in sizes]):
                texts = [t or b"" for t in batch.column(1).slice(start, end - start).to_pylist()]
                runs = document_runs(texts)
                flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
                offsets = np.cumsum([0, *map(len, runs)])
                structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array([len(t.split()) for t in texts], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                        pa.array([collapsed(t, r) for t, r in zip(texts, runs, strict=True)], pa.binary()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    schema = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary"
    return map_rows(rows, schema, work).withColumn("collapsed", F.col("collapsed").cast("string"))
