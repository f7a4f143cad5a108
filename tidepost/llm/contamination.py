"""Benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

The documents are scanned twice for each block of test items. The first scan counts in how many
documents each n-gram of the items occurs: three words in order within five, so that edits between
them do not matter. All rare ones become seeds, and the rarest of every few consecutive ones. In the
second scan a seed that occurs in a document marks a passage, and the passage is aligned with the
item word by word. Items of fewer than eight words are looked for as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import cut, in_slices, map_rows, text_hash
from tidepost.llm.hashing import M1, PUNCTUATION, mixed, ngrams, text_words, words_by_text

#: Where the second and third word of an n-gram stand after its first. The hash is that of the three
#: words alone: words put in, left out or replaced between them give the same n-gram.
SHAPES = ((1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4))
#: One seed at least for so many consecutive n-grams of a shape.
SEED_EVERY = 3
#: Every n-gram in no more than this part of the documents, or this number of them, is a seed.
RARE_SHARE, RARE_DOCUMENTS = 0.001, 100
#: Shorter items have no edited copies, only exact ones.
MIN_WORDS = 8
#: Part of the highest possible alignment score from which a passage counts as a copy.
LEAST_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, 1
#: Text of the items that one broadcast holds; more items make more blocks.
BLOCK_BYTES = 1 << 20
#: Signs of scripts without spaces; each is a word.
IDEOGRAPHS = re.compile("([\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


@dataclass
class Items:
    """A block of items: their words, (n-gram, item, place, shape) sorted by n-gram, and for short
    items the hashes of the whole by number of words: ``short[n] = (hashes, ids)``."""

    ids: list[int]
    words: list[np.ndarray]
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray
    shape: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]


def normal(text: str | None) -> bytes:
    lower = (text or "").lower()
    if not lower.isascii():
        lower = IDEOGRAPHS.sub(r" \1 ", lower)
    return lower.encode("utf-8", "surrogatepass")


def triples(words: np.ndarray) -> list[np.ndarray]:
    """For each shape the hashes of the n-grams that start at each word."""
    out = []
    for second, third in SHAPES:
        many = max(0, len(words) - third)
        a, b, c = words[:many], words[second : second + many], words[third : third + many]
        out.append(mixed((mixed((a + np.uint64(1)) * M1 + b) + np.uint64(1)) * M1 + c))
    return out


def make_items(rows: list[tuple[int, str]]) -> Items:
    ids, words, grams, short = [], [], [], {}
    for item_id, text in rows:
        found = text_words(normal(text), PUNCTUATION)
        if len(found) >= MIN_WORDS:
            ids.append(item_id)
            words.append(found)
            grams.append(triples(found))
        elif len(found):
            short.setdefault(len(found), []).append((int(ngrams(found, len(found))[0]), item_id))
    many = [len(g) for found in grams for g in found]
    gram = np.concatenate([np.zeros(0, np.uint64), *[g for found in grams for g in found]])
    item = np.repeat(np.repeat(np.arange(len(ids)), len(SHAPES)), many)
    shape = np.repeat(np.tile(np.arange(len(SHAPES)), len(ids)), many)
    place = np.concatenate([np.zeros(0, np.int64), *[np.arange(n) for n in many]])
    order = np.lexsort((place, shape, item, gram))
    held = {n: (np.array([h for h, _ in found], np.uint64), np.array([i for _, i in found], np.int64)) for n, found in short.items()}
    return Items(ids, words, gram[order], item[order], place[order], shape[order], held)


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """id, text hash, words, and n-grams of each document with where they start; slices bound the memory."""
    for batch in batches:
        ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = [normal(t.as_py()) for t in batch.column(2)]
        for start, end in in_slices(texts):
            words, bounds = words_by_text(texts[start:end], PUNCTUATION)
            grams = triples(words)
            for i in range(start, end):
                a, b = bounds[i - start], bounds[i - start + 1]
                own = [g[a : max(a, b - third)] for g, (_, third) in zip(grams, SHAPES, strict=True)]
                where = np.concatenate([np.arange(len(g)) for g in own])
                yield ids[i], marks[i], words[a:b], np.concatenate(own), where


class Known:
    """Sorted n-grams to be found. A table of their first bits sorts out most others at once."""

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        bits = min(24, max(16, len(grams).bit_length() + 4))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[grams >> self.shift] = True

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``grams`` are known, and as which."""
        which = np.flatnonzero(self.table[grams >> self.shift])
        at = np.searchsorted(self.grams, grams[which])
        at[at == len(self.grams)] = 0
        same = self.grams[at] == grams[which]
        return which[same], at[same]


def document_counts(docs: DataFrame, known: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each n-gram of the block occurs, and the number of documents: one
    number per n-gram is collected."""
    held = docs.sparkSession.sparkContext.broadcast(known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total, grams_known = np.zeros(len(held.value), np.int64), 0, Known(held.value)
        for _, _, _, grams, _ in scan(batches):
            counts[np.unique(grams_known.find(grams)[1])] += 1
            total += 1
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(counts[used], total))], ["gram", "n"]
        )

    found = map_rows(docs, "gram bigint, n bigint", work).groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    gram, n = np.asarray(found.column("gram")), np.asarray(found.column("n"))
    out = np.zeros(len(known), np.int64)
    out[gram[gram >= 0]] = n[gram >= 0]
    return out, int(n[gram < 0].sum())


def chosen_seeds(items: Items, known: np.ndarray, counts: np.ndarray, total: int) -> np.ndarray:
    """Which entries of the block are seeds: all rare ones, and of each shape the rarest of every
    ``SEED_EVERY``."""
    often = counts[np.searchsorted(known, items.grams)]
    part = items.place // SEED_EVERY
    order = np.lexsort((items.place, often, part, items.shape, items.item))
    first = np.ones(len(order), bool)
    first[1:] = False
    for key in (items.item, items.shape, part):
        first[1:] |= key[order][1:] != key[order][:-1]
    chosen = often <= max(RARE_DOCUMENTS, RARE_SHARE * total)
    chosen[order[first]] = True
    return chosen


def align(item: np.ndarray, passage: np.ndarray) -> float:
    """Smith-Waterman score of two word sequences, as part of the score of a full copy."""
    steps = np.arange(len(passage)) * GAP
    row, best = np.zeros(len(passage) + 1, np.int64), 0
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, MATCH, MISMATCH)
        cell = np.maximum(np.maximum(diagonal, row[1:] - GAP), 0)
        row[1:] = np.maximum.accumulate(cell + steps) - steps
        best = max(best, int(row.max()))
    return best / (MATCH * len(item))


def may_align(item: np.ndarray, passage: np.ndarray) -> bool:
    """Whether enough words of the passage are the item's: no alignment has more matches."""
    return int(np.isin(passage, item).sum()) >= LEAST_SCORE * len(item)


def passages(places: np.ndarray, offsets: np.ndarray, size: int, length: int) -> Iterator[tuple[int, int]]:
    """Stretches of a document of ``length`` words around seeds at ``places``."""
    margin = size // 2 + 2
    low = np.maximum(places - offsets - margin, 0)
    high = np.minimum(places - offsets + size + margin, length)
    start, end = None, None
    for a, b in sorted(zip(low.tolist(), high.tolist(), strict=True)):
        if end is None or a > end:
            if end is not None:
                yield start, end
            start, end = a, b
        else:
            end = max(end, b)
    if end is not None:
        yield start, end


def aligned(docs: DataFrame, items: Items, seeds: np.ndarray) -> DataFrame:
    """``doc_id, th, item_id, score`` of every pair with a seed and a score that is high enough, and
    of every short item that a document has word for word."""
    held = docs.sparkSession.sparkContext.broadcast(
        (items.ids, items.words, items.grams[seeds], items.item[seeds], items.place[seeds], items.short)
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, _, grams, _, _, short = held.value
        known, first, many = np.unique(grams, return_index=True, return_counts=True)
        seeds, wholes, out = Known(known), {n: Known(np.unique(hashes)) for n, (hashes, _) in short.items()}, []
        for doc_id, th, words, found, starts in scan(batches):
            for n, (hashes, own) in short.items():
                seen = wholes[n].grams[np.unique(wholes[n].find(ngrams(words, n))[1])]
                out += [(doc_id, th, number, 1.0) for number in np.unique(own[np.isin(hashes, seen)]).tolist()]
            which, at = seeds.find(found) if len(known) else ((), ())
            if len(which):
                out += [(doc_id, th, ids[number], score) for number, score in scores(words, starts[which], first[at], many[at])]
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def scores(words: np.ndarray, where: np.ndarray, first: np.ndarray, many: np.ndarray) -> Iterator[tuple[int, float]]:
        _, words_of, _, item_of, place_of, _ = held.value
        entry = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        where, item = np.repeat(where, many), item_of[entry]
        for number in np.unique(item):
            own, target = item == number, words_of[number]
            ranges = passages(where[own], place_of[entry[own]], len(target), len(words))
            score = max((align(target, words[a:b]) for a, b in ranges if may_align(target, words[a:b])), default=0)
            if score >= LEAST_SCORE:
                yield number, score

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "th", "item_id", "score"])

    return map_rows(docs, "doc_id bigint, th bigint, item_id bigint, score double", work)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, th, item_id, score``: documents that hold an item or an edited copy of it.

    ``th`` is the hash of the text, for rows that share an id. ``score`` is from 0.5 to 1. Words
    are compared in lower case without punctuation; a sign of a script without spaces is a word.
    Items of fewer than eight words match where all their words stand in a row. Items with a null
    id or text or without a word match nothing, neither do null and empty documents; rows and items that
    repeat give repeated pairs once each. Empty tables give no rows. Items of any number are
    handled in blocks of a fixed amount of text, each against all documents.
    """
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("bigint").alias("item_id"), "text"
    )
    items = items.distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("th"), "text")
    out = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        held = make_items([(r["item_id"], r["text"]) for r in own.collect()])
        known = np.unique(held.grams)
        if not len(known) and not held.short:
            continue
        counts, total = document_counts(rows, known) if len(known) else (np.zeros(0, np.int64), 0)
        seeds = chosen_seeds(held, known, counts, total)
        found = aligned(rows, held, seeds)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, th bigint, item_id bigint, score double")
    return out.groupBy("doc_id", "th", "item_id").agg(F.max("score").alias("score"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without those that :func:`contaminated` finds; nulls and columns stay as they are."""
    found = cut(contaminated(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("th").alias("_mark")), "leaks")
    rows = docs.withColumn("_th", text_hash())
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_mark"))
    return rows.join(found.distinct().hint("merge"), same, "left_anti").drop("_th")
