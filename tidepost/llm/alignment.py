"""Alignment of two tokenizers' vocabularies over a corpus, by inverted pair bitmaps.

Byte offsets at which tokens of both tokenizers end cut a text into groups, and the tokens of a
group link, each of one side with each of the other. For every pair of ids that link, the documents
that hold it are a bitmap of documents, in containers of one block of documents each: 16-bit
slots, or bits where these are shorter. How often a document holds a pair stands in planes, one
bitmap for each binary digit of the number less one.

The container of a block is merged in the task that reads the block. Containers of different blocks
have no document in common, so that the union of a pair's bitmaps is their list, and its number of
documents the sum of their bits. With these numbers the postings give each document its scores:
they are joined with the numbers of the pairs, and the containers of a block meet its documents.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import cut, in_slices, map_rows

#: What a byte-level tokenizer takes as one word (fixed by the format).
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A single space between other signs: neither tokenizer has a token across its left side.
WORD_START = re.compile(r"(?<=\S)(?= \S)")
SPACE_MARK = "▁"
#: Characters after which a long text is encoded in a further part.
PART_CHARS = 1 << 20
#: Documents and postings of a block. Slots have 16 bits.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 16, 2_000_000
#: From so many slots on, a container is a bitmap.
DENSE = 4096
LARGE_GROUP = 256
WHOLE = -1
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
DOC_FIELDS = [("slot", pa.int32()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string())]
POST_FIELDS = [("a", pa.int32()), ("b", pa.int32()), ("plane", pa.int32()), ("docs", pa.int64()), ("slots", pa.binary())]
INDEX_SCHEMA = (
    "block bigint, slot int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "a int, b int, plane int, docs bigint, slots binary"
)


def byte_level_bytes(token: str) -> bytes:
    """Bytes of an entry of a byte-level vocabulary, which writes some bytes as other signs."""
    return bytes(_byte_signs()[c] for c in token)


@functools.cache
def _byte_signs() -> dict[str, int]:
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[1:-1], 16)]) if is_byte else piece.replace(SPACE_MARK, " ").encode()


class Encoders:
    """Both tokenizers with the bytes of every id; special tokens are plain text."""

    def __init__(self, byte_level: str, pieces: bytes) -> None:
        import sentencepiece
        import tiktoken

        content = json.loads(byte_level)
        special = {t["content"] for t in content["added_tokens"] if t["special"]}
        # A merge that was learnt earlier has the smaller id, which is all that ranks are.
        ranks = {byte_level_bytes(t): i for t, i in content["model"]["vocab"].items() if t not in special}
        self.a = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [piece_bytes(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        #: Decimal ids followed by what separates them: one table for both, see ``written``.
        self.texts = [f"{i}{s}" for i in range(len(self.a_bytes)) for s in ",|"] + [f"{i}{s}" for i in range(len(self.b_bytes)) for s in ",;"]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and ``text`` by each tokenizer; none where they do not spell it."""
        none = np.zeros(0, np.int64)
        if not text or SPACE_MARK in text:  # which the second one reads as a space
            return none, none
        text, at, a, b = " " + text, 0, [], []
        while at < len(text):
            cut_at = WORD_START.search(text, at + PART_CHARS) if len(text) - at > PART_CHARS else None
            part = text[at : cut_at.end() if cut_at else len(text)]
            ids, others = self.a.encode_ordinary(part), self.b.encode(part[1:])
            plain = part.encode("utf-8", "surrogatepass")
            if any(b"".join(map(x.__getitem__, i)) != plain for x, i in ((self.a_bytes, ids), (self.b_bytes, others))):
                return none, none
            a.append(np.array(ids, np.int64))
            b.append(np.array(others, np.int64))
            at += len(part)
        return np.concatenate(a), np.concatenate(b)


@functools.lru_cache(maxsize=1)
def encoders(byte_level: str, pieces: bytes) -> Encoders:
    return Encoders(byte_level, pieces)


class Aligned:
    """Groups and links of a slice of texts, all tokens in a row."""

    def __init__(self, encoded: list[tuple[np.ndarray, np.ndarray]], known: Encoders) -> None:
        self.known = known
        self.a, self.b = (np.concatenate([e[k] for e in encoded]) for k in (0, 1))
        self.a_bounds, self.b_bounds = (np.cumsum([0, *(len(e[k]) for e in encoded)]) for k in (0, 1))
        a_ends, b_ends = np.cumsum(known.a_sizes[self.a]), np.cumsum(known.b_sizes[self.b])
        marks = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 1, np.int8)
        marks[a_ends] = 1
        marks[b_ends] += 2
        before = np.cumsum(marks == 3)  # groups that end at a byte or before it
        self.groups = int(before[-1])
        self.a_group, self.b_group = before[a_ends - 1], before[b_ends - 1]
        self.n_a, self.n_b = (np.bincount(g, minlength=self.groups) for g in (self.a_group, self.b_group))
        # Both tokenizers end where a text does, so texts have whole groups.
        self.bounds = before[np.concatenate([[0], a_ends])[self.a_bounds]]

    def counts(self) -> list[np.ndarray]:
        links = np.concatenate([[0], np.cumsum(self.n_a * self.n_b)])
        return [np.diff(x) for x in (self.a_bounds, self.b_bounds, self.bounds, links[self.bounds])]

    def written(self) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        a_before, b_before = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        order = np.zeros(len(self.a) + len(self.b), np.int64)
        last_a = np.diff(self.a_group, append=-1) != 0
        last_b = np.diff(self.b_group, append=-1) != 0
        order[np.arange(len(self.a)) + b_before[self.a_group]] = 2 * self.a + last_a
        order[np.arange(len(self.b)) + a_before[self.b_group + 1]] = 2 * (len(self.known.a_bytes) + self.b) + last_b
        bounds = self.a_bounds + self.b_bounds
        return ["".join(map(self.known.texts.__getitem__, order[x:y].tolist()))[:-1] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]

    def postings(self, first_slot: int) -> tuple[np.ndarray, np.ndarray]:
        """``pair << 16 | slot``, sorted, and how often the text holds the pair."""
        a_first, b_first = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        large = self.n_a * self.n_b > LARGE_GROUP
        small = ~large[self.a_group]
        many = self.n_b[self.a_group[small]]
        a = np.repeat(self.a[small], many)
        start = np.repeat(b_first[self.a_group[small]] - np.cumsum(many) + many, many)
        b = self.b[start + np.arange(len(a))]
        owner = np.repeat(np.searchsorted(self.a_bounds, np.flatnonzero(small), side="right") - 1, many)
        keys, times = [self.key(a, b, first_slot + owner)], [np.ones(len(a), np.int64)]
        for g in np.flatnonzero(large):  # such a group counts its ids before it pairs them
            x, n_x = np.unique(self.a[a_first[g] : a_first[g + 1]], return_counts=True)
            y, n_y = np.unique(self.b[b_first[g] : b_first[g + 1]], return_counts=True)
            slot = first_slot + np.searchsorted(self.a_bounds, a_first[g], side="right") - 1
            keys.append(self.key(np.repeat(x, len(y)), np.tile(y, len(x)), slot))
            times.append(np.outer(n_x, n_y).ravel())
        return summed(np.concatenate(keys), np.concatenate(times))

    @staticmethod
    def key(a: np.ndarray, b: np.ndarray, slot: np.ndarray | int) -> np.ndarray:
        return (a << 40) | (b << 16) | slot


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def container(slots: np.ndarray) -> bytes:
    """Sorted slots as 16-bit numbers, or as bits where that is shorter."""
    if len(slots) < DENSE:
        return slots.astype("<u2").tobytes()
    bits = np.zeros(BLOCK_DOCS, np.uint8)
    bits[slots] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def slots_of(held: bytes) -> np.ndarray:
    if len(held) < 2 * DENSE:
        return np.frombuffer(held, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(held, np.uint8), bitorder="little"))


def plane_rows(keys: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Plane, its pairs, bounds of their slots, slots: all documents first, then each binary digit."""

    def rows(plane: int, keys: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        pair = keys >> 16
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        return plane, pair[first], np.append(first, len(pair)), keys & 0xFFFF

    yield rows(WHOLE, keys)
    more, plane = times - 1, 0
    while (more >> plane).any():
        yield rows(plane, keys[(more >> plane & 1) > 0])
        plane += 1


def post_batches(block: int, keys: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    for plane, pair, bounds, slots in plane_rows(keys, times):
        packed = slots.astype("<u2").tobytes()
        for at in range(0, len(pair), 20_000):
            edges = bounds[at : at + 20_001]
            parts = [
                container(slots[x:y]) if y - x >= DENSE else packed[2 * x : 2 * y]
                for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
            ]
            some = pair[at : at + 20_000]
            columns = [some >> 24, some & 0xFFFFFF, np.full(len(some), plane), np.diff(edges), parts]
            yield index_batch(block, POST_FIELDS, columns)


def index_batch(block: int, fields: list[tuple[str, pa.DataType]], columns: list) -> pa.RecordBatch:
    """A batch of the index with nulls in the columns of its other kind of row."""
    arrays = {name: pa.array(c, kind) for (name, kind), c in zip(fields, columns, strict=True)}
    n = len(columns[0])
    every = {"block": pa.array(np.full(n, block), pa.int64())}
    every |= {name: arrays.get(name, pa.nulls(n, kind)) for name, kind in (*DOC_FIELDS, *POST_FIELDS)}
    return pa.RecordBatch.from_arrays(list(every.values()), list(every))


def pair_index(docs: DataFrame, byte_level: str, pieces: bytes, block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Rows of documents (``slot`` not null) and of pairs (``plane`` not null), by block."""
    held = docs.sparkSession.sparkContext.broadcast((byte_level, pieces))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoders(*held.value)
        block, slot, parts, postings = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = batch.column(0)
            for start, end in in_slices(texts):
                if slot + end - start > block_docs or postings > block_postings:
                    yield from post_batches(block, *summed(*map(np.concatenate, zip(*parts, strict=True))))
                    block, slot, parts, postings = block + 1, 0, [], 0
                found = Aligned([known.encode(t) for t in texts[start:end]], known)
                parts.append(found.postings(slot))
                postings += len(parts[-1][0])
                digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in found.written()]
                yield index_batch(
                    block, DOC_FIELDS, [np.arange(slot, slot + end - start), ids.slice(start, end - start), *found.counts(), digests]
                )
                slot += end - start
        if parts:
            yield from post_batches(block, *summed(*map(np.concatenate, zip(*parts, strict=True))))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_rows(rows, INDEX_SCHEMA, work)


def pair_numbers(index: DataFrame) -> DataFrame:
    """``a, b, n_docs, n_links``: how many documents hold a pair, and how many links they have."""
    weight = F.when(F.col("plane") == WHOLE, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane)"))
    whole = F.when(F.col("plane") == WHOLE, F.col("docs"))
    return index.where("plane IS NOT NULL").groupBy("a", "b").agg(F.sum(whole).alias("n_docs"), F.sum(F.col("docs") * weight).alias("n_links"))


def scored_pairs(numbers: DataFrame) -> DataFrame:
    """``a, b, n_docs, best``: whether no other pair of ``a`` is in more documents."""
    most = numbers.groupBy("a").agg(F.max("n_docs").alias("most"))
    return numbers.join(most, "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_level: str, pieces: bytes, block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``.

    ``byte_level`` is the JSON file of a byte-level tokenizer, ``pieces`` the model of one with
    pieces and byte fallback, both as contents. Each reads a space and the text. ``n_best`` counts
    links that no other pair of the same first id beats in documents, ``count_sum`` sums the number
    of documents over links. A null or empty text, or one that a tokenizer does not spell, has no
    tokens: zeros and an empty digest. Rows that repeat or share an id are documents of their own;
    an empty table gives no rows; other columns are not looked at. ``block_docs`` (65,536 at most) and
    ``block_postings`` end a block after the slice of about a megabyte that reaches them.
    """
    index = cut(pair_index(docs, byte_level, pieces, block_docs, block_postings), "pair-index")
    scores = cut(scored_pairs(cut(pair_numbers(index), "pair-numbers")), "scored-pairs")
    postings = index.where("plane IS NOT NULL").select("block", "a", "b", "plane", "slots")
    postings = postings.join(scores.hint("merge"), ["a", "b"]).select(F.col("block").alias("block"), "plane", "slots", "n_docs", "best")
    documents = index.where("slot IS NOT NULL").select("block", *(name for name, _ in DOC_FIELDS))

    def work(rows: pa.Table, posts: pa.Table) -> pa.Table:
        best, total = np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
        if posts.num_rows:
            slots = [slots_of(s) for s in posts.column("slots").to_pylist()]
            plane = np.asarray(posts.column("plane")).astype(np.int64)
            weight = np.left_shift(1, np.maximum(plane, 0))
            many = np.array([len(s) for s in slots])
            at = np.concatenate(slots)
            np.add.at(best, at, np.repeat(weight * np.asarray(posts.column("best")), many))
            np.add.at(total, at, np.repeat(weight * np.asarray(posts.column("n_docs")), many))
        slot = np.asarray(rows.column("slot"))
        out = {"doc_id": rows.column("doc_id")} | {c: rows.column(c) for c in COUNTS}
        out |= {"n_best": pa.array(best[slot]), "count_sum": pa.array(total[slot]), "groups_sha256": rows.column("groups_sha256")}
        return pa.table(out)

    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in (*COUNTS, "n_best", "count_sum")) + ", groups_sha256 string"
    return documents.groupBy("block").cogroup(postings.groupBy("block")).applyInArrow(work, schema)
