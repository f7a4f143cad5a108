"""Packing of tokenised documents into sequences by best fit and swap-based local search.

Only piece lengths are packed. Full pieces are sequences as they are; the others are dealt to
groups of bounded size, and each group is packed by best fit and then improved: items move, or
are exchanged one for one or two for one, from the emptiest sequence into fuller ones, so that
the sum of squared fills rises until sequences empty.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import cut, map_rows

#: Pieces that one task packs; more pieces make more groups.
GROUP_PIECES = 16384
#: White-space delimited words whose ids a task remembers; beyond it the memory starts anew.
WORDS_KEPT = 400_000
#: What the tokenizer's white-space class has and ``str.split`` has not, or the other way round.
ODD_SPACE = re.compile("[\x1c-\x1f]")
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


#: Words whose parts (runs of letters, single digits, runs of marks) are looked up on their own.
#: Left out are the apostrophe, which begins contractions, and what begins a special token.
PLAIN = re.compile("[A-Za-z0-9À-ÖØ-öø-ÿ!-&(-/:;=-@\\[-`{-~]+")
PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
LETTERS = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
#: So many plain words are encoded both ways before parts are trusted.
PROBES = 200


class WordIds(dict):
    """Little-endian ids of a white-space delimited word, encoded on first sight.

    Plain words are put together from parts, which repeat far more often than words; whether the
    tokenizer agrees is tried on the first words, and if it does not, words are encoded whole.
    """

    def __init__(self, tokenizer) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in LETTERS})
        self.parts: dict[str, bytes] = {}
        self.probes, self.by_parts = PROBES, True

    def encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= WORDS_KEPT:
                self.parts.clear()
            tokens = self.model.tokenize(part.translate(self.bytes_of))
            ids = self.parts[part] = np.array([t.id for t in tokens], "<u4").tobytes()
        return ids

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        if len(word) >= 64:
            return self.encode(word)
        if self.by_parts and PLAIN.fullmatch(word):
            ids = b"".join(map(self.part, PARTS.findall(word.lower())))
            if self.probes:
                self.probes -= 1
                self.by_parts = ids == self.encode(word)
                ids = self.encode(word)
        else:
            ids = self.encode(word)
        self[word] = ids
        return ids

    def of_text(self, text: str) -> bytes:
        """The tokenizer splits at white space and drops it, so words can be encoded alone."""
        if ODD_SPACE.search(text):
            return self.encode(text)
        return b"".join(map(self.__getitem__, text.split()))


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` for every piece of at most ``capacity`` ids.

    Each document's ids are followed by id 0; a null or empty text is that id alone. Only
    documents of more than ``capacity`` ids are cut. The tokenizer file is read by the driver
    and its content sent along, so executors need no such file.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        content = file.read()
    held = docs.sparkSession.sparkContext.broadcast(content)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        words = WordIds(Tokenizer.from_str(held.value))
        names = ("doc_id", "piece", "start", "length", "ids_crc32")
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = words.of_text(text.as_py() or "") + b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), PIECES, work)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Item numbers by bin: longest first, each into the bin that it fills most."""
    bins, open_bins, free_sizes = [], {}, []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[item]
        at = bisect_left(free_sizes, need)
        if at == len(free_sizes):
            bins.append([])
            free, number = capacity, len(bins) - 1
        else:
            free = free_sizes[at]
            number = open_bins[free].pop()
            if not open_bins[free]:
                del open_bins[free]
                free_sizes.pop(at)
        bins[number].append(item)
        left = free - need
        if left:
            if left not in open_bins:
                open_bins[left] = []
                free_sizes.insert(bisect_left(free_sizes, left), left)
            open_bins[left].append(number)
    return bins


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Local search; it ends at the least possible number of bins or when no exchange helps.

    Items leave the emptiest bin for fuller ones: by a move, or in exchange for one shorter item
    (one for one) or one item shorter than two together (two for one). Each step raises the sum
    of squared fills, so the search ends.
    """
    size = np.asarray(lengths, np.int64)
    fill = np.array([size[b].sum() for b in bins], np.int64)
    home = np.empty(len(size), np.int64)
    for number, items in enumerate(bins):
        home[items] = number
    least = -(-int(size.sum()) // capacity)
    alive = int((fill > 0).sum())

    def step(victim: int) -> bool:
        free = capacity - fill
        free[victim] = 0
        free[fill < fill[victim]] = 0
        free[fill == 0] = 0
        mine = sorted(np.flatnonzero(home == victim), key=lambda i: -size[i])
        for item in mine:
            room = np.where(free >= size[item], free, capacity + 1)
            target = int(room.argmin())
            if room[target] <= capacity:
                move(item, victim, target)
                return True
        slack = free[home]
        for given in [(i,) for i in mine] + [(a, b) for k, a in enumerate(mine) for b in mine[k + 1 :]]:
            gain = int(size[list(given)].sum()) - size
            usable = (gain > 0) & (gain <= slack)
            if usable.any():
                rest = np.where(usable, slack - gain, capacity + 1)
                back = int(rest.argmin())
                target = int(home[back])
                for item in given:
                    move(item, victim, target)
                move(back, target, victim)
                return True
        return False

    def move(item: int, source: int, target: int) -> None:
        home[item] = target
        fill[source] -= size[item]
        fill[target] += size[item]

    stuck = False
    while alive > least and not stuck:
        stuck = True
        order = np.argsort(np.where((fill > 0) & (fill < capacity), fill, capacity + 1), kind="stable")
        for victim in order[: int(((fill > 0) & (fill < capacity)).sum())]:
            if step(int(victim)):
                stuck = False
                break
        alive = int((fill > 0).sum())
    out: dict[int, list[int]] = {}
    for item, number in enumerate(home.tolist()):
        out.setdefault(number, []).append(item)
    return list(out.values())


def pack(pieces: DataFrame, capacity: int = 2048, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (``length`` from 1 to ``capacity``).

    Pieces are dealt to groups by row number, so no key can make a group large. Each group has at
    most one poorly filled sequence. Ids are any numbers, negative for full pieces.
    """
    columns = pieces.columns
    full = pieces.where(F.col("length") >= capacity).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")}
    )
    rest = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_pieces))
    rest = rest.withColumn("_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))

    def work(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_pylist()
        first = table.column("_group")[0].as_py() << 32
        sequence = np.empty(len(lengths), np.int64)
        offset = np.empty(len(lengths), np.int64)
        for number, items in enumerate(improve(best_fit(lengths, capacity), lengths, capacity)):
            at = 0
            for item in items:
                sequence[item], offset[item] = first + number, at
                at += lengths[item]
        out = table.drop_columns(["_group"])
        return out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id bigint, offset bigint"
    packed = rest.groupBy("_group").applyInArrow(work, schema)
    return full.select(*columns, "sequence_id", "offset").unionByName(packed)


def packed_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """Every piece of every document with its place: see :func:`token_pieces` and :func:`pack`.

    Null and empty texts are pieces of one id; rows that repeat are packed as often as they come;
    an empty table gives no rows; other columns are not looked at.
    """
    return pack(cut(token_pieces(docs, tokenizer_path, capacity), "pieces"), capacity)
