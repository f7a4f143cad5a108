"""Exact substring deduplication with suffix arrays, over documents of any number.

A string of ``LENGTH`` bytes that occurs at several places has the same content around each of
them, so the places can be brought together without sorting all suffixes of the corpus at once:

1. Anchors. The anchor of a window of ``LENGTH`` bytes is the first of its strings of ``CORE``
   bytes with the smallest hash; equal windows have equal anchors at equal places.
2. Contexts. The windows of an anchor are consecutive, and its context is the bytes they cover.
   Anchors whose core occurs once are dropped. Contexts that are equal are counted and become one.
3. Suffix arrays. The different contexts of a core are sorted by two-stage sorting, and windows
   with a common prefix of ``LENGTH`` with a neighbour occur elsewhere. Cores with very many
   different contexts are first split: the windows in two halves, each half by the longer core
   that its windows share.
4. Covered places go back to the documents, which are cut as the input had them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import cut, map_rows, text_of
from tidepost.llm.passages import later_passages
from tidepost.llm.suffixes import common_prefixes, join_texts, suffix_array

LENGTH = 400
CORE = 200
REACH = LENGTH - CORE
PART_BYTES = 1 << 19
#: Bits of a sliding key that hold the place; parts are shorter than two to this power.
PLACE_BITS = np.uint64(21)
#: Different contexts of a core that one suffix array takes; more are split.
GROUP_CONTEXTS = 300
#: Contexts of many cores that a task sorts together.
BLOCK_CONTEXTS = 600
SEEN = 2_000_000

ODD = 0x9E3779B97F4A7C15
BYTE_VALUES = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)], np.uint64)


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Roller:
    """Hashes of all strings of ``CORE`` bytes, by prefix sums modulo 2 to the 64."""

    def __init__(self) -> None:
        self.up, self.down = powers(ODD, 1), powers(ODD, 1)

    def cores(self, codes: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(codes):
            self.up = powers(ODD, len(codes) + 1)
            self.down = powers(pow(ODD, -1, 1 << 64), len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[codes] * self.up[: len(codes)], out=sums[1:])
        out = (sums[CORE:] - sums[:-CORE]) * self.down[: len(codes) - CORE + 1]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(29))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, ~np.uint64(0), np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def anchors_of(data: bytes, bounds: np.ndarray, roller: Roller) -> tuple[np.ndarray, ...]:
    """Places and core hashes of the anchors of texts that stand in a row, ``bounds`` apart, and
    the first and last window of each, relative to it."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none, none
    cores = roller.cores(np.frombuffer(data, np.uint8))
    place = np.arange(len(cores), dtype=np.uint64)
    anchor = sliding_least(cores >> PLACE_BITS << PLACE_BITS | place, REACH + 1)
    anchor = (anchor & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    inside = np.ones(len(anchor), bool)
    for bound in bounds[1:-1]:  # windows do not cross texts
        inside[max(0, bound - LENGTH + 1) : bound] = False
    windows = np.flatnonzero(inside)
    anchor = anchor[windows]
    edge = np.flatnonzero(np.diff(anchor, prepend=-1, append=-1))
    places = anchor[edge[:-1]]
    return places, cores[places], windows[edge[:-1]] - places, windows[edge[1:] - 1] - places


def encoded(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in batch.column(column)]


def parts(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, list[tuple[int, int]]]]:
    """Texts in a row of about ``PART_BYTES``: (bytes, bounds, (text, offset in it) of each).

    A longer text is cut into parts that overlap by one byte less than a window.
    """
    held, owners, size = [], [], 0
    for number, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        step = PART_BYTES
        for at in range(0, len(text) - LENGTH + 1, step):
            part = text[at : at + step + LENGTH - 1]
            held.append(part)
            owners.append((number, at))
            size += len(part)
            if size >= PART_BYTES:
                yield b"".join(held), np.cumsum([0, *map(len, held)]), owners
                held, owners, size = [], [], 0
    if held:
        yield b"".join(held), np.cumsum([0, *map(len, held)]), owners


def signed(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True)


def context_hash(lead: int, data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data, seed=lead + LENGTH) - (1 << 63)


def texts_of(docs: DataFrame, *columns: str) -> DataFrame:
    """Texts with their identity: a hash and the number of bytes."""
    text = text_of()
    return docs.select(
        *columns, text.alias("text"), F.xxhash64(text).alias("th"), F.octet_length(text).cast("bigint").alias("n")
    )


def anchors(docs: DataFrame) -> DataFrame:
    """``core, ctx, th, n, place, first, last``: the anchors of all texts; a task sends equal texts
    twice at most."""
    names = ["core", "ctx", "th", "n", "place", "first", "last"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, seen = Roller(), {}
        for batch in batches:
            texts, ids = [], []
            for text, key in zip(encoded(batch, 0), zip(*(batch.column(i).to_pylist() for i in (1, 2)), strict=True), strict=True):
                if seen.get(key, 0) < 2:
                    texts.append(text)
                    ids.append(key)
                if len(seen) < SEEN or key in seen:
                    seen[key] = seen.get(key, 0) + 1
            hashes = np.array([i[0] for i in ids], np.int64)
            lengths = np.array([i[1] for i in ids], np.int64)
            for data, bounds, owners in parts(texts):
                places, cores, first, last = anchors_of(data, bounds, roller)
                part = np.searchsorted(bounds, places, side="right") - 1
                number = np.array([o[0] for o in owners])[part]
                offsets = places - bounds[part] + np.array([o[1] for o in owners])[part]
                spans = zip(first.tolist(), (places + first).tolist(), (places + last + LENGTH).tolist(), strict=True)
                ctx = [context_hash(lead, data[a:b]) for lead, a, b in spans]
                columns = [cores.view(np.int64), np.array(ctx, np.int64), hashes[number], lengths[number], offsets, first, last]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    rows = texts_of(docs.where(F.octet_length("text") >= LENGTH))
    return map_rows(rows.select("text", "th", "n"), ", ".join(f"{c} bigint" for c in names), work)


def contexts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``core, ctx, lead, data`` for the anchors of ``chosen``; ``lead`` is where the data begin
    relative to the anchor."""
    wanted = F.struct("core", "ctx", "place", "first", "last")
    lists = chosen.groupBy("th", "n").agg(F.collect_list(wanted).alias("wanted"))
    texts = texts_of(docs.where(F.octet_length("text") >= LENGTH))
    joined = texts.join(lists.hint("merge"), ["th", "n"]).select("text", "wanted")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, wanted in zip(encoded(batch, 0), batch.column(1).to_pylist(), strict=True):
                for w in wanted:
                    data = text[w["place"] + w["first"] : w["place"] + w["last"] + LENGTH]
                    rows.append((w["core"], w["ctx"], w["first"], data))
                    if len(rows) >= 10_000:
                        yield rows_batch(rows)
                        rows = []
            yield rows_batch(rows)

    def rows_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["core", "ctx", "lead", "data"])

    found = map_rows(joined, "core bigint, ctx bigint, lead bigint, data binary", work)
    return found.dropDuplicates(["core", "ctx"])


def repeated_windows(groups: np.ndarray, leads: np.ndarray, data: list[bytes], lows: np.ndarray, highs: np.ndarray):
    """For each context the runs of windows (first, last, relative to the anchor) that another
    context of its group has at the same place."""
    begin = np.maximum(lows, leads)
    last = np.minimum(highs, leads + np.array([len(d) for d in data]) - LENGTH)
    wanted = np.maximum(last - leads + 1, 0)
    order = suffix_array(data, wanted)
    _, starts, ends = join_texts(data)
    owner = np.repeat(np.arange(len(data)), ends - starts + 1)[order]
    place = order - starts[owner] + leads[owner]
    run = np.cumsum(common_prefixes(data, order, LENGTH) < LENGTH)
    inside = place >= begin[owner]
    owner, place, run = owner[inside], place[inside], run[inside]
    by = np.lexsort((place, groups[owner], run))
    owner, place, run, group = owner[by], place[by], run[by], groups[owner[by]]
    same = (run[1:] == run[:-1]) & (group[1:] == group[:-1]) & (place[1:] == place[:-1]) if len(run) else np.zeros(0, bool)
    hit = np.zeros(len(run), bool)
    hit[1:] |= same
    hit[:-1] |= same
    owner, place = owner[hit], place[hit]
    by = np.lexsort((place, owner))
    owner, place = owner[by], place[by]
    if not len(owner):
        return []
    edge = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1), [True]]))
    return [(int(owner[a]), int(place[a]), int(place[b - 1])) for a, b in zip(edge[:-1], edge[1:], strict=True)]


def sort_groups(rows: DataFrame) -> DataFrame:
    """``gk, fk, first, last`` of repeated windows; rows ``gk, fk, lead, low, high, data``."""
    blocks = max(1, -(-rows.count() // BLOCK_CONTEXTS))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("gk"), F.lit(blocks)))

    def work(table: pa.Table) -> pa.Table:
        columns = {c: np.asarray(table.column(c)) for c in ("gk", "fk", "lead", "low", "high")}
        data = table.column("data").to_pylist()
        found = repeated_windows(columns["gk"], columns["lead"], data, columns["low"], columns["high"])
        at = np.array([f[0] for f in found], np.int64)
        return pa.table(
            {
                "gk": pa.array(columns["gk"][at]),
                "fk": pa.array(columns["fk"][at]),
                "first": pa.array([f[1] for f in found], pa.int64()),
                "last": pa.array([f[2] for f in found], pa.int64()),
            }
        )

    return dealt.groupBy("block").applyInArrow(work, "gk bigint, fk bigint, first bigint, last bigint")


def halves(rows: DataFrame) -> DataFrame:
    """The windows of each row in two halves, each grouped by the longer core that they share."""
    names = ["core", "ctx", "gk", "fk", "lead", "low", "high", "data"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                middle = (r["low"] + r["high"]) // 2
                for low, high in ((r["low"], middle), (middle + 1, r["high"])):
                    begin = max(low, r["lead"])
                    end = min(high + LENGTH, r["lead"] + len(r["data"]))
                    if low > high or end - begin < LENGTH or begin > high:
                        continue
                    data = r["data"][begin - r["lead"] : end - r["lead"]]
                    shared = data[high - begin : low + LENGTH - begin]
                    gk = signed(xxhash.xxh3_64_digest(b"%d:%d:%d:" % (r["gk"], low, high) + shared))
                    out.append((r["core"], r["ctx"], gk, context_hash(begin, data), begin, low, high, data))
            columns = list(zip(*out, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = ", ".join(f"{c} bigint" for c in names[:7]) + ", data binary"
    return map_rows(rows.select(*names), schema, work)


def covered_windows(rows: DataFrame) -> DataFrame:
    """``core, ctx, first, last``: windows of contexts (``core, ctx, lead, data``) that occur elsewhere.

    A group of few contexts is sorted; a larger one goes on as its halves. Parts that are equal
    are covered as a whole, and one of them stands for all from there on, so what is left of a
    group shrinks where it agrees.
    """
    rows = rows.select(
        "core", "ctx", F.col("core").alias("gk"), F.col("ctx").alias("fk"), "lead",
        F.lit(-REACH).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high"), "data",
    )
    out = []
    while True:
        kinds = rows.groupBy("gk", "fk").agg(F.count("*").alias("copies"))
        kinds = cut(kinds, "context-copies")
        if out:  # contexts themselves are there once
            shared = rows.join(kinds.where("copies > 1").hint("merge"), ["gk", "fk"], "left_semi")
            out.append(
                shared.select(
                    "core", "ctx", F.greatest("low", "lead").alias("first"),
                    F.least(F.col("high"), F.col("lead") + F.octet_length("data") - LENGTH).alias("last"),
                )
            )
        groups = cut(kinds.groupBy("gk").agg(F.count("*").alias("kinds")).where("kinds > 1"), "context-groups")
        marked = rows.dropDuplicates(["gk", "fk"]) if out else rows
        marked = cut(marked.join(groups.hint("merge"), "gk"), "grouped-contexts")
        sortable = marked.where(F.col("kinds") <= GROUP_CONTEXTS)
        found = cut(sort_groups(sortable.drop("kinds")), "repeated-windows")
        sorted_out = sortable.select("core", "ctx", "gk", "fk").join(found.hint("merge"), ["gk", "fk"])
        out.append(sorted_out.select("core", "ctx", "first", "last"))
        large = marked.where(F.col("kinds") > GROUP_CONTEXTS)
        if large.isEmpty():
            break
        rows = cut(halves(large), "half-contexts")
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result.where("last >= first")


def covered_places(docs: DataFrame) -> DataFrame:
    """``th, n, spans``: the byte ranges of each text covered by windows that occur elsewhere."""
    found = cut(anchors(docs), "anchors")
    again = cut(found.groupBy("core").agg(F.count("*").alias("times")).where("times > 1").select("core"), "repeated-cores")
    found = cut(found.join(again.hint("merge"), "core", "left_semi"), "repeated-anchors")
    own = ("th", "n", "place", "first", "last")
    kinds = found.groupBy("core", "ctx").agg(F.count("*").alias("times"), *[F.first(c).alias(c) for c in own])
    kinds = cut(kinds, "context-kinds")
    mixed = cut(kinds.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1").select("core"), "mixed-cores")
    chosen = kinds.join(mixed.hint("merge"), "core", "left_semi").select("core", "ctx", *own)
    windows = covered_windows(cut(contexts(docs, chosen), "contexts"))
    # A context that occurs twice is covered as a whole.
    whole = kinds.where("times > 1").select("core", "ctx", "first", "last")
    windows = cut(windows.unionByName(whole), "covered-windows")
    windows = windows.select("core", "ctx", F.col("first").alias("from"), F.col("last").alias("to"))
    span = F.struct((F.col("place") + F.col("from")).alias("start"), (F.col("place") + F.col("to") + LENGTH).alias("end"))
    spans = found.select("core", "ctx", "th", "n", "place").join(windows.hint("merge"), ["core", "ctx"])
    return spans.groupBy("th", "n").agg(F.collect_set(span).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def cut_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, n_repeated`` per document.

    Every byte of a string of 400 bytes that also starts elsewhere goes, in all places, judged on
    the input. A null text is empty, and texts under 400 bytes stay. Rows that repeat cover each
    other, with any ids. ``kept`` holds the remaining bytes, which may end within a character. An
    empty table gives no rows; other columns are not looked at. ``n_repeated`` counts, apart from all
    that, the bytes of passages of some fifty words that an earlier place has too, which mostly are
    shorter than 400 bytes: see :mod:`passages`.
    """
    marks = cut(covered_places(docs), "covered-places")
    later = cut(later_passages(docs), "later-passages")
    later = later.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "passages").hint("merge")
    rows = texts_of(docs, "doc_id").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    joined = rows.join(marks.hint("merge"), ["th", "n"], "left")
    joined = joined.join(later, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    joined = joined.select("doc_id", "text", "spans", "passages")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "n_repeated"]
        for batch in batches:
            out = []
            for text, spans, later in zip(encoded(batch, 1), *(batch.column(k).to_pylist() for k in (2, 3)), strict=True):
                gone = merged(spans or [])
                ends = [0, *[e for _, e in gone]]
                starts = [*[s for s, _ in gone], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(ends, starts, strict=True))
                out.append((len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept, sum(e - s for s, e in merged(later or []))))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, n_repeated bigint"
    return map_rows(joined, schema, work)
