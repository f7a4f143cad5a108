"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Equal sets of shingles are one row of the matrix. The shingles of a row are ordered, frequent ones
last, and two rows with a Jaccard similarity of at least 3/4 share one of the first
``n - ceil(3n/4) + 1`` of each (prefix bound), so that the product runs over these columns only,
in blocks of columns. Overlap counts are summed over the blocks, and a pair goes when its count and
all columns that were not multiplied are fewer than its sizes ask for. Parity sketches, whose
distance never exceeds that of the sets, reject most of the others, and whole sets decide.

Only components of the links are asked for. Columns that many rows share are not multiplied out:
their rows are tested against one row, and after that only across components, in chunks of rows of
neighbouring sizes, and two chunks give fewer links than they have components.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import cut, in_slices, map_rows, text_hash
from tidepost.llm.components import components
from tidepost.llm.hashing import M1, WHITE_SPACE, mixed, ngrams, words_by_text

WORDS = 5
#: Columns of so many rows or more are frequent; there are at most ``FREQUENT_CELLS`` of them, as
#: the order of columns (which no result depends on) is known to every task.
FREQUENT = 64
FREQUENT_CELLS = 1 << 20
#: Matrix entries in a block of columns, on average, and pairs of a block that are held unsummed.
BLOCK_ENTRIES, BLOCK_PAIRS = 200_000, 500_000
#: Bytes of text to a block of column counts.
COUNT_BYTES = 8 << 20
#: Shingles that a task holds before it gives them on, and sets that it remembers (they save work only).
FLUSH, SEEN = 500_000, 100_000
#: Rows of a frequent column, and their shingles, that a task compares with as many others.
CHUNK_ROWS, CHUNK_SHINGLES = 4096, 1_000_000
PAIR_COLUMNS, PLACE_COLUMNS = ("a", "b", "n_a", "n_b", "rest", "overlap"), ("tok", "sid", "n")
MATRIX_COLUMNS = ["doc_id", "th", "n", "sid", "sketch", "block", "cells"]


def least_overlap(n):
    """The least overlap of a set of ``n`` with any set it links to."""
    return (3 * n + 3) // 4


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray]]:
    """(doc_id, th) and sorted distinct shingle hashes of each document of (doc_id, text, th)."""
    for batch in batches:
        ids = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True))
        sizes = [range(n or 0) for n in pc.binary_length(batch.column(1)).to_pylist()]
        for start, end in in_slices(sizes):
            texts = batch.column(1).slice(start, end - start).cast(pa.binary()).to_pylist()
            words, bounds = words_by_text([(t or b"").lower() for t in texts], WHITE_SPACE)
            grams = ngrams(words, WORDS)
            for i in range(start, end):
                a, b = bounds[i - start], bounds[i - start + 1]
                if b - a >= WORDS:
                    yield ids[i], np.unique(grams[a : b - WORDS + 1])
                else:  # a short text is one shingle; other seeds for other numbers of words
                    whole = np.concatenate([words[a:b], np.arange(WORDS - (b - a), dtype=np.uint64)])
                    yield ids[i], ngrams(whole, WORDS) if b > a else np.zeros(0, np.uint64)


def set_id(shingles: np.ndarray) -> int:
    return int(np.frombuffer(xxhash.xxh3_64_digest(shingles.tobytes()), "<i8")[0])


def sketch(shingles: np.ndarray) -> bytes:
    """Parity of the shingles in each of at least four times as many cells as there are shingles.

    With so many cells few differing shingles share one, so the bound is close.
    """
    bits = max(64, 1 << math.ceil(math.log2(max(1, 4 * len(shingles)))))
    cells = (mixed(shingles * M1) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(cells, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Cells in which two sketches differ: at most the number of shingles in one set only."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def folded(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches as rows of ``width`` 64-bit words; wider ones are folded, which keeps the bound."""
    out = np.zeros((len(sketches), width), np.uint64)
    for row, held in zip(out, sketches, strict=True):
        row[:] = np.bitwise_xor.reduce(np.frombuffer(held, np.uint64).reshape(-1, width), axis=0)
    return out


def may_link(n_a, n_b, different):
    """Whether sets of these sizes with so many differing shingles, or more, can link."""
    # overlap = (a + b - d) / 2 and union = (a + b + d) / 2; 4 overlap >= 3 union.
    return 7 * different <= n_a + n_b


def encode_counts(cells: np.ndarray, bits: int) -> pa.RecordBatch:
    """Cells (32-bit column hashes) sorted and packed by their first ``bits`` bits."""
    cells = np.sort(cells)
    bounds = np.searchsorted(cells, np.arange(0, (1 << bits) + 1, dtype=np.uint64) << np.uint64(32 - bits))
    blocks = np.flatnonzero(np.diff(bounds))
    packed = [zlib.compress(np.diff(cells[bounds[b] : bounds[b + 1]], prepend=np.uint32(0)).tobytes(), 1) for b in blocks]
    n = len(blocks)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [none, none, none, none, pa.nulls(n, pa.binary()), pa.array(blocks.astype(np.int32)), pa.array(packed, pa.binary())],
        MATRIX_COLUMNS,
    )


def matrix_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, th, n, sid, sketch`` per document, and ``block, cells``: its columns for counting."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(20, max(2, math.ceil(math.log2(max(1, total / COUNT_BYTES)))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, cells, held = [], [], 0
        for row, shingles in shingle_sets(batches):
            n = len(shingles)
            rows.append((*row, n, set_id(shingles) if n else None, sketch(shingles) if n else None))
            cells.append((shingles >> np.uint64(32)).astype(np.uint32))
            held += n
            if held > FLUSH:
                yield row_batch(rows)
                yield encode_counts(np.concatenate(cells), bits)
                rows, cells, held = [], [], 0
        yield row_batch(rows)
        if held:
            yield encode_counts(np.concatenate(cells), bits)

    def row_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        nulls = [pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())]
        return pa.RecordBatch.from_arrays([*arrays, *nulls], MATRIX_COLUMNS)

    return map_rows(docs, "doc_id bigint, th bigint, n bigint, sid bigint, sketch binary, block int, cells binary", work)


def frequent_cells(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cells of frequent columns and the binary logarithm of their counts."""

    def work(table: pa.Table) -> pa.Table:
        parts = [np.cumsum(np.frombuffer(zlib.decompress(c.as_py()), np.uint32), dtype=np.uint32) for c in table.column("cells")]
        cells, many = np.unique(np.concatenate(parts), return_counts=True)
        often = many >= FREQUENT
        return pa.table({"cell": pa.array(cells[often].astype(np.int64)), "n": pa.array(many[often].astype(np.int64))})

    found = cut(counts.groupBy("block").applyInArrow(work, "cell bigint, n bigint"), "frequent-columns")
    level = F.floor(F.log2("n")).cast("int").alias("level")
    many = sorted(((r["level"], r["count"]) for r in found.groupBy(level).count().collect()), reverse=True)
    lowest, held = 64, 0
    for step, count in many:
        if held + count > FREQUENT_CELLS:
            break
        lowest, held = step, held + count
    kept = found.select("cell", level).where(F.col("level") >= lowest).orderBy("cell").toArrow()
    return np.asarray(kept.column("cell")).astype(np.uint32), np.asarray(kept.column("level")).astype(np.int8)


def prefix_entries(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], blocks: int) -> DataFrame:
    """Matrix entries within the prefix bound, packed: ``block, tok, sid, n, rest``.

    Entries of frequent columns have block -1; ``rest`` counts the columns of a row that have no
    block. Sets that a task remembers are not sent again.
    """
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, levels = held.value
        seen: set[int] = set()
        rare, often, entries = [], [], 0
        for _, shingles in shingle_sets(batches):
            n = len(shingles)
            sid = set_id(shingles)
            if not n or sid in seen:
                continue
            if len(seen) < SEEN:
                seen.add(sid)
            level = np.zeros(n, np.int8)
            if len(cells):
                cell = (shingles >> np.uint64(32)).astype(np.uint32)
                at = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
                level = np.where(cells[at] == cell, levels[at], 0)
            first = np.argsort(level, kind="stable")[: n - least_overlap(n) + 1]
            chosen, known = shingles[first], level[first] > 0
            rest = n - int((~known).sum())
            rare.append((chosen[~known], sid, n, rest))
            if known.any():
                often.append((chosen[known], sid, n, rest))
            entries += len(first)
            if entries > FLUSH:
                yield from flush(rare, often)
                rare, often, entries = [], [], 0
        yield from flush(rare, often)

    def spread(rows: list[tuple]) -> tuple[np.ndarray, ...]:
        many = [len(row[0]) for row in rows]
        tok = np.concatenate([np.zeros(0, np.uint64), *[row[0] for row in rows]])
        kinds = (np.int64, np.int32, np.int32)
        return tok, *(np.repeat(np.array([row[k] for row in rows], kind), many) for k, kind in enumerate(kinds, 1))

    def flush(rare: list[tuple], often: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = spread(rare)
        block = (columns[0] % np.uint64(blocks)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        columns, block = [c[order] for c in columns], block[order]
        edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1)) if len(block) else []
        parts = [(int(block[a]), *(c[a:b] for c in columns)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        columns = spread(often)
        parts += [(-1, *(c[a : a + 50_000] for c in columns)) for a in range(0, len(columns[0]), 50_000)]
        for at in range(0, len(parts), 64):
            some = parts[at : at + 64]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p[0] for p in some], pa.int32()),
                    *[pa.array([p[k].tobytes() for p in some], pa.binary()) for k in (1, 2, 3, 4)],
                ],
                ["block", "tok", "sid", "n", "rest"],
            )

    return map_rows(docs, "block int, tok binary, sid binary, n binary, rest binary", work)


def unpacked(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, ...]:
    def one(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    return one("tok", "<u8"), one("sid", "<i8"), one("n", "<i4"), one("rest", "<i4")


def counted(rows: np.ndarray) -> np.ndarray:
    """Pairs summed: rows (a, b, n_a, n_b, rest, overlap), each pair once."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    first = np.flatnonzero(np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1))) if len(rows) else np.zeros(0, np.int64)
    out = rows[first]
    if len(first):
        out[:, 5] = np.add.reduceat(rows[:, 5], first)
    return out


def pairs_in_columns(tok: np.ndarray, sid: np.ndarray, n: np.ndarray, rest: np.ndarray, frequent: int) -> tuple[np.ndarray, np.ndarray]:
    """The product of a block with itself: pairs (a, b, n_a, n_b, rest, overlap) with a < b; and
    places of a row (tok, sid, n) in columns of ``frequent`` rows or more, which are not multiplied.

    Columns are taken together by their number of rows; sizes that exclude a link are left out.
    ``rest`` is the larger number of columns that no block has.
    """
    order = np.lexsort((sid, tok))
    tok, sid, n, rest = tok[order], sid[order], n[order], rest[order]
    fresh = np.ones(len(tok), bool)
    fresh[1:] = (tok[1:] != tok[:-1]) | (sid[1:] != sid[:-1])
    tok, sid, n, rest = tok[fresh], sid[fresh], n[fresh], rest[fresh]
    first = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]])) if len(tok) else np.zeros(0, np.int64)
    many = np.diff(np.append(first, len(tok)))
    found, held = [np.zeros((0, 6), np.int64)], 0
    for rows in np.unique(many[(many > 1) & (many < frequent)]):
        left, right = np.triu_indices(rows, 1)
        starts = first[many == rows]
        step = max(1, BLOCK_PAIRS // len(left))
        for at in range(0, len(starts), step):
            a = (starts[at : at + step, None] + left).ravel()
            b = (starts[at : at + step, None] + right).ravel()
            near = 4 * np.minimum(n[a], n[b]) >= 3 * np.maximum(n[a], n[b])
            a, b = a[near], b[near]
            found.append(np.stack([sid[a], sid[b], n[a], n[b], np.maximum(rest[a], rest[b]), np.ones(len(a), np.int64)], axis=1))
            held += len(a)
            if held > BLOCK_PAIRS:
                found = [counted(np.concatenate(found))]
                held = 0
    dense = np.repeat(many >= frequent, many)
    return counted(np.concatenate(found)), np.stack([tok[dense].view(np.int64), sid[dense], n[dense].astype(np.int64)], axis=1)


def enough_overlap(n_a, n_b, overlap, rest):
    """Whether a pair may still link: links need 7 * overlap >= 3 * (n_a + n_b), and the count misses
    at most ``rest`` columns."""
    return 7 * (overlap + rest) >= 3 * (n_a + n_b)


def rare_pairs(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` that the overlaps summed over all blocks allow, and ``tok, sid, n``: places in
    columns of ``FREQUENT`` rows or more that the table of frequent columns did not hold.

    Of two rows, the one whose multiplied columns end first (in the order of columns) has its shared
    ones among them counted, so that the count misses no more than its other columns.
    """
    frequent = FREQUENT

    def work(table: pa.Table) -> pa.Table:
        pairs, dense = pairs_in_columns(*unpacked(table), frequent)
        nulls = [pa.nulls(len(pairs), pa.int64()), pa.nulls(len(dense), pa.int64())]
        columns = {c: pa.chunked_array([pa.array(pairs[:, k]), nulls[1]]) for k, c in enumerate(PAIR_COLUMNS)}
        columns |= {c: pa.chunked_array([nulls[0], pa.array(dense[:, k])]) for k, c in enumerate(PLACE_COLUMNS)}
        return pa.table(columns)

    schema = ", ".join(f"{c} bigint" for c in (*PAIR_COLUMNS, *PLACE_COLUMNS))
    product = cut(entries.groupBy("block").applyInArrow(work, schema), "block-products")
    pairs = product.where("a IS NOT NULL").groupBy("a", "b").agg(
        F.sum("overlap").alias("overlap"), *(F.first(c).alias(c) for c in ("n_a", "n_b", "rest"))
    )
    places = product.where("tok IS NOT NULL").select(*PLACE_COLUMNS)
    # What a row has in such columns is not in the counts either.
    if not places.isEmpty():
        missed = cut(places.groupBy("sid").agg(F.count("*").alias("missed")), "missed-columns")
        for side in ("a", "b"):
            own = missed.select(F.col("sid").alias(side), F.col("missed").alias(f"{side}_missed"))
            pairs = pairs.join(own, side, "left")
        pairs = pairs.withColumn("rest", F.col("rest") + F.greatest(F.coalesce("a_missed", F.lit(0)), F.coalesce("b_missed", F.lit(0))))
    return pairs.where(enough_overlap(F.col("n_a"), F.col("n_b"), F.col("overlap"), F.col("rest"))).select("a", "b"), places


def frequent_entries(entries: DataFrame) -> DataFrame:
    """``tok, sid, n``: the entries of frequent columns that more than one row has."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tok, sid, n, _ = unpacked(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tok.view(np.int64)), pa.array(sid), pa.array(n.astype(np.int64))], ["tok", "sid", "n"]
            )

    return map_rows(entries.select("tok", "sid", "n", "rest"), "tok bigint, sid bigint, n bigint", work)


def star_pairs(often: DataFrame) -> DataFrame:
    """Each row of a frequent column with one row of the column: ``a, b``."""
    # Spark splits a hot key only between plain exchanges, so what is joined is written first.
    pivots = cut(often.groupBy("tok").agg(F.min("sid").alias("pivot")), "pivots")
    pairs = often.join(pivots.hint("merge"), "tok").where("sid != pivot")
    return pairs.select(F.least("sid", "pivot").alias("a"), F.greatest("sid", "pivot").alias("b")).distinct()


def small_sketches(nodes: DataFrame) -> DataFrame:
    """``sid, n, sketch`` with sketches folded to about as many cells as shingles: they travel with
    every candidate pair, the close ones only with rows of frequent columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            small = [folded([held], max(1, len(held) // 32))[0].tobytes() for held in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(small, pa.binary())], ["sid", "n", "sketch"])

    return map_rows(nodes.select("sid", "n", "sketch"), "sid bigint, n bigint, sketch binary", work)


def with_sketches(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that size and sketch leave possible."""
    a = sketches.select(F.col("sid").alias("a"), F.col("n").alias("x_n"), F.col("sketch").alias("x"))
    b = sketches.select(F.col("sid").alias("b"), F.col("n").alias("y_n"), F.col("sketch").alias("y"))
    joined = pairs.select("a", "b").join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    joined = joined.where(4 * F.least("x_n", "y_n") >= 3 * F.greatest("x_n", "y_n"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (np.asarray(batch.column(i)) for i in (2, 4))
            x, y = batch.column(3).to_pylist(), batch.column(5).to_pylist()
            apart = np.array([differing(i, j) for i, j in zip(x, y, strict=True)], np.int64)
            left = pa.array(may_link(n_a, n_b, apart), pa.bool_())
            yield batch.select([0, 1]).filter(left)

    return map_rows(joined.select("a", "b", "x_n", "x", "y_n", "y"), "a bigint, b bigint", work)


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``sid, shingles`` for documents ``sid, doc_id`` of ``wanted``, read from their texts."""
    rows = docs.join(wanted.select(F.col("doc_id").alias("_id")).hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sids, sets, held = [], [], 0
        for _, shingles in shingle_sets(batches):
            if len(shingles):
                sids.append(set_id(shingles))
                sets.append(shingles.tobytes())
                held += len(shingles)
            if held > FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(sets, pa.binary())], ["sid", "shingles"])
                sids, sets, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(sets, pa.binary())], ["sid", "shingles"])

    found = map_rows(rows.select("doc_id", "text", "th"), "sid bigint, shingles binary", work)
    return found.join(wanted.select("sid"), "sid", "left_semi").groupBy("sid").agg(F.first("shingles").alias("shingles"))


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= 75 * (len(x) + len(y) - both)


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose whole sets link."""
    a = sets.select(F.col("sid").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("sid").alias("b"), F.col("shingles").alias("y"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(batch.column(2), batch.column(3), strict=True)
            keep = [linked(*(np.frombuffer(s.as_buffer(), np.uint64) for s in both)) for both in sets]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.select("a", "b").join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    return map_rows(joined.select("a", "b", "x", "y"), "a bigint, b bigint", work)


def labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with different labels; a row without a label is its own."""
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    joined = pairs.select("a", "b").join(a, "a", "left").join(b, "b", "left")
    return joined.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")


def size_band(n):
    """Sets that link have sizes in the same band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / math.log(4 / 3) + 1e-9).cast("int")


def meetings(often: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Which rows of frequent columns have to meet: ``tok, band, i, j, sid, n, label``, twice.

    A column is dealt by bands of size, rows of a band together with those of the next; a band that has
    no row of its own is left to the next. There rows
    outside the largest component (the second table) meet all rows (the first one), in chunks
    ``i`` of all and ``j`` of the others; what is within one component is left out.
    """
    marks = labels.select(F.col("node").alias("sid"), "label")
    rows = often.join(marks, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    band = size_band(F.col("n"))
    rows = rows.select("tok", "sid", "n", "label", F.explode(F.array(band - 1, band)).alias("band"))
    own = F.max(size_band(F.col("n")) == F.col("band")).alias("own")
    parts = rows.groupBy("tok", "band", "label").agg(F.count("*").alias("m"), F.max("n").alias("longest"), own)
    main = parts.groupBy("tok", "band").agg(
        F.count("*").alias("k"), F.sum("m").alias("all"), F.max("m").alias("most"), F.max("longest").alias("longest"),
        F.max_by("label", F.struct("m", "label")).alias("main"), F.max("own").alias("own"),
    )
    main = cut(main.where("k > 1 AND own").drop("own"), "main-components")
    rows = cut(rows.join(main.hint("merge"), ["tok", "band"]), "meeting-rows")
    size = F.greatest(F.lit(1), F.least(F.lit(CHUNK_ROWS), F.floor(F.lit(CHUNK_SHINGLES) / F.col("longest"))))
    chunks = F.ceil(F.col("all") / size).cast("int")
    minor_chunks = F.ceil((F.col("all") - F.col("most")) / size).cast("int")
    own = F.xxhash64("sid", "tok")
    columns = [F.col(c).alias(c) for c in ("tok", "band", "sid", "n", "label")]
    every = rows.select(*columns, F.pmod(own, chunks).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), minor_chunks - 1)).alias("j"))
    minor = rows.where("label != main").select(
        *columns, F.explode(F.sequence(F.lit(0), chunks - 1)).alias("i"), F.pmod(own, minor_chunks).cast("int").alias("j")
    )
    return every, minor


def near_places(left: pa.Table, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in ``right`` and ``left`` whose labels differ and whose sketches may link, and the
    distance of these. Sizes are within two bands, so that folding keeps two cells for a shingle."""
    sketches = [t.column("sketch").to_pylist() for t in (left, right)]
    width = min(len(held) for part in sketches for held in part) // 8
    x, y = (folded(part, width) for part in sketches)
    n, label = (np.asarray(left.column(c)) for c in ("n", "label"))
    own_n, own_label = (np.asarray(right.column(c)) for c in ("n", "label"))
    step = max(1, 2_000_000 // (len(x) * width))
    for at in range(0, len(y), step):
        part = slice(at, at + step)
        apart = np.bitwise_count(x[None, :, :] ^ y[part, None, :]).sum(2, dtype=np.int64)
        m = own_n[part, None]
        near = (4 * np.minimum(n, m) >= 3 * np.maximum(n, m)) & (label != own_label[part, None]) & may_link(n, m, apart)
        row, place = np.nonzero(near)
        yield row + at, place, apart[row, place]


def one_per_component(row: np.ndarray, label: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first by ``rank`` of each row and label."""
    order = np.lexsort((rank, label, row))
    row, label = row[order], label[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (label[1:] != label[:-1])
    return order[fresh]


class Joined:
    """Components of two chunks that links found in the task have joined."""

    def __init__(self, *labels: np.ndarray) -> None:
        self.labels = np.unique(np.concatenate(labels))
        self.parent = list(range(len(self.labels)))

    def places(self, labels: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.labels, labels)

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.parent))], np.int64)

    def join(self, x: int, y: int) -> bool:
        """Whether they were apart."""
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def nearest_forest(left: pa.Table, right: pa.Table) -> np.ndarray:
    """Pairs of ids that join all components of two chunks that sketches let join, by the nearest
    rows: fewer pairs than components."""
    sid, label, n = (np.asarray(left.column(c)) for c in ("sid", "label", "n"))
    own_sid, own_label, own_n = (np.asarray(right.column(c)) for c in ("sid", "label", "n"))
    whole = Joined(label, own_label)
    place_of, own_place = whole.places(label), whole.places(own_label)

    def forest(edges: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joined = Joined(whole.labels)
        order = np.argsort(far, kind="stable")
        kept = [k for k in order.tolist() if joined.join(int(edges[k, 0]), int(edges[k, 1]))]
        return edges[kept], far[kept]

    edges, far = [np.zeros((0, 4), np.int64)], [np.zeros(0)]
    for row, place, apart in near_places(left, right):
        x, y = place_of[place], own_place[row]
        share = apart / (n[place] + own_n[row])
        first = one_per_component(np.minimum(x, y), np.maximum(x, y), share)
        edges.append(np.stack([x, y, sid[place], own_sid[row]], axis=1)[first])
        far.append(share[first])
        if sum(map(len, far)) > FLUSH:
            edges, far = ([part] for part in forest(np.concatenate(edges), np.concatenate(far)))
    return forest(np.concatenate(edges), np.concatenate(far))[0][:, 2:]


def nearest_across(every: DataFrame, minor: DataFrame, sketches: DataFrame, spanning: bool = False) -> DataFrame:
    """Pairs ``a, b``: each row with its nearest row of each component that it meets, where sketches
    allow a link at all. With ``spanning`` only pairs that join components which no nearer pairs of
    the two chunks join, so that they stay fewer than the rows however many components meet."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = [np.zeros((0, 2), np.int64)]
        if left.num_rows and right.num_rows:
            if spanning:
                return pair_table(nearest_forest(left, right))
            sid, label, own_sid = np.asarray(left.column("sid")), np.asarray(left.column("label")), np.asarray(right.column("sid"))
            for row, place, apart in near_places(left, right):
                first = one_per_component(row, label[place], apart)
                pairs.append(np.stack([own_sid[row[first]], sid[place[first]]], axis=1))
        return pair_table(np.concatenate(pairs))

    return met(every, minor, sketches, work).distinct()


def links_across(every: DataFrame, minor: DataFrame, sketches: DataFrame, sets: DataFrame, spanning: bool = False) -> DataFrame:
    """Links ``a, b``, decided in the task by whole sets: for each row one link to each component
    that it meets, if there is any. With ``spanning`` no links between components that others of
    the two chunks have joined: the same components, and fewer links than rows."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        links = []
        if left.num_rows and right.num_rows:
            sid, label, own_sid = np.asarray(left.column("sid")), np.asarray(left.column("label")), np.asarray(right.column("sid"))
            sets = [[np.frombuffer(s.as_buffer(), np.uint64) for s in t.column("shingles")] for t in (left, right)]
            done = set()
            if spanning:
                joined = Joined(label, np.asarray(right.column("label")))
                place_of, own_place = joined.places(label), joined.places(np.asarray(right.column("label")))
                for row, place, apart in near_places(left, right):
                    roots = joined.roots()
                    open_ = np.flatnonzero(roots[place_of[place]] != roots[own_place[row]])
                    for k in open_[np.argsort(apart[open_], kind="stable")].tolist():
                        y, x = int(row[k]), int(place[k])
                        ends = int(place_of[x]), int(own_place[y])
                        if joined.root(ends[0]) != joined.root(ends[1]) and linked(sets[0][x], sets[1][y]):
                            joined.join(*ends)
                            links.append((own_sid[y], sid[x]))
                return pair_table(np.array(links, np.int64).reshape(-1, 2))
            for row, place, apart in near_places(left, right):
                for k in np.lexsort((apart, label[place], row)).tolist():
                    y, x = int(row[k]), int(place[k])
                    if (y, label[x]) not in done and linked(sets[0][x], sets[1][y]):
                        done.add((y, label[x]))
                        links.append((own_sid[y], sid[x]))
        return pair_table(np.array(links, np.int64).reshape(-1, 2))

    return met(every, minor, sketches.join(sets, "sid"), work).distinct()


def rows_near(every: DataFrame, minor: DataFrame, sketches: DataFrame) -> DataFrame:
    """``tok, band, i, j, sid``: rows that some row of another component may link to by sketch."""
    keys = ("tok", "band", "i", "j")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.table({c: pa.array([], pa.int64()) for c in (*keys, "sid")})
        held = [np.zeros(t.num_rows, bool) for t in (left, right)]
        for row, place, _ in near_places(left, right):
            held[0][place] = True
            held[1][row] = True
        sid = np.unique(np.concatenate([np.asarray(t.column("sid"))[h] for t, h in zip((left, right), held, strict=True)]))
        return pa.table({c: pa.array(np.full(len(sid), left.column(c)[0].as_py(), np.int64)) for c in keys} | {"sid": pa.array(sid)})

    return met(every, minor, sketches, work, ", ".join(f"{c} bigint" for c in (*keys, "sid")))


def met(every: DataFrame, minor: DataFrame, values: DataFrame, work, schema: str = "a bigint, b bigint") -> DataFrame:
    """``work`` over each two chunks that meet, with ``values`` by sid."""
    keys = ("tok", "band", "i", "j")
    sides = [side.join(values.hint("merge"), "sid") for side in (every, minor)]
    names = [c for c in sides[0].columns]
    left, right = (side.select(*[F.col(c).alias(c) for c in names]).groupBy(*keys) for side in sides)
    return left.cogroup(right).applyInArrow(work, schema)


def pair_table(pairs: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(pairs.min(1) if len(pairs) else pairs[:, 0]), "b": pa.array(pairs.max(1) if len(pairs) else pairs[:, 1])})


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, th, n_shingles, component_id, label``.

    ``th`` is a hash of the text, for rows that share an id; ``label`` is the same for all rows of
    a component, whatever their ids.

    Words are what ASCII white space leaves, A-Z in lower case; a set has the distinct runs of five
    words, or the whole text if it is shorter. A null or blank text has no set and no link. Equal
    sets always link. ``component_id`` is the smallest non-null id that links reach, so a row with
    a null id and no other link has a null component. Rows that repeat, or share an id, are rows
    of their own. An empty table gives no rows; other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_hash().alias("th"))
    first = cut(matrix_rows(docs), "matrix-rows")
    rows = first.where("block IS NULL").select("doc_id", "th", "n", "sid", "sketch")
    frequent = frequent_cells(first.where("block IS NOT NULL").select("block", "cells"))
    nodes = rows.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = cut(nodes, "nodes")
    total = nodes.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(0.26 * total / BLOCK_ENTRIES))
    # Made once for frequent columns and once for the others: reading texts again costs less than
    # keeping the entries, which are the largest intermediate result.
    entries = prefix_entries(docs, frequent, blocks)
    pairs, places = rare_pairs(entries.where("block >= 0"))
    often = cut(frequent_entries(entries.where("block < 0")).unionByName(places).distinct(), "frequent-entries")
    candidates = pairs.unionByName(star_pairs(often)).distinct()
    candidates = cut(with_sketches(candidates, cut(small_sketches(nodes), "small-sketches")), "candidates")
    wanted = candidates.select(F.col("a").alias("sid")).unionByName(candidates.select(F.col("b").alias("sid"))).distinct()
    sets = cut(whole_sets(docs, nodes.join(wanted, "sid", "left_semi").select("sid", "doc_id")), "whole-sets")
    # One link for each row first; then only what lies across components.
    spanning = candidates.groupBy("b").agg(F.min("a").alias("a"))
    found = cut(links(spanning, sets), "links")
    labels = cut(components(found), "labels")
    found = found.unionByName(cut(links(labelled(candidates, labels), sets), "links"))
    labels = cut(components(found), "labels")
    # In frequent columns first the nearest row of each other component, whole sets for those left.
    sketches = nodes.select("sid", "sketch")

    def with_sets(more: DataFrame) -> DataFrame:
        """All sets so far and those of ``more``."""
        more = more.distinct().join(sets.select("sid").hint("merge"), "sid", "left_anti")
        more = cut(nodes.join(more.hint("merge"), "sid", "left_semi").select("sid", "doc_id"), "more-rows")
        return sets if more.isEmpty() else sets.unionByName(cut(whole_sets(docs, more), "whole-sets"))

    near = cut(nearest_across(*meetings(often, labels), sketches, spanning=True), "nearest-across")
    if not near.isEmpty():
        sets = with_sets(near.select(F.col("a").alias("sid")).unionByName(near.select(F.col("b").alias("sid"))))
        found = found.unionByName(cut(links(near, sets), "links"))
        labels = cut(components(found), "labels")
        every, minor = meetings(often, labels)
        rest = cut(rows_near(every, minor, sketches), "rows-near")
        if not rest.isEmpty():
            sets = with_sets(rest.select("sid"))
            keys = ["tok", "band", "i", "j", "sid"]
            every, minor = (side.join(rest.hint("merge"), keys, "left_semi") for side in (every, minor))
            found = found.unionByName(cut(links_across(every, minor, sketches, sets, spanning=True), "links"))
            labels = cut(components(found), "labels")
    node = nodes.select("sid", "doc_id").join(labels.select(F.col("node").alias("sid"), "label"), "sid", "left")
    node = node.withColumn("label", F.coalesce("label", "sid"))
    smallest = node.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    ids = node.join(smallest, "label").select("sid", "component_id", "label")
    out = rows.join(ids.hint("merge"), "sid", "left")
    return out.select(
        "doc_id", "th", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "label",
    )


def first_of_groups(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id (null ids last), then the
    smallest text hash; rows equal in both are one document. Documents without words all stay."""
    found = cut(jaccard_components(docs), "components")
    grouped = found.where("n_shingles > 0").groupBy("label", "doc_id", "th").agg(F.count("*").alias("copies"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th", "copies")
    firsts = grouped.groupBy("label").agg(F.min(place).alias("first")).select("first.doc_id", "first.th", "first.copies")
    blank = found.where("n_shingles = 0").select("doc_id", "th", F.lit(1).cast("bigint").alias("copies")).distinct()
    kept = cut(firsts.unionByName(blank), "first-of-groups")
    rows = docs.withColumn("_th", text_hash())
    right = kept.select(F.col("doc_id").alias("_id"), F.col("th").alias("_mark")).hint("merge")
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_mark"))
    out = rows.join(right, same, "left_semi")
    if not kept.where("copies > 1").isEmpty():
        words = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")) > 0
        out = out.where(words).dropDuplicates(["doc_id", "_th"]).unionByName(out.where(~words))
    return out.drop("_th")
