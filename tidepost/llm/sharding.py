"""Sharding by extendible hashing.

Every row has a string of hash bits. The directory starts with one bucket; a bucket over the byte
limit is split on its next bit, all others stay. Buckets are counted, never gathered: a directory
of bit prefixes is summed up level by level, and a row finds its shard by one join on a prefix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import cut, text_of

#: Bits that come from the row's content; the next ones tell equal rows apart.
CONTENT_BITS = 32
ALL_BITS = 2 * CONTENT_BITS
SLACK_BITS = 4


def bits_of(value: Column, n_bits: int) -> Column:
    """The first bits of the md5 of ``value`` as a string of 0 and 1."""
    letters = F.translate(F.substring(F.md5(value), 1, n_bits // 4), "0123456789abcdef", "ghijklmnopqrstuv")
    for digit, letter in enumerate("ghijklmnopqrstuv"):
        letters = F.replace(letters, F.lit(letter), F.lit(f"{digit:04b}"))
    return letters


def with_bits(docs: DataFrame) -> DataFrame:
    """Adds ``hash_bits`` and ``n_bytes``.

    The first 32 bits are those of ``doc_id`` and text, the others those of the row's number in
    its scan, so that rows that repeat can still be split.
    """
    content = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.md5(text_of())
    )
    row = F.monotonically_increasing_id().cast("string")
    return docs.withColumns(
        {
            "hash_bits": F.concat(bits_of(content, CONTENT_BITS), bits_of(row, CONTENT_BITS)),
            "n_bytes": F.octet_length(text_of()).cast("bigint"),
        }
    )


def directory(keys: DataFrame, max_bytes: int) -> list[tuple[int, DataFrame]]:
    """The directory for ``keys`` (``hash_bits``, ``n_bytes``): pairs of (bits, table).

    A table maps each ``cell`` of that many bits to its ``shard`` (a bit prefix, the empty string
    while one shard is enough), ``shard_bytes`` and ``shard_docs``. Cells that are still too
    large are in the next, deeper table. A shard of a single row may be over the limit: there is
    nothing to split. An empty input gives one empty table.
    """
    total = keys.agg(F.sum("n_bytes")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1, total / max_bytes)))) + SLACK_BITS
    tables, low, rest = [], 0, keys
    while True:
        depth = min(depth, ALL_BITS)
        cells = rest.groupBy(F.substring("hash_bits", 1, depth).alias("cell")).agg(
            F.sum("n_bytes").alias("b"), F.count("*").alias("n")
        )
        cells = cut(cells, "directory-cells")
        levels = cells.withColumn("level", F.explode(F.sequence(F.lit(low), F.lit(depth))))
        levels = levels.withColumn("shard", F.substring("cell", F.lit(1), F.col("level")))
        sums = levels.groupBy("level", "shard").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
        fits = (F.col("shard_bytes") <= max_bytes) | (F.col("shard_docs") == 1)
        if depth == ALL_BITS:
            fits = fits | (F.col("level") == depth)
        found = (
            levels.select("cell", "level", "shard")
            .join(sums.where(fits).hint("merge"), ["level", "shard"])
            .groupBy("cell")
            .agg(F.min(F.struct("level", "shard", "shard_bytes", "shard_docs")).alias("leaf"))
            .select("cell", "leaf.shard", "leaf.shard_bytes", "leaf.shard_docs")
        )
        found = cut(found, "directory")
        tables.append((depth, found))
        open_cells = cells.join(found.hint("merge"), "cell", "left_anti")
        if depth == ALL_BITS or open_cells.isEmpty():
            return tables
        rest = rest.join(
            open_cells.select("cell").hint("merge"), F.substring(rest["hash_bits"], 1, depth) == F.col("cell"), "left_semi"
        )
        low, depth = depth + 1, depth + 2 * SLACK_BITS


def assign(rows: DataFrame, tables: list[tuple[int, DataFrame]]) -> DataFrame:
    """Rows with ``hash_bits`` get ``shard``, ``shard_bytes`` and ``shard_docs``."""
    names = ("shard", "shard_bytes", "shard_docs")
    kept = [c for c in rows.columns if c not in names]
    out, seen = rows.select(*kept), []
    for i, (depth, cells) in enumerate(tables):
        cells = cells.select(F.col("cell").alias(f"_cell{i}"), *[F.col(c).alias(f"_{c}{i}") for c in names])
        # The directory grows with the data, so it is never broadcast.
        out = out.join(cells.hint("merge"), F.substring("hash_bits", 1, depth) == F.col(f"_cell{i}"), "left")
        seen.append(i)
    return out.select(*kept, *[F.coalesce(*[F.col(f"_{c}{i}") for i in seen]).alias(c) for c in names])


def extendible_shards(docs: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, shard, shard_bytes, shard_docs``.

    Null ids and texts are hashed as ``-`` and the empty text. Very long texts become shards of
    their own. Rows that repeat stay rows of their own and are split by row number once 32 bits
    cannot part them. An empty table gives no rows; other columns are not looked at.
    """
    keys = cut(with_bits(docs).select("doc_id", "n_bytes", "hash_bits"), "shard-keys")
    return assign(keys, directory(keys, max_bytes)).drop("hash_bits")


def write_shards(docs: DataFrame, path: str, max_bytes: int = 64 << 20) -> None:
    """Writes whole documents, one folder ``shard_id=<bits>`` per shard.

    The bits are taken once and written, so that numbering and assignment see the same rows.
    """
    rows = cut(with_bits(docs), "shard-rows")
    placed = assign(rows, directory(rows.select("hash_bits", "n_bytes"), max_bytes))
    placed = placed.withColumn("shard_id", F.concat(F.lit("b"), F.col("shard")))
    placed.drop("hash_bits", "n_bytes", "shard", "shard_bytes", "shard_docs").repartition("shard_id").write.partitionBy(
        "shard_id"
    ).parquet(path)
