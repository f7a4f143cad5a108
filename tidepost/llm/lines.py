"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines are hashed. A window that occurs more than once in the corpus stays
where it comes first (by document id, then position); the lines of all later occurrences go,
overlapping windows merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import cut, text_hash, text_of

WINDOW = 3


def windows(docs: DataFrame) -> DataFrame:
    """``doc_id, th, at, h1, h2``: the windows of each document, blank ones left out."""
    rows = docs.select("doc_id", text_hash().alias("th"), _hashes().alias("found"))
    rows = rows.select("doc_id", "th", F.inline("found"))
    return rows.where("not blank").drop("blank")


def _hashes() -> Column:
    """The windows of a text. ``transform`` over one element binds the lines, so that they are
    split once and not for each window."""

    def hashed(lines: Column, at: Column) -> Column:
        parts = [F.get(lines, at + i) for i in range(WINDOW)]
        blank = F.trim(F.concat(*parts)) == ""
        return F.struct(
            at.alias("at"), F.xxhash64(*parts).alias("h1"), F.hash(*parts).alias("h2"), blank.alias("blank")
        )

    def of_lines(lines: Column) -> Column:
        starts = F.when(F.size(lines) >= WINDOW, F.sequence(F.lit(0), F.size(lines) - WINDOW))
        return F.transform(starts, lambda at: hashed(lines, at))

    return F.get(F.transform(F.array(F.split(text_of(), "\n", -1)), of_lines), F.lit(0))


def later_windows(found: DataFrame) -> DataFrame:
    """``doc_id, th, starts``: where windows start that occur earlier in the corpus.

    The first place of a window is found by partial aggregation; windows that occur once never
    meet the join, and Spark splits the join where one window is very frequent.
    """
    place = F.struct("doc_id", "th", "at")
    repeated = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = cut(repeated, "repeated-windows")  # Spark splits a hot key only between plain exchanges
    later = found.join(repeated.hint("merge"), ["h1", "h2"]).where(~F.struct("doc_id", "th", "at").eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "th").agg(F.collect_set("at").alias("starts"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All documents with ``text`` thinned, and ``n_lines``, ``n_removed``.

    Documents of fewer than three lines have no window and stay as they are; a null text stays
    null with no line. Windows of blank lines alone never count. Among rows that share an id the
    order is that of a hash of their text; rows equal in both are one document: they keep or lose
    the same lines. Null ids come first. Columns named ``n_lines`` and ``n_removed`` are replaced.
    """
    marks = cut(later_windows(windows(docs)), "later-windows")
    docs = docs.drop("n_lines", "n_removed")
    left = docs.withColumn("_th", text_hash())
    right = marks.select(F.col("doc_id").alias("_id"), F.col("th").alias("_mark"), F.col("starts").alias("_starts"))
    # A merge join at every size: marks grow with the corpus and are never broadcast.
    joined = left.join(right.hint("merge"), left["doc_id"].eqNullSafe(right["_id"]) & (left["_th"] == right["_mark"]), "left")
    lines = F.split(F.col("text"), "\n", -1)

    def thin(lines: Column) -> Column:
        covered = F.flatten(F.transform("_starts", lambda s: F.array(*[s + i for i in range(WINDOW)])))
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
        text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
        return F.struct(text.alias("text"), (F.size(lines) - F.size(kept)).alias("n_removed"))

    thinned = F.when(F.col("_starts").isNotNull(), F.get(F.transform(F.array(lines), thin), F.lit(0)))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    joined = joined.select(*docs.columns, n_lines.cast("bigint").alias("n_lines"), thinned.alias("_thin"))
    text = F.when(F.col("_thin").isNull(), F.col("text")).otherwise(F.col("_thin.text")).alias("text")
    return joined.select(
        *[text if c == "text" else F.col(c) for c in docs.columns],
        "n_lines",
        F.coalesce(F.col("_thin.n_removed"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


#: The query's rows in DuckDB SQL.
SQL = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, i AS pos, ls[i + 1] || chr(10) || ls[i + 2] || chr(10) || ls[i + 3] AS w
      FROM (SELECT doc_id, ls, unnest(range(0, len(ls) - 2)) AS i FROM d WHERE len(ls) >= 3)
      WHERE trim(ls[i + 1] || ls[i + 2] || ls[i + 3]) <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS FIRST, pos) AS k FROM w),
gone AS (SELECT DISTINCT doc_id, pos + j AS line FROM r, (VALUES (0), (1), (2)) AS o(j) WHERE k > 1),
l AS (SELECT doc_id, unnest(range(0, len(ls))) AS line, unnest(ls) AS l FROM d),
k AS (SELECT l.doc_id, count(*) AS n_removed FROM l JOIN gone USING (doc_id, line) GROUP BY ALL),
t AS (SELECT l.doc_id, string_agg(l.l, chr(10) ORDER BY l.line) AS text
      FROM l ANTI JOIN gone USING (doc_id, line) GROUP BY ALL)
SELECT d.doc_id, CAST(len(d.ls) AS BIGINT) AS n_lines, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(t.text, '') AS text
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)
"""
