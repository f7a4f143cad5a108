"""Substring deduplication by sliding spans of sentences.

A span is the shortest run of at least two consecutive sentences that has at least twenty words;
one starts at every sentence. Spans are hashed and compared across the corpus; every sentence
that a repeated span covers goes, but for the span's first occurrence (the smallest document id, a
hash of the text among rows that share it, and then the first position).

The units are sentences, as the query's SQL has them. A sentence that is glued to unfinished text
is a unit of its own there, so a repeat of one long sentence is not seen; ``clauses`` makes units
of a few words that end inside the sentence, wherever it stands.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import cut, map_rows, text_hash

SENTENCE = re.compile(rb"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
CLAUSE = re.compile(rb"[^,;:|]*[,;:|]+|[^,;:|]+")
WORD = re.compile(rb"\s*\S+(?:\s+$)?|\s+")
#: A clause ends at one word of so many, chosen by its bytes, and at this number of words.
WORD_ENDS = 4
CLAUSE_WORDS = 10
SPACE = b" \t\n\r\x0b\x0c"
MIN_SENTENCES = 2
MIN_WORDS = 20
NO_ID = -(1 << 63)


def units(text: bytes, clauses: bool = False) -> list[bytes]:
    """The sentences of a text, or with ``clauses`` parts of them of at most ten words."""
    sentences = SENTENCE.findall(text)
    if not clauses:
        return sentences
    out = []
    for clause in (c for s in sentences for c in CLAUSE.findall(s)):
        held: list[bytes] = []
        for word in WORD.findall(clause):
            held.append(word)
            if len(held) == CLAUSE_WORDS or xxhash.xxh3_64_intdigest(word.strip(SPACE)) % WORD_ENDS == 0:
                out.append(b"".join(held))
                held = []
        if held:
            out.append(b"".join(held))
    return out


def spans_of(text: bytes, clauses: bool = False) -> list[tuple[int, int, bytes]]:
    """(first unit, number of units, hash) of every span of a text."""
    sentences = [s.strip(SPACE) for s in units(text, clauses)]
    words = [len(s.split()) for s in sentences]
    out, end, held = [], 0, 0
    for at in range(len(sentences)):
        while end < len(sentences) and (end - at < MIN_SENTENCES or held < MIN_WORDS):
            held += words[end]
            end += 1
        if end - at < MIN_SENTENCES or held < MIN_WORDS:
            break
        out.append((at, end - at, xxhash.xxh3_128_digest(b"\n".join(sentences[at:end]))))
        held -= words[at]
    return out


def spans(docs: DataFrame, clauses: bool = False) -> DataFrame:
    """``id, th, at, many, h1, h2``: the spans of each document."""
    names = ["id", "th", "at", "many", "h1", "h2"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, places, digests = [], [], [], []
            for doc_id, th, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                found = spans_of((text.as_py() or "").encode("utf-8", "surrogatepass"), clauses)
                for at, many, digest in found:
                    places.append((at, many))
                    digests.append(digest)
                ids.append((doc_id.as_py(), len(found)))
                marks.append((th.as_py(), len(found)))
                if len(digests) > 200_000:
                    yield pack(ids, marks, places, digests)
                    ids, marks, places, digests = [], [], [], []
            yield pack(ids, marks, places, digests)

    def pack(ids, marks, places, digests) -> pa.RecordBatch:
        where = np.array(places, np.int32).reshape(-1, 2)
        keys = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        spread = [np.repeat(np.array([v for v, _ in x], np.int64), [n for _, n in x]) for x in (ids, marks)]
        columns = [*spread, where[:, 0], where[:, 1], keys[:, 0], keys[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)), text_hash(), F.col("text"))
    schema = "id bigint, th bigint, at int, many int, h1 bigint, h2 bigint"
    return map_rows(rows, schema, work)


def later_spans(found: DataFrame) -> DataFrame:
    """``id, th, spans``: the places (first sentence, number) that occur earlier in the corpus.

    Span counts are summed in the map tasks first; only repeated spans leave the join, which
    Spark splits where one span is very frequent.
    """
    place = F.struct("id", "th", "at")
    repeated = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = cut(repeated, "repeated-spans")  # Spark splits a hot key only between plain exchanges
    later = found.join(repeated.hint("merge"), ["h1", "h2"]).where(F.struct("id", "th", "at") != F.col("first"))
    return later.groupBy("id", "th").agg(F.collect_set(F.struct("at", "many")).alias("spans"))


def dedup_sentences(docs: DataFrame, clauses: bool = False) -> DataFrame:
    """All documents with ``text`` thinned, and ``n_sentences``, ``n_removed``.

    Texts without two sentences and twenty words stay as they are; a null text stays null with no
    sentence. Null ids come first in the order of documents. Among rows that share an id the
    order is that of a hash of their text; rows equal in both are one document: they keep or lose
    the same sentences. Columns named ``n_sentences`` and ``n_removed`` are replaced; an empty table stays empty. With ``clauses`` the
    units compared, removed and counted are clauses of at most ten words.
    """
    marks = cut(later_spans(cut(spans(docs, clauses), "spans")), "later-spans")
    docs = docs.drop("n_sentences", "n_removed")
    left = docs.withColumns({"_i": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)), "_th": text_hash()})
    right = marks.select(F.col("id").alias("_id"), F.col("th").alias("_mark"), F.col("spans").alias("_spans"))
    # A merge join at every size: marks grow with the corpus and are never broadcast.
    joined = left.join(right.hint("merge"), (F.col("_i") == F.col("_id")) & (F.col("_th") == F.col("_mark")), "left")
    joined = joined.select(*docs.columns, "_spans")
    at, names = docs.columns.index("text"), docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, gone = [], [], []
            for value, covered in zip(batch.column(at), batch.column(len(names)), strict=True):
                text, spans = value.as_py(), covered.as_py()
                data = (text or "").encode("utf-8", "surrogatepass")
                sentences = units(data, clauses)
                keep = np.ones(len(sentences), bool)
                for span in spans or ():
                    keep[span["at"] : span["at"] + span["many"]] = False
                totals.append(len(sentences))
                gone.append(int((~keep).sum()))
                if spans:
                    text = b"".join(s for s, k in zip(sentences, keep, strict=True) if k).decode("utf-8", "surrogatepass")
                texts.append(text)
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(totals, pa.int64()), pa.array(gone, pa.int64())], [*names, "n_sentences", "n_removed"]
            )

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + ", n_sentences bigint, n_removed bigint"
    return map_rows(joined, schema, work)


#: The query's rows in DuckDB SQL.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]*[.!?\n]+|[^.!?\n]+') AS ss FROM documents),
s AS (SELECT doc_id, unnest(range(0, len(ss))) AS i, unnest(ss) AS s FROM d),
c AS (SELECT doc_id, i, s, regexp_replace(s, '^[ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+$', '', 'g') AS t,
             sum(len(regexp_extract_all(s, '[^ \t\n\r\x0b\x0c]+'))) OVER (PARTITION BY doc_id ORDER BY i) AS upto,
             len(regexp_extract_all(s, '[^ \t\n\r\x0b\x0c]+')) AS n FROM s),
e AS (SELECT a.doc_id, a.i, min(b.i) AS j FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i > a.i AND b.upto - a.upto + a.n >= 20
      GROUP BY ALL),
w AS (SELECT e.doc_id, e.i, e.j, string_agg(c.t, chr(10) ORDER BY c.i) AS w
      FROM e JOIN c ON c.doc_id = e.doc_id AND c.i BETWEEN e.i AND e.j GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i FROM r WHERE k > 1),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY ALL),
t AS (SELECT s.doc_id, string_agg(s.s, '' ORDER BY s.i) AS text FROM s ANTI JOIN gone USING (doc_id, i) GROUP BY ALL)
SELECT d.doc_id, CAST(len(d.ss) AS BIGINT) AS n_sentences, CAST(coalesce(n.n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(t.text, '') AS text
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
