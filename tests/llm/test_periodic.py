"""Periodic runs against a plain search of every period."""

import hashlib
import random
import re
import zlib

import pytest

from tidepost.llm import periodic, queries
from tests.llm.tables import no_documents, odd_documents, odd_texts, prose


def plain_runs(words):
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                part = words[i : i + length]
                if not any(part[p:] == part[: length - p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def random_words(rng):
    n, kind = rng.choice([0, 1, 5, 6, 20, 60, 300]), rng.randrange(5)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        unit = [rng.choice("abc") for _ in range(rng.randrange(1, max(2, n // 4)))]
        return [unit[i % len(unit)] for i in range(n)]
    if kind == 2:
        out = []
        while len(out) < n:
            unit = [rng.choice("ab") for _ in range(rng.randrange(1, 12))]
            out += (unit * rng.randrange(1, 8))[: rng.randrange(1, 60)]
        return out
    if kind == 3:  # a period that holds runs of shorter periods
        inner = (["a"] * rng.randrange(1, 30) + ["b"] * rng.randrange(1, 9)) * rng.randrange(1, 7)
        return (inner[rng.randrange(3) :][: rng.randrange(1, 80)] + ["c"]) * rng.randrange(1, 7)
    unit = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, max(2, n // 3)))]
    return [rng.choice("xyz") for _ in range(rng.randrange(9))] + [unit[i % len(unit)] for i in range(n)]


@pytest.mark.parametrize("seed", range(5))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(30):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 12))]
        found = periodic.document_runs([" ".join(t).encode() for t in texts])
        for words, runs in zip(texts, found, strict=True):
            expected = plain_runs(words)
            assert [tuple(r) for r in runs.tolist()] == expected
            assert periodic.collapsed(" ".join(words).encode(), runs).decode() == plain_collapsed(words, expected)


def test_long_periods_and_equal_documents():
    unit = prose(3, 900).split()
    words = prose(4, 300).split() + unit * 5 + unit[:77] + prose(5, 40).split()
    texts = [" ".join(words), "x " * 5000, " ".join(words), " ".join(unit * 3 + unit[:899])]
    found = [r.tolist() for r in periodic.document_runs([t.encode() for t in texts])]
    assert found == [[[300, 4577, 900]], [[0, 5000, 1]], [[300, 4577, 900]], []]


def test_odd_rows(spark):
    rows = periodic.periodic_runs(odd_documents(spark)).collect()
    expected = []
    for i, t in odd_texts():
        words = split(t)
        runs = plain_runs(words) if len(words) < 1000 else []
        expected.append((str(i), len(words), str(runs), plain_collapsed(words, runs)))
    assert sorted((str(r["doc_id"]), r["n_words"], str([tuple(x) for x in r["runs"]]), r["collapsed"]) for r in rows) == sorted(expected)
    assert periodic.periodic_runs(no_documents(spark)).count() == 0


def test_query_against_plain_version(spark, tmp_path):
    docs = [(i, prose(i, 20 + i)) for i in range(150)] + [(200, None), (201, ""), (202, "a b " * 9), (None, "c " * 8), (203, " x\ty ")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {str(r["doc_id"]): tuple(r[1:]) for r in queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    expected, planted = {}, 0
    for i, t in docs:
        words = split(t)
        n, h = len(words), zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, planted = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)], planted + 1
        runs = plain_runs(words)
        start, length, q = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
        digests = ("".join(f"{a},{b},{c}\n" for a, b, c in runs), plain_collapsed(words, runs))
        expected[str(i)] = (len(runs), start, length, q, q and 1000 * length // q, *(hashlib.sha256(x.encode()).hexdigest() for x in digests))
    assert got == expected and planted > 5
