"""Language mixtures against a plain expectation-maximisation."""

import zlib

import pytest

from tidepost.llm import languages
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def test_against_plain_mixtures(spark):
    """Short documents of every language, texts of two languages glued together, and odd texts."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = [(r["doc_id"], r["text"][:600], r["lang"]) for r in rows if r["text"]]
    by_lang = {}
    for _, text, lang in rows:
        by_lang.setdefault(lang, text)
    heads = [by_lang[k] for k in sorted(k for k in by_lang if k)]
    rows += [(10_000 + i, a + " " + b[:250], None) for i, (a, b) in enumerate(zip(heads, heads[1:], strict=False))]
    rows += [(20_000, None, "en"), (20_001, "", "en"), (20_002, "123 ... !", None), (20_003, "é", None), (20_004, "😀 a\t\n b", None)]
    model = brute.language_model([(t, k) for i, t, k in rows if k and t is not None and zlib.crc32(str(i).encode()) % 4 != 2])
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r for r in languages.identify(df).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        lang, share = brute.language_of(text, model)
        assert got[i]["lang_pred"] == lang and got[i]["score"] == pytest.approx(share, abs=1e-3), i
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert sum(len(got[i]["lang_shares"]) > 1 for i in got if 10_000 <= i < 20_000) > 0
