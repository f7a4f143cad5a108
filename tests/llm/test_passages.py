"""Passages of fifty words that repeat, glued between other words."""

from tidepost.llm import common, passages, substrings
from tests.llm.tables import no_documents, odd_documents, odd_texts, prose, words


def test_every_repeated_run_of_words_is_sampled_alike():
    for seed in range(60):
        shared, at = words(seed, 2 * passages.WORDS - 1), seed % 5
        texts = [" ".join(words(100 + seed + k, 40 + k + at)) + "  " + " ".join(shared) + "\n" + " ".join(words(300 + seed + k, 30)) for k in (0, 9)]
        found = []
        for text in texts:
            data = text.encode()
            hashes, _ = passages.words_by_text([data], passages.WHITE_SPACE)
            grams = passages.ngrams(hashes, passages.WORDS)
            found.append({int(grams[k]) for k in passages.taken(grams)})
        assert found[0] & found[1]


def test_passages_of_51_words(spark):
    docs = []
    for k in range(30):  # each passage in two documents, glued to other text on both sides
        passage = " ".join(words(500 + k, 51))
        assert len(passage) < 400
        docs += [(2 * k + j, prose(1000 + 2 * k + j, 60)[:-1] + " " + passage + " " + prose(2000 + 2 * k + j, 60)) for j in (0, 1)]
    docs += [(100 + k, prose(3000 + k, 150)) for k in range(20)]
    rows = {r["doc_id"]: r for r in substrings.cut_documents(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert all(rows[k]["n_repeated"] > 0 for k in range(1, 60, 2)) and all(rows[k]["n_removed"] == 0 for k in rows)
    assert all(rows[k]["n_repeated"] == 0 for k in (*range(0, 60, 2), *range(100, 120)))


def test_odd_rows(spark):
    rows = {(r["doc_id"], r["n_bytes"]): r["n_repeated"] for r in substrings.cut_documents(odd_documents(spark)).collect()}
    size = {i: len((t or "").encode()) for i, t in odd_texts()}
    assert rows[(7, 0)] == rows[(8, 0)] == rows[(10, 1)] == 0 and rows[(6, size[6])] > 0 and rows[(5, size[5])] == 0
    assert passages.later_passages(no_documents(spark)).count() == 0


def test_places_are_small_rows(spark):
    """A place is one number, and tables that stay on disk are packed."""
    text = "  " + " ".join(words(1, 40)) + " " + "ñ" * 90_000
    found = passages.places(spark.createDataFrame([(3, text)], "doc_id bigint, text string")).collect()
    data = text.encode()
    spans = [(r["span"] >> passages.LENGTH_BITS, r["span"] & (1 << passages.LENGTH_BITS) - 1) for r in found]
    assert found[0].asDict().keys() == {"h", "doc_id", "th", "span"} and spans
    assert all(len(data[a : a + n].split()) == passages.WORDS and not data[a : a + 1].isspace() for a, n in spans)
    kept = common.cut(spark.range(10), "kept")
    assert kept.count() == 10 and all(f.endswith(".zstd.parquet") for f in kept.inputFiles())
