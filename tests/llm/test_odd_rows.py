"""Every operator on tables with odd rows, and on empty tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepost.llm import contamination, languages, lines, ngram_join, packing, personal, sentences, sharding, substrings
from tidepost.llm.queries import word_tokenizer
from tests.llm import brute
from tests.llm.tables import no_documents, odd_documents, odd_texts, prose

IDS = Counter(i for i, _ in odd_texts())


@pytest.fixture(scope="module")
def odd(spark):
    return odd_documents(spark).cache()


def benchmark(spark):
    shared = odd_texts()[4][1].split("\n")[4:7]
    rows = [(1, "\n".join(shared)), (2, None), (None, "a b c d e f g h i"), (3, "too short"), (1, "\n".join(shared)), (4, "")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def ids_of(rows):
    return Counter(r["doc_id"] for r in rows)


def test_line_windows(odd):
    rows = lines.dedup_lines(odd).collect()
    assert ids_of(rows) == IDS and set(odd.columns) <= set(rows[0].asDict())
    expected = brute.lines([(i, t) for i, t in odd_texts() if i is not None and t is not None and i not in (1, 4)])
    kept = {r["doc_id"]: r for r in rows}
    assert kept[7]["text"] is None and kept[7]["n_lines"] == 0 and kept[8]["n_lines"] == 1
    assert kept[2]["n_removed"] > 0 and kept[16]["n_removed"] == 0
    assert kept[17]["text"] == expected[17]


def test_line_windows_against_brute_force(spark):
    docs = [(i, t) for i, t in odd_texts() if i is not None and t is not None][:-4]
    docs = list(dict(docs).items())
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in lines.dedup_lines(df).collect()} == brute.lines(docs)


def test_sentence_spans(odd):
    rows = sentences.dedup_sentences(odd).collect()
    assert ids_of(rows) == IDS and set(odd.columns) <= set(rows[0].asDict())
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[7]["text"] is None and by_id[6]["n_removed"] > 0 and by_id[5]["n_removed"] == 0


def test_sentence_spans_against_brute_force(spark):
    docs = list({i: t for i, t in odd_texts() if i is not None and t is not None}.items())
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in sentences.dedup_sentences(df).collect()} == brute.sentences(docs)


@pytest.mark.parametrize("doc_id", [None, 5])
def test_sentence_spans_of_rows_that_share_an_id(spark, doc_id):
    shared = prose(2, 120)
    docs = [(doc_id, prose(20 + k, 45) + "\n" + shared + "\n" + prose(40 + k, 45)) for k in range(6)]
    rows = sentences.dedup_sentences(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert len(rows) == 6 and sorted(r["n_removed"] > 0 for r in rows) == [False] + [True] * 5


@pytest.mark.parametrize("contexts", [1000, 2])
def test_substrings(odd, monkeypatch, contexts):
    monkeypatch.setattr(substrings, "GROUP_CONTEXTS", contexts)
    rows = substrings.cut_documents(odd).collect()
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)
    assert got == sorted(brute.substrings(odd_texts()))


def test_ngram_join(odd):
    rows = ngram_join.jaccard_components(odd).collect()
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in rows)
    assert got == sorted(brute.components(odd_texts()))


def test_one_document_of_each_group_stays(odd):
    rows = ngram_join.first_of_groups(odd).collect()
    kept = ids_of(rows)
    assert kept[1] == 1 and kept[2] == 0 and kept[3] == 0 and kept[4] == 2 and kept[11] == 1 and kept[12] == 0
    assert kept[7] == kept[8] == kept[9] == 1 and kept[None] == 2  # one null text, one prose without an id
    assert set(odd.columns) == set(rows[0].asDict())


def test_packing(odd):
    rows = packing.packed_documents(odd, word_tokenizer(), 128).collect()
    brute.check_packing(rows, odd_texts(), 128)


def test_languages(odd, spark):
    model = languages.fit(spark.createDataFrame([("la casa de papel y el mar", "es"), ("the house of the sea", "en"), (None, "en"), ("x", None)], "text string, lang string"))
    assert model.languages == ["en", "es"]
    rows = languages.predict(odd.drop("score"), model).collect()
    assert ids_of(rows) == IDS
    by_id = {r["doc_id"]: r for r in rows}
    for i in (7, 8, 9, 18):
        assert by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0
    assert all(r["lang_pred"] in ("en", "es", "und") and 0 <= r["score"] <= 1 for r in rows)


def test_contamination(odd, spark):
    rows = contamination.contaminated(odd, benchmark(spark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(5, 1), (6, 1)}
    kept = ids_of(contamination.decontaminate(odd, benchmark(spark)).collect())
    assert kept == IDS - Counter([5, 6])


def test_sharding(odd):
    rows = sharding.extendible_shards(odd, 2000).collect()
    assert ids_of(rows) == IDS
    size, count = Counter(), Counter()
    for r in rows:
        size[r["shard"]] += r["n_bytes"]
        count[r["shard"]] += 1
    for r in rows:
        assert r["shard_bytes"] == size[r["shard"]] and r["shard_docs"] == count[r["shard"]]
        assert size[r["shard"]] <= 2000 or count[r["shard"]] == 1
    shards = sorted(size)
    assert not any(b.startswith(a) for a in shards for b in shards if a != b)


def test_equal_rows_are_split_too(spark):
    df = spark.range(0, 600).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit("same text " * 10).alias("text"))
    rows = sharding.extendible_shards(df, 3000).collect()
    assert len(rows) == 600 and max(r["shard_bytes"] for r in rows) <= 3000


def test_written_shards(odd, tmp_path, spark):
    sharding.write_shards(odd, str(tmp_path / "shards"), 2000)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert ids_of(back.collect()) == IDS and back.select("shard_id").distinct().count() > 3


def test_personal(odd):
    rows = personal.find_personal(odd).collect()
    assert ids_of(rows) == IDS and all(r["n_email"] == 0 for r in rows)


def test_empty_tables(spark):
    none = no_documents(spark)
    assert lines.dedup_lines(none).count() == sentences.dedup_sentences(none).count() == 0
    assert substrings.cut_documents(none).count() == ngram_join.jaccard_components(none).count() == 0
    assert ngram_join.first_of_groups(none).count() == personal.find_personal(none).count() == 0
    assert packing.packed_documents(none, word_tokenizer()).count() == languages.identify(none).count() == 0
    assert sharding.extendible_shards(none, 100).count() == 0
    items = benchmark(spark)
    assert contamination.contaminated(none, items).count() == contamination.decontaminate(none, items).count() == 0
    assert contamination.contaminated(odd_documents(spark), items.where("false")).count() == 0
