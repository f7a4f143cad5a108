"""The registered queries against SQL, and the pipeline's decisions."""

import os

import pytest

import corpus_pipeline
from tidepost.llm import contamination, queries
from tests.checker import compare_rows, connect
from tests.llm import brute
from tests.llm.tables import odd_texts, prose, words

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_against_sql(spark, key):
    ok, message = compare_rows(connect(SMALL), queries.QUERIES[key](spark, SMALL), queries.ORACLES[key])
    assert ok, message


def test_operators():
    assert [k.split("_")[0] for k in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("key", ["op3_personal", "op11_chat"])
def test_native_operator_runs_no_python(spark, key):
    plan = queries.QUERIES[key](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = queries.QUERIES["op8_language"](spark, SMALL).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 20 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, counts, columns = [], [docs.count()], docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = os.path.join(tmp_path, f"{number}")
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        names.append(name)
        counts.append(docs.count())
        if number < 4:
            assert docs.columns == columns
    assert names == ["language", "lines", "near_copies", "benchmark", "packing"]
    assert counts[0] >= counts[1] >= counts[2] > counts[3] >= counts[4] > 0
    assert set(docs.columns) >= {"doc_id", "piece", "sequence_id", "offset"}
    assert corpus_pipeline.run(spark, SMALL).count() == counts[5]


def test_pipeline_against_plain_stages(spark, tmp_path):
    docs = {i: t for i, t in odd_texts() if i is not None}
    docs[20] = prose(31, 60) + "\n" + " ".join(f"x{k}" if k % 3 == 2 else w for k, w in enumerate(words(32, 48)))
    docs[21], docs[22] = prose(33, 200), prose(33, 200).replace(".", ";")
    items = [(1, "\n".join(docs[5].split("\n")[4:7])), (2, " ".join(words(32, 48))), (3, "too short"), (4, None), (5, "One, two three!")]
    rows = [(i, t, ("en", "es")[i % 2], "s", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    plain = {i: t for i, t in docs.items() if any(c.isalpha() for c in t or "")}
    thinned = brute.lines(list(plain.items()))
    plain = {i: t for i, t in thinned.items() if t or t == plain[i]}
    firsts = {i for i, _, first in brute.components(list(plain.items())) if i == first}
    plain = {i: t for i, t in plain.items() if str(i) in firsts}
    tests = [contamination.text_words(contamination.normal(t), contamination.PUNCTUATION) for _, t in items if t]
    dirty = set()
    for i, t in plain.items():
        found = contamination.text_words(contamination.normal(t), contamination.PUNCTUATION)
        for item in tests:
            whole = any((found[k : k + len(item)] == item).all() for k in range(len(found) - len(item) + 1))
            if whole or len(item) >= contamination.MIN_WORDS and contamination.align(item, found) >= contamination.LEAST_SCORE:
                dirty.add(i)
    assert {5, 11, 20} <= dirty and len(plain) > len(dirty) + 5
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    brute.check_packing(got, [(i, t) for i, t in plain.items() if i not in dirty], 2048)
