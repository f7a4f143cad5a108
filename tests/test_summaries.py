from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidepost.operators import entities, evaluation, search, summaries, words


def test_histogram_edges(spark):
    df = spark.createDataFrame([(s,) for s in (-1.0, -0.95, 0.0, 0.999, 1.0, None)], "s double")
    bins = {r["bin"]: r["n"] for r in summaries.histogram(df, "s", 40).collect()}
    assert bins[0] == 1 and bins[39] == 2 and sum(bins.values()) == 5


def test_kpis_of_nothing(spark):
    df = spark.createDataFrame([], "platform string, topic string, sentiment_label string, sentiment_score double")
    row = summaries.dashboard_kpis(df).first().asDict()
    assert row["total"] == 0 and row["avg_score"] == 0.0 and row["positive_pct"] == 0 and row["pos_neg_ratio"] == 0.0


def test_percent_is_rounded_down_and_ratio_is_safe(spark):
    rows = [("a", "t", "positive", 1.0), ("a", "t", "Positive", 1.0), ("b", "u", "Neutral", 0.0)]
    df = spark.createDataFrame(rows, "platform string, topic string, sentiment_label string, sentiment_score double")
    row = summaries.dashboard_kpis(df).first()
    assert (row["positive_pct"], row["pos_neg_ratio"], row["platforms"], row["topics"]) == (66, 2.0, 2, 2)


def test_heatmap_is_dense(spark):
    df = spark.sql("select timestamp'2024-01-01 05:00:00' as timestamp union all select null")
    rows = summaries.hour_heatmap(df).collect()
    assert len(rows) == 168 and sum(r["n"] for r in rows) == 1
    assert [(r["day"], r["hour"]) for r in rows if r["n"]] == [("Monday", 5)]


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "x" * 100, ["a"]), (2, None, None)], "id int, t string, l array<string>")
    rows = {r["column"]: r for r in summaries.column_profile(df).collect()}
    assert rows["t"]["non_null"] == 1 and len(rows["t"]["sample"]) == 80
    assert rows["l"]["type"] == "array<string>" and rows["id"]["non_null"] == 2


def test_sort_puts_nulls_last_both_ways(spark):
    df = spark.createDataFrame([(1, None), (2, 0.5), (3, -0.5), (4, 0.5)], "post_id int, sentiment_score double")
    ids = lambda by: [r["post_id"] for r in search.sorted_posts(df, by).collect()]
    assert ids("Highest Score") == [2, 4, 3, 1] and ids("Lowest Score") == [3, 2, 4, 1]


def test_keyword_filter_is_a_regex_unless_literal(spark):
    df = spark.createDataFrame([("a.b",), ("AxB",), (None,)], "text string")
    assert search.filter_keyword(df, "a.b").count() == 2
    assert search.filter_keyword(df, "a.b", literal=True).count() == 1
    assert search.filter_keyword(df, "").count() == 3


DOCS = [
    "alpha beta alpha gamma", "beta gamma delta", "alpha beta the and", "xx yy", None, "Delta, alpha; gamma!", "epsilon zeta",
]


def test_words_and_graph_agree_with_a_plain_rewrite(spark):
    df = spark.createDataFrame([(d,) for d in DOCS], "text string")
    import re

    from tidepost.rules import STOP_WORDS

    lists = [[w for w in re.findall("[a-z]{3,}", (d or "").lower()) if w not in STOP_WORDS] for d in DOCS]
    counts = Counter(w for ws in lists for w in ws)
    assert {r["word"]: r["n"] for r in words.word_counts(df).collect()} == dict(counts)

    freq = Counter(w for ws in lists for w in set(ws))
    top = sorted(freq, key=lambda w: (-freq[w], w))[:4]
    nodes = words.cooccurrence_nodes(df, 4).collect()
    assert [r["word"] for r in nodes] == top and nodes[0]["display_size"] == 10
    pairs = Counter(p for ws in lists for p in combinations(sorted(set(ws) & set(top)), 2))
    edges = {(r["w1"], r["w2"]): r["weight"] for r in words.cooccurrence_edges(df, 4).collect()}
    assert edges == {p: n for p, n in pairs.items() if n > 1}


def test_keywords_by_sentiment_skip_neutral_posts(spark):
    df = spark.createDataFrame(
        [("alpha beta", "Positive"), ("alpha", "Positive"), ("gamma", "Negative"), ("delta", "Neutral")],
        "text string, sentiment_label string",
    )
    rows = {(r["sentiment_label"], r["word"]): r["n"] for r in words.keywords_by_sentiment(df, 5).collect()}
    assert rows == {("Positive", "alpha"): 2, ("Positive", "beta"): 1, ("Negative", "gamma"): 1}
    assert [r["word"] for r in words.cloud_frequencies(df, 5, "positive").orderBy("word").collect()] == ["alpha", "beta"]


def test_stop_words_as_table(spark):
    df = spark.createDataFrame([("the",), ("sea",)], "word string")
    assert [r[0] for r in words.drop_stop_words(df, df.limit(0)).orderBy("word").collect()] == ["sea", "the"]
    assert [r[0] for r in words.drop_stop_words(df).collect()] == ["sea"]


def scored(spark, rows):
    return spark.createDataFrame(
        [(i, t, s, "Positive" if s > 0.05 else "Negative" if s < -0.05 else "Neutral") for i, (t, s) in enumerate(rows)],
        "post_id int, text string, sentiment_score double, sentiment_label string",
    )


def test_entities(spark):
    df = scored(spark, [("apple pie", 0.5), ("Apple and pear", -0.1), ("pear", 0.3), ("plum", 1.0)])
    tagged = entities.tag_entities(df, ["apple", "pear", "fig"])
    assert tagged.count() == 4
    rows = {r["entity"]: r for r in entities.entity_compare(tagged, ["apple", "pear", "fig"]).collect()}
    assert rows["apple"]["avg_score"] == 0.2 and rows["apple"]["positive_pct"] == 50.0
    assert (rows["fig"]["volume"], rows["fig"]["avg_score"], rows["fig"]["positive_pct"]) == (0, 0.0, 0.0)
    union = entities.union_entities({"a": df.limit(1), "b": df.limit(1)})
    assert sorted(r["entity"] for r in union.collect()) == ["a", "b"]


@pytest.mark.parametrize("a, b, winner", [(0.5, 0.44, "x"), (0.1, 0.2, "y"), (0.25, 0.25, "It's a Tie"), (0.25, 0.2, "It's a Tie")])
def test_winner(spark, a, b, winner):
    compared = spark.createDataFrame([("x", 1, a), ("y", 1, b)], "entity string, volume bigint, avg_score double")
    assert entities.entity_winner(compared, "x", "y").first()["winner"] == winner


def test_evaluation_with_a_class_that_is_never_predicted(spark):
    pairs = [("A", "A")] * 3 + [("A", "B")] + [("B", "A")] * 2 + [("C", "A")]
    counts = evaluation.confusion_counts(spark.createDataFrame(pairs, "actual string, predicted string"))
    rows = {r["label"]: r for r in evaluation.class_metrics(counts, ["A", "B", "C"]).collect()}
    assert (rows["A"]["precision"], rows["A"]["recall"], rows["A"]["support"]) == (0.5, 0.75, 4)
    assert (rows["C"]["precision"], rows["C"]["recall"], rows["C"]["f1"], rows["C"]["support"]) == (0.0, 0.0, 0.0, 1)
    matrix = {r["Actual"]: r for r in evaluation.confusion_matrix(counts, ["A", "B", "C"]).collect()}
    assert matrix["A"]["Pred_B"] == 1 and matrix["C"]["Pred_C"] == 0
    assert evaluation.overall_metrics(counts).first()["accuracy"] == 0.4286
    percent = {(r["actual"], r["predicted"]): r["pct"] for r in evaluation.confusion_percent(counts).collect()}
    assert percent[("A", "A")] == 75.0


def test_long_form(spark):
    df = spark.createDataFrame([("t", 1.0, 2.0)], "topic string, a double, b double")
    assert sorted(map(tuple, summaries.long_form(df, ["topic"], ["a", "b"]).collect())) == [("t", "a", 1.0), ("t", "b", 2.0)]
