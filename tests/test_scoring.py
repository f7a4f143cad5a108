import math
import re

import pytest
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions import lexicon
from tidepost.operators import lexicon_table, prepare, words

TEXTS = [
    "good", "not good", "very good", "not very good", "good but bad", "bad but good",
    "good!!", "good!!!!!!!", "bad!", "", None, "plain words only", "I don't like it, really awful",
    "never in a hundred years good", "slightly bad and extremely happy", "no no no good", "solid",
]


def compound_by_hand(text):
    ws = re.findall(r"[^\W_]+(?:'[^\W_]+)*", (text or "").lower())
    total = 0.0
    but = ws.index("but") if "but" in ws else None
    for i, w in enumerate(ws):
        if w not in rules.LEXICON:
            continue
        v = rules.LEXICON[w][0]
        before = [ws[i - d] if i - d >= 0 else None for d in (1, 2, 3)]
        v += math.copysign(1, v) * sum(rules.DEGREE_SHIFT.get(b, 0) * k for b, k in zip(before, rules.DEGREE_DECAY))
        if any(b in rules.NEGATORS for b in before):
            v *= rules.NEGATION_FACTOR
        if but is not None:
            v *= rules.BEFORE_CONTRAST if i < but else rules.AFTER_CONTRAST
        total += v
    if total:
        total += math.copysign(1, total) * min((text or "").count("!"), 4) * rules.EXCLAMATION_STEP
    return total / math.sqrt(total * total + 15)


def test_valence_agrees_with_a_plain_rewrite(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").coalesce(1)
    got = [r[0] for r in df.select(lexicon.valence_score(F.col("t"))).collect()]
    assert got == pytest.approx([compound_by_hand(t) for t in TEXTS], abs=6e-5)


def test_capitals_count_only_in_mixed_texts(spark):
    df = spark.createDataFrame([("this is GREAT news",), ("this is great news",), ("GREAT NEWS",), (None,)], "t string").coalesce(1)
    loud, plain, all_caps, none = [r[0] for r in df.select(lexicon.raw_valence_score(F.col("t"))).collect()]
    assert loud > plain == all_caps and none == 0.0


def test_shares_add_up(spark):
    df = spark.createDataFrame([("good and bad day",), ("",)], "t string").coalesce(1)
    first, empty = [r[0] for r in df.select(lexicon.valence_shares(F.col("t"))).collect()]
    assert first["positive"] + first["neutral"] + first["negative"] == pytest.approx(1, abs=0.002)
    assert empty.asDict() == {"compound": 0.0, "positive": 0.0, "neutral": 0.0, "negative": 0.0}


def test_polarity_rules(spark):
    rows = ["good", "not good", "very good", "good bad", "nothing", None]
    df = spark.createDataFrame([(t,) for t in rows], "t string").coalesce(1)
    got = [r[0] for r in df.select(lexicon.polarity_score(F.col("t"))).collect()]
    assert got == pytest.approx([0.7, -0.35, 0.91, 0.0, 0.0, 0.0])


def test_engines_and_consensus(spark):
    df = spark.createDataFrame([(1, "good"), (2, "awful"), (3, "table")], "post_id int, clean_text string")
    long = {(r["post_id"], r["engine"]): r for r in prepare.engines_long(df).collect()}
    assert len(long) == 6
    assert long[(1, "valence")]["label"] == "Positive" and "subjectivity" in long[(1, "polarity")]["details"]
    wide = {r["post_id"]: r for r in prepare.with_consensus(prepare.with_engines(df)).collect()}
    assert [wide[i]["consensus_label"] for i in (1, 2, 3)] == ["Positive", "Negative", "Neutral"]
    rows = {r["post_id"]: r for r in prepare.consensus_of_rows(prepare.engines_long(df)).collect()}
    for i in (1, 2, 3):
        assert rows[i]["consensus_score"] == pytest.approx(wide[i]["consensus_score"], abs=1e-4)


def test_consensus_leaves_failed_engines_out(spark):
    rows = spark.createDataFrame(
        [(1, "a", 0.5, "Positive"), (1, "b", -1.0, "Error")], "post_id int, engine string, score double, label string"
    )
    row = prepare.consensus_of_rows(rows).first()
    assert (row["consensus_score"], row["engine_count"]) == (0.5, 1)


def test_custom_scorer_keeps_columns(spark):
    df = spark.createDataFrame([(1, "aa"), (2, "b")], "id int, text string")
    out = prepare.score_with(df, lambda texts: texts.str.len().astype("float64"))
    assert sorted(map(tuple, out.collect())) == [(1, "aa", 2.0), (2, "b", 1.0)]


def test_keep_where_is_a_filter(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None), (3, -0.5)], "id int, s double")
    kept = prepare.keep_where(df, F.col("s") > 0)
    assert kept.columns == df.columns and [r["id"] for r in kept.collect()] == [1]


def test_large_lexicon_takes_the_salted_join(spark, monkeypatch):
    df = spark.createDataFrame([(i, "good good bad table") for i in range(50)], "post_id int, text string")
    small = words.lexicon_hits(df, words.lexicon_frame(spark))
    monkeypatch.setattr(words, "has_few_rows", lambda *_: False)
    large = words.lexicon_hits(df, words.lexicon_frame(spark))
    text = large._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    assert small.count() == 100


def test_lexicon_table_agrees_with_its_literal_form(spark, monkeypatch):
    rows = [
        (1, "Good good bad, but great!!"), (1, "another text under one id: good"), (2, None), (3, ""), (None, "not good"), (None, "very bad"),
        (4, "nothing known here"), (5, "never ever REALLY good, slightly bad but so useless"), (5, "never ever REALLY good, slightly bad but so useless"),
    ]
    df = spark.createDataFrame([(*r, "own") for r in rows], "post_id bigint, text string, hits string")
    lexicon = spark.createDataFrame(
        [("Good", 1.9, 0.7, 0.6), ("good", 2.5, 0.9, 0.1), ("bad", -2.5, -0.7, 0.67), ("great", 3.1, 0.8, None), ("useless", -1.8, -0.5, 0.2),
         (None, 1.0, 1.0, 1.0), ("a,b:c", 1.0, 1.0, 1.0)],
        "token string, valence double, polarity double, subjectivity double",
    )
    small = lexicon_table.literal_lexicon(lexicon)
    assert small["good"] == (1.9, 0.7, 0.6) and small["great"][2] == 0.0 and len(small) == 4
    results = []
    for most in (1000, 2):
        monkeypatch.setattr(lexicon_table, "LITERAL_ROWS", most)
        for engine in ("valence", "polarity"):
            out = lexicon_table.score_sentiment(df, lexicon, engine, text="text")
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert ("SortMergeJoin" in plan) == (most == 2) and out.columns == [*df.columns, "sentiment_score", "sentiment_label"]
            results.append(sorted(map(str, out.collect())))
        results.append(sorted(map(str, lexicon_table.engines_long(df.where("post_id = 5"), lexicon, text="text").collect())))
        parts = lexicon_table.with_valence(df, lexicon, text="text").select("post_id", "text", "valence.*")
        results.append(sorted(map(str, parts.collect())))
    assert results[:4] == results[4:] and len(results[0]) == len(rows)


def test_shipped_lexicon_as_a_table_gives_the_same_scores(spark, monkeypatch):
    texts = [(i, t) for i, t in enumerate(["not a good day", "very happy but so sad!", "the worst", "I love it", "slow and boring, never useful"])]
    df = spark.createDataFrame(texts, "post_id bigint, clean_text string")
    plain = prepare.score_sentiment(df).collect()
    monkeypatch.setattr(lexicon_table, "LITERAL_ROWS", 0)
    assert sorted(lexicon_table.score_sentiment(df, words.lexicon_frame(spark)).collect()) == sorted(plain)


def test_empty_lexicon(spark):
    df = spark.createDataFrame([(1, "good")], "post_id bigint, clean_text string")
    none = words.lexicon_frame(spark).limit(0)
    assert lexicon_table.score_sentiment(df, none).first()["sentiment_score"] == 0.0
    assert lexicon_table.score_sentiment(df, none, "polarity").first()["sentiment_label"] == "Neutral"


def test_a_lexicon_of_bounded_size_does_not_shuffle_words(spark, monkeypatch):
    """Sent to all tasks or met by merging, the table gives the scores of its literal form, and words
    travel without what is around them."""
    texts = ["Not a good, but a GREAT day!", "never very useless; good", None, "", "good", "good", "nothing here"]
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "post_id bigint, text string")
    lexicon = words.lexicon_frame(spark)
    expected = sorted(map(str, lexicon_table.engines_long(df, lexicon, text="text").collect()))
    monkeypatch.setattr(lexicon_table, "LITERAL_ROWS", 0)
    for most in (200_000, 0):
        monkeypatch.setattr(lexicon_table, "SENT_ROWS", most)
        out = lexicon_table.engines_long(df, lexicon, text="text")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (most > 0) and "contrasted" not in plan
        assert sorted(map(str, out.collect())) == expected
