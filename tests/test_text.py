import re

import pytest
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions import labels, text as tx, times
from tidepost.operators import prepare


def one(spark, rows, ddl, **columns):
    df = spark.createDataFrame(rows, ddl).coalesce(1)
    return [r.asDict() for r in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]


def cleaned_by_hand(text):
    if not text:
        return ""
    for pattern, new in (
        (r"http\S+|www\.\S+", ""), (r"@\w+", ""), ("#", ""), (r"[^A-Za-z0-9\s!?.,']", ""), (r"\s+", " "),
    ):
        text = re.sub(pattern, new, text)
    return text.strip().lower()


EDGE_TEXTS = [
    None, "", "   ", "http://only.example/url", "www.x.y z", "@mañana hi", "#Tag", "rockets 🚀 up",
    "a b  c\td\ne", "don't!? Stop... it,now", "MiXeD CaSe", "Ünïcödé words", "a@b.c x",
]


def test_clean_text_agrees_with_python(spark):
    rows = [(t,) for t in EDGE_TEXTS]
    got = [r["c"] for r in one(spark, rows, "t string", c=tx.clean_text(F.col("t")))]
    assert got == [cleaned_by_hand(t) for t in EDGE_TEXTS]


def test_tokens_drop_short_words(spark):
    rows = [("a bb  c dd",), ("",), ("x y",)]
    got = one(spark, rows, "c string", t=tx.tokens(F.col("c")), n=F.size(tx.tokens(F.col("c"))))
    assert [r["t"] for r in got] == [["bb", "dd"], [], []]
    assert [r["n"] for r in got] == [2, 0, 0]


def test_topic_first_rule_wins_and_substrings_count(spark):
    rows = [("rain and music",), ("music for the game",), ("nothing here to find",), ("film score",), ("",)]
    got = one(spark, rows, "c string", t=tx.topic_of(F.col("c")), w=tx.topic_of(F.col("c"), whole_word=True))
    # "rain" holds "ai"
    assert [r["t"] for r in got] == ["Technology", "Music", "General", "Entertainment", "General"]
    assert [r["w"] for r in got] == ["Music", "Music", "General", "Entertainment", "General"]


def test_topic_rules_may_be_regular_expressions(spark):
    own = (("Numbers", "[0-9]{3}"), ("Words", "one|two"))
    got = one(spark, [("has 123",), ("TWO",), ("12",)], "c string", t=tx.topic_of(F.col("c"), own))
    assert [r["t"] for r in got] == ["Numbers", "Words", "General"]


def test_short_number_rounds_like_c(spark):
    numbers = [0, 7, 999, 1000, 1150, 1250, 1350, 1500, 999949, 999999, 1000000, 2500000, -1500, -3]
    got = one(spark, [(n,) for n in numbers], "n bigint", s=tx.short_number(F.col("n")))

    def by_hand(n):
        if abs(n) >= 1_000_000:
            return f"{n / 1_000_000:.1f}M"
        return f"{n / 1_000:.1f}K" if abs(n) >= 1_000 else str(n)

    assert [r["s"] for r in got] == [by_hand(n) for n in numbers]


def test_phrases_stop_at_stop_words_and_punctuation(spark):
    got = one(spark, [("The Bright Future of electric cars, and more BIG\nwaves 2x",)], "t string", p=tx.phrases(F.col("t")))
    assert got[0]["p"] == ["bright future", "electric cars", "waves"]


def test_excerpt_and_labels(spark):
    got = one(
        spark, [("abcdef", "POSITIVE"), ("abc", "neutral")], "t string, l string",
        e=tx.excerpt(F.col("t"), 4), l=tx.proper_label(F.col("l")),
    )
    assert [(r["e"], r["l"]) for r in got] == [("abcd…", "Positive"), ("abc", "Neutral")]


def test_stop_words():
    assert len(rules.STOP_WORDS) == 134 == len(set(rules.STOP_WORDS))


@pytest.mark.parametrize(
    "date, shown",
    [
        ("Mon May 11 03:17:40 UTC 2009", "2009-05-11 03:17:40"),
        ("Mon Apr 06 22:19:45 PDT 2009", "2009-04-06 22:19:45"),
        ("Tue Jun 2 01:02:03 UTC 2009", "2009-06-01 00:00:00"),
        ("junk", "2009-06-01 00:00:00"),
        (None, "2009-06-01 00:00:00"),
    ],
)
def test_post_dates(spark, date, shown):
    got = one(spark, [(date,)], "d string", t=F.date_format(times.post_timestamp(F.col("d")), "yyyy-MM-dd HH:mm:ss"))
    assert got[0]["t"] == shown


def test_zone_can_be_converted(spark):
    got = one(
        spark, [("Mon Apr 06 22:19:45 PDT 2009",)], "d string",
        t=F.date_format(times.parse_post_date(F.col("d"), convert_zone=True), "yyyy-MM-dd HH:mm:ss"),
        bad=times.lenient_timestamp(F.lit("no time")),
    )
    assert got[0]["t"] == "2009-04-07 05:19:45" and got[0]["bad"] is None


def test_target_codes(spark):
    got = one(
        spark, [(0,), (2,), (4,), (1,), (None,)], "t int",
        l=labels.target_label(F.col("t")), s=labels.target_score(F.col("t")),
    )
    assert [r["l"] for r in got] == ["Negative", "Neutral", "Positive", "Neutral", "Neutral"]
    assert [r["s"] for r in got] == [-0.6, 0.0, 0.6, 0.0, 0.0]


def test_thresholds(spark):
    scores = [-0.8, -0.05, -0.050001, 0.0, 0.05, 0.050001, 0.5, -0.5, None]
    got = one(
        spark, [(s,) for s in scores], "s double",
        strict=labels.classify(F.col("s")), inclusive=labels.classify(F.col("s"), inclusive=True),
    )
    neg, neu, pos = "Negative", "Neutral", "Positive"
    assert [r["strict"] for r in got] == [neg, neu, neg, neu, neu, pos, pos, neg, neu]
    assert [r["inclusive"] for r in got] == [neg, neg, neg, neu, pos, pos, pos, neg, neu]


def test_prepare_text_drops_nulls_only(spark):
    df = spark.createDataFrame([(1, "Some TEXT"), (2, None), (3, " ")], "id int, text string")
    rows = {r["id"]: r for r in prepare.prepare_text(df).collect()}
    assert set(rows) == {1, 3}
    assert rows[1]["clean_text"] == "some text" and rows[1]["tokens"] == ["some", "text"]


def test_prepare_posts_from_csv_layout(spark):
    raw = spark.createDataFrame(
        [(4, 11, "Mon May 11 03:17:40 UTC 2009", "NO_QUERY", "ann", "I love this song"), (0, 12, "x", "q", "bob", " ")],
        "target int, ids bigint, date string, flag string, user string, text string",
    )
    out = prepare.prepare_posts(raw).collect()
    assert len(out) == 1
    row = out[0]
    assert (row["platform"], row["topic"], row["sentiment_label"], row["word_count"]) == ("Twitter", "Music", "Positive", 3)
    assert row["likes"] == 11 * 37 % 5000 and row["post_id"] == 11
    assert prepare.prepare_posts(raw).columns == ["post_id", *prepare.PREPARED_COLUMNS]


def test_unknown_engine_is_refused(spark):
    with pytest.raises(ValueError):
        prepare.run_pipeline(spark.range(1), engine="none")
