"""What the plans may and may not contain."""

import re

import pytest

from tests.checker import compare_rows, connect
from __spark_entry__ import entry, oracle_sql, queries
from tidepost.plans.catalog import ORACLES

SMALL = "/root/testdata/sf0.001"

# Python runs only where a caller's own scorer is the point
PYTHON_ALLOWED = {"custom_scorer"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plan(spark, key):
    return plan_of(queries()[key](spark, SMALL))


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["Topic", "Posts", "Avg Score", "Total Likes"] and rows.count() > 0


def test_every_check_has_a_query():
    assert set(oracle_sql()) <= set(queries()) and len(queries()) > 90


@pytest.mark.parametrize("key", ["sort_recent", "sort_liked", "sort_shared", "preview_rows", "live_feed", "top_keywords", "cooc_nodes", "trending_phrases"])
def test_top_k_is_bounded(spark, key):
    text = plan(spark, key)
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize("key", ["keywords_by_sentiment", "rolling_stats", "entity_union"])
def test_rows_per_group_are_cut_before_the_shuffle(spark, key):
    text = plan(spark, key)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


@pytest.mark.parametrize("key", ["clean_text", "score_valence", "analyse_polarity", "prepare_posts", "map_label"])
def test_row_local_work_does_not_shuffle(spark, key):
    assert "Exchange" not in plan(spark, key)


def test_scans_read_needed_columns_only(spark):
    assert "ReadSchema: struct<text:string>" in plan(spark, "top_keywords")
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan(spark, "map_label")


@pytest.mark.parametrize("key", ["sort_recent", "sort_liked", "live_feed", "preview_rows", "entity_union"])
def test_rows_are_picked_before_they_are_scored(spark, key):
    """In the plan's text the operator that picks rows stands below the scores and cleaning."""
    text = plan(spark, key)
    picked = max(text.rfind("TakeOrderedAndProject"), text.rfind("WindowGroupLimit"))
    below = text[text.index("\n", picked):]
    assert "regexp_extract_all" not in below and "regexp_replace" not in below


def test_lexicon_table_is_broadcast(spark):
    """The lexicon, and not the words of all texts."""
    text = plan(spark, "lexicon_hits")
    assert "BroadcastHashJoin" in text and "BuildRight" in text and "BuildLeft" not in text


def test_a_score_is_evaluated_once(spark):
    pattern = r"regexp_extract_all(lower(clean_text"
    for key in ("keywords_by_sentiment", "score_histogram", "multi_engine_scores", "filter_sentiment"):
        assert plan(spark, key).count(pattern) <= (2 if key == "multi_engine_scores" else 1), key


@pytest.mark.parametrize("key", ["filter_topic", "search_summary", "train_rows"])
def test_a_text_is_cleaned_once(spark, key):
    """Hash signs are taken out of a text once in cleaning."""
    assert plan(spark, key).count(", #, ") == 1


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_against_sql(spark, key):
    """Same rows as the SQL; no cross product, and no Python in the plan."""
    df = queries()[key](spark, SMALL)
    text = plan_of(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if key not in PYTHON_ALLOWED:
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow", text)
    ok, message = compare_rows(connect(SMALL), df, ORACLES[key])
    assert ok, message
