"""Roll-ups and the text index against passes over everything."""

import random

import pytest
from pyspark.sql import functions as F

from tidepost.operators import rollups, summaries
from tidepost.sources import text_index
from tidepost.sources.listing import matches

DDL = "post_id int, timestamp timestamp, platform string, topic string, sentiment_label string, sentiment_score double, user string"


def scored(spark, count, empty=False):
    rows = [
        (i, 86400 * (1 + i % 5) + i if i % 17 else None, "pq"[i % 2], ["A", "B", None][i % 3], ["Positive", "Negative", "Neutral"][i % 3],
         round((i % 41 - 20) / 20, 4) if i % 11 else None, f"u{i % 60}")
        for i in range(count)
    ]
    df = spark.createDataFrame(rows, DDL.replace("timestamp timestamp", "timestamp bigint"))
    return df.withColumn("timestamp", F.timestamp_seconds("timestamp"))


def test_totals_of_slices_equal_one_pass(spark, tmp_path):
    posts = scored(spark, 900)
    rollup = rollups.Rollup(spark, str(tmp_path / "a"))
    for k in range(3):
        rollup.add(posts.where(F.col("post_id") % 3 == k), k)
        rollup.add(posts.where(F.col("post_id") % 3 == k), k)  # a slice that is run again replaces itself
    for rows in (rollup.rows(), rollup.compacted(str(tmp_path / "b")).rows()):
        assert rollups.dashboard_kpis(rows).first() == summaries.dashboard_kpis(posts).first()
        assert sorted(map(str, rollups.daily_trend(rows).collect())) == sorted(map(str, summaries.daily_trend(posts).select("day", "sentiment_label", "n").collect()))
        exact = {r["day"]: r["n"] for r in posts.groupBy(F.to_date("timestamp").alias("day")).agg(F.countDistinct("user").alias("n")).collect()}
        assert all(abs(r["users"] - exact[r["day"]]) <= 3 for r in rollups.daily_users(rows).collect())
        assert rows.count() <= 6 * 2 * 3 * 3


def test_empty_slice(spark, tmp_path):
    rollup = rollups.Rollup(spark, str(tmp_path / "a"))
    rollup.add(scored(spark, 1).where("false"), 0)
    assert rollups.dashboard_kpis(rollup.rows()).first()["total"] == 0 and rollups.profile(rollup.rows()).first()["rows"] == 0


@pytest.mark.parametrize(
    ("pattern", "parts"),
    [("license", ["license"]), ("ab.cde", ["cde"]), ("abcd?xyz", ["abc", "xyz"]), ("abcd+e", ["abcd"]), ("a|bcdef", []), ("ab", []), ("^start.*end$", ["start", "end"]), ("a\\.bcd", [])],
)
def test_required_parts(pattern, parts):
    assert text_index.required_parts(pattern) == parts


def test_search_reads_fewer_files_and_finds_the_same(spark, tmp_path):
    rng = random.Random(3)
    letters = ["abcdef", "ghijkl", "mnopqr", "stuvwx"]
    rows = [(i, None if i % 50 == 7 else "".join(rng.choices(letters[i // 100] + " É", k=rng.randrange(60)))) for i in range(400)]
    rows += [(400, "needle in ghijkl"), (401, "NEEDLE, É"), (402, "")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    text_index.write_indexed(df.repartitionByRange(8, "doc_id"), str(tmp_path))
    for pattern in ("needle", "ne.dle", "abc", "xyz|abc", "É", "ghi.*jk", "no such thing", "needle in G", "a+b"):
        for literal in (False, True):
            found = text_index.search(spark, str(tmp_path), pattern, literal=literal)
            expected = sorted(r["doc_id"] for r in df.where(matches(F.col("text"), pattern, literal)).collect())
            assert sorted(r["doc_id"] for r in found.collect()) == expected, pattern
    every = len(spark.read.parquet(f"{tmp_path}/rows").inputFiles())
    assert every == 8 and len(text_index.files_to_read(spark, str(tmp_path), "needle")) == 1
    assert text_index.files_to_read(spark, str(tmp_path), "no such thing") == [] and text_index.files_to_read(spark, str(tmp_path), "a|b") is None
    assert len(text_index.files_to_read(spark, str(tmp_path), "ghij")) < every


def test_index_rows_are_bitmaps_however_many_texts(spark):
    texts = ["Needle in", "É", None, "straße 😀 end"] * 500 + ["x" * (text_index.PART_SIGNS - 1) + "yzw"]
    df = spark.createDataFrame([(f"f{i % 2}", t) for i, t in enumerate(texts)], "file string, text string").repartition(3, "file").sortWithinPartitions("file")
    rows = df.select("file", F.lower(F.coalesce("text", F.lit(""))).alias("text")).mapInArrow(text_index.bitmaps, "file string, bucket bigint, bitmap binary")
    found = rows.collect()
    assert len(found) <= 2 * text_index.BITS // text_index.BUCKET and all(len(r["bitmap"]) == text_index.BUCKET // 8 for r in found)
    wanted = {"f0": ["needle in", "xyz"], "f1": ["straße 😀 end"] if len(texts) % 2 == 0 else []}
    for file, own in wanted.items():
        for b in {int(b) for t in own for b in text_index.trigrams(t)}:
            held = next(r["bitmap"] for r in found if r["file"] == file and r["bucket"] == b // text_index.BUCKET)
            assert held[b % text_index.BUCKET // 8] >> b % 8 & 1
