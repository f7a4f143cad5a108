import time

import pytest
from pyspark.sql import functions as F

from tidepost.operators import rolling
from tidepost.plans import stream_queries
from tidepost.streaming import live, sinks, trending

POSTS = "post_id int, platform string, timestamp timestamp, text string, value double"


def posts(spark, rows):
    df = spark.createDataFrame(rows, "post_id int, platform string, t int, text string, value double")
    return df.select("post_id", "platform", F.timestamp_seconds("t").alias("timestamp"), "text", "value")


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(str(path))


def stream(spark, path):
    return spark.readStream.schema(POSTS).parquet(str(path))


def test_scored_stream_equals_batch(spark, tmp_path):
    df = posts(spark, [(i, "a", i, t, 0.0) for i, t in enumerate(["so GREAT today", "awful!!", "table", ""])])
    land(df, tmp_path / "in")
    got = sinks.drain(live.score_live(stream(spark, tmp_path / "in")).drop("value"), "t")
    expected = live.score_live(df).drop("value")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_alerts_have_an_excerpt(spark, tmp_path):
    text = "an awful, terrible, horrible and worthless thing that nobody would ever recommend"
    df = posts(spark, [(1, "a", 1, text, 0.0), (2, "a", 2, "fine", 0.0)])
    rows = live.alerts(live.score_live(df)).collect()
    assert [(r["post_id"], r["alert"], r["excerpt"]) for r in rows] == [(1, "High Negative", text[:50] + "...")]


def test_repeated_posts_and_empty_input(spark, tmp_path):
    df = posts(spark, [(1, "a", 1, "x", 0.0), (1, "a", 1, "x", 0.0), (2, "a", 5, "y", 0.0)])
    land(df, tmp_path / "in")
    land(df.filter("post_id = 2"), tmp_path / "in")
    got = sinks.drain(live.deduplicated(stream(spark, tmp_path / "in")), "t")
    assert sorted(r["post_id"] for r in got.collect()) == [1, 2]
    (tmp_path / "none").mkdir()
    nothing = sinks.drain(live.deduplicated(stream(spark, tmp_path / "none")), "t")
    assert nothing.count() == 0


def test_many_copies_of_one_post(spark, tmp_path):
    df = posts(spark, [(i if i % 3 else 0, "a", i, "x", 0.0) for i in range(300)])
    land(df, tmp_path / "in")
    kept = sinks.drain(live.deduplicated(stream(spark, tmp_path / "in"), salts=4), "t")
    assert sorted(r["post_id"] for r in kept.collect()) == sorted({i if i % 3 else 0 for i in range(300)})


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    day = 86400
    checkpoint, out = str(tmp_path / "cp"), str(tmp_path / "out")
    totals = lambda: live.windowed_totals(live.score_live(stream(spark, tmp_path / "in")), "1 hour", delay="10 minutes")
    for rows in ([(1, "a", day, "good", 0.0)], [(2, "a", 3 * day, "good", 0.0)], [(3, "a", 100, "good", 0.0)]):
        land(posts(spark, rows), tmp_path / "in")
        sinks.batches_to(totals(), out, checkpoint, "update").awaitTermination(120)
        time.sleep(1.1)
    starts = [r["window_start"] for r in spark.read.parquet(out).filter("posts > 0").collect()]
    assert len(starts) == 2


def test_entities_and_windows(spark, tmp_path):
    df = posts(spark, [(1, "a", 10, "apple is good", 0.0), (2, "a", 4000, "apple pear", 0.0)])
    land(df, tmp_path / "in")
    scored = live.score_live(stream(spark, tmp_path / "in"))
    rows = {r["entity"]: r["volume"] for r in sinks.drain_complete(live.entity_totals(scored, ["apple", "pear"]), "t").collect()}
    assert rows == {"apple": 2, "pear": 1}
    hourly = sinks.drain_update(live.windowed_totals(scored, delay="2 hours"), "t", ["window_start"])
    assert sorted(r["posts"] for r in hourly.collect()) == [1, 1]
    sliding = sinks.drain_update(live.windowed_totals(scored, slide="30 minutes", delay="2 hours"), "t", ["window_start"])
    assert sliding.agg(F.sum("posts")).first()[0] == 4


@pytest.mark.parametrize("pieces", [[40], [3, 1, 17, 19]])
def test_rolling_bands_over_batches_equal_batch(spark, tmp_path, pieces):
    rows = [(i, "ab"[i % 2], i, "", float(i * 37 % 23) + (500.0 if i == 30 else 0.0)) for i in range(40)]
    bands = sinks.RollingBands(str(tmp_path / "bands"), "platform", "value", "timestamp", "post_id", partitions=10)
    at = 0
    for n in pieces:
        land(posts(spark, rows[at : at + n]), tmp_path / "in")
        at += n
        bands.run_available(stream(spark, tmp_path / "in"))
        time.sleep(1.1)
    got = {r["post_id"]: r for r in bands.result(spark).collect()}
    batch = {r["post_id"]: r for r in rolling.rolling_stats(posts(spark, rows), value="value").collect()}
    assert got.keys() == batch.keys()
    early = set() if len(pieces) == 1 else {0, 1, 2, 3}  # series with one or two rows so far
    for k in batch.keys() - early:
        assert got[k]["rolling_mean"] == pytest.approx(batch[k]["rolling_mean"])
        assert got[k]["is_anomaly"] == batch[k]["is_anomaly"]
    assert got[30]["is_anomaly"]


def test_state_provider_is_put_back(spark):
    before = spark.conf.get(sinks.PROVIDER, None)
    with sinks.state_on_disk(spark):
        assert spark.conf.get(sinks.PROVIDER) == sinks.ROCKSDB
    assert spark.conf.get(sinks.PROVIDER, None) == before


@pytest.mark.parametrize("options", [{"window": 20}, {"exclude_current": True}, {}])
def test_bands_of_any_window_with_late_rows(spark, tmp_path, options):
    rows = [(i, "ab"[i % 2], i, "", float(i * 37 % 23)) for i in range(60)]
    order = [*range(0, 20), *range(30, 50), *range(20, 30), *range(50, 60)]
    bands = sinks.RollingBands(str(tmp_path / "bands"), "platform", "value", "timestamp", "post_id", **options)
    for at in range(0, 60, 20):
        land(posts(spark, [rows[i] for i in order[at : at + 20]]), tmp_path / "in")
        bands.run_available(stream(spark, tmp_path / "in"))
        time.sleep(1.1)
    got = {r["post_id"]: r for r in bands.result(spark).collect()}
    batch = {r["post_id"]: r for r in rolling.rolling_stats(posts(spark, rows), value="value", **options).collect()}
    assert got.keys() == batch.keys()
    for k in batch:
        assert got[k]["rolling_mean"] == pytest.approx(batch[k]["rolling_mean"]), k
        assert got[k]["is_anomaly"] == batch[k]["is_anomaly"]


def test_rows_without_a_time_come_with_the_first_slice(spark):
    df = posts(spark, [(i, "a", None if i % 4 == 0 else i, "x", 0.0) for i in range(40)])
    parts = [sorted(r["post_id"] for r in part.collect()) for part in stream_queries._slices(df, F.col("timestamp"))]
    assert len(parts) == 3 and sorted(sum(parts, [])) == list(range(40))
    assert set(range(0, 40, 4)) <= set(parts[0]) and all(parts)
    nothing = df.where("timestamp IS NULL")
    assert [part.count() for part in stream_queries._slices(nothing, F.col("timestamp"))] == [10]


def test_state_of_repeated_posts_falls_when_time_goes_on(spark, tmp_path):
    day, sizes = 86400, []
    for k in range(1, 4):  # each slice brings the posts of the one before along
        rows = [(1000 * j + i, "a", j * day + i, "x", 0.0) for j in (k - 1, k) if j for i in range(200)]
        land(posts(spark, rows), tmp_path / "in")
        query = sinks.append_to(live.deduplicated(stream(spark, tmp_path / "in"), salts=1), str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
        sizes.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress[-1:]))
    assert sorted(r["post_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1000 * k + i for k in range(1, 4) for i in range(200)]
    assert sizes[-1] <= 200


@pytest.mark.parametrize("size", [3, 100])
def test_trending_sketches_bound_every_count(spark, tmp_path, size):
    names = [f"phrase {chr(97 + k)}word" for k in range(12)]
    for batch in range(3):
        rows = [(i, "a", 86400 * (1 + i % 2) + i, names[(i * i + batch) % (4 + 4 * batch)] + ".", 0.0) for i in range(150)]
        land(posts(spark, rows), tmp_path / "in")
    sketches = trending.TrendingPhrases(str(tmp_path / "sketches"), size)
    reader = spark.readStream.schema(POSTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sketches.run_available(reader)
    every = spark.read.schema(POSTS).parquet(str(tmp_path / "in"))
    exact = {(r[0], r[1]): r[2] for r in trending.windowed_phrases(every).groupBy("window_start", "phrase").count().collect()}
    bounds = sketches.bounds(spark).collect()
    total = 450 / 2
    for r in bounds:
        assert r["low"] <= exact[r["window_start"], r["phrase"]] <= r["high"] and r["unseen"] <= total / (size + 1)
    held = {(r["window_start"], r["phrase"]) for r in bounds}
    assert all(n <= bounds[0]["unseen"] or size == 3 for key, n in exact.items() if key not in held)
    top = trending.leaders(every, trending.candidates(sketches.bounds(spark), 2), 2).collect()
    for start in {r["window_start"] for r in top}:
        expected = sorted(((-n, p) for (w, p), n in exact.items() if w == start))[:2]
        rows = sorted((r for r in top if r["window_start"] == start), key=lambda r: r["rank"])
        if all(r["certain"] for r in rows):
            assert [(-r["n"], r["phrase"]) for r in rows] == expected
    assert size == 3 or all(r["certain"] for r in top)


def test_listings_are_dealt_by_their_size(spark, monkeypatch, tmp_path):
    """A file of listings, which one task writes, has no more than so many bytes of text."""
    from tidepost.plans import registry, stream_queries

    docs = [(i, "en", f"text {i} " * 20, "s") for i in range(200)]
    spark.createDataFrame(docs, "doc_id bigint, lang string, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    path = str(tmp_path / "listing")
    monkeypatch.setattr(stream_queries, "fresh_path", lambda *_: path)
    monkeypatch.setattr(stream_queries, "LISTING_BYTES", 3000)
    found = registry.QUERIES["stream_listing"](spark, str(tmp_path))
    assert sorted(r["id"] for r in found.collect()) == sorted(str(d[0]) for d in docs)
    assert len(spark.read.json(path).inputFiles()) >= 8
