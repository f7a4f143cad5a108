"""Bounded keyed state against the batch operators, batch by batch."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_streaming import land, posts, stream
from tidepost.operators import entities, rolling
from tidepost.streaming import rings, sinks


def run(df, path):
    """What is there to the end; the rows of state it leaves."""
    query = sinks.append_to(df, f"{path}/rows", f"{path}/checkpoint")
    query.awaitTermination()
    return query.lastProgress["stateOperators"][0]["numRowsTotal"] if query.lastProgress["stateOperators"] else 0


@pytest.mark.parametrize("options", [{"window": 20}, {"exclude_current": True}, {}])
def test_rolling_ring_with_late_rows(spark, tmp_path, options):
    rows = [(i, "ab"[i % 2], 1000 + i * 60, "", float(i * 37 % 23) + (500.0 if i == 41 else 0.0)) for i in range(60)]
    rows += [(100, "short", 1030, "", 1.0), (101, "short", 4000, "", 5.0), (102, None, 1040, "", 2.0)]
    order = [*range(0, 20), 60, 62, *range(30, 50), *range(20, 30), 61, *range(50, 60)]
    for at in range(0, 63, 21):
        land(posts(spark, [rows[i] for i in order[at : at + 21]]), tmp_path / "in")
        bands = rings.rolling_bands(stream(spark, tmp_path / "in"), value="value", delay="2 hours", **options)
        run(bands, tmp_path / "out")
    found = rings.newest_versions(spark.read.parquet(f"{tmp_path}/out/rows"), "platform", "post_id").collect()
    got = {r["post_id"]: r for r in found}
    batch = {r["post_id"]: r for r in rolling.rolling_stats(posts(spark, rows), value="value", **options).collect()}
    assert got.keys() == batch.keys() and len(found) == len(batch)
    for k, row in batch.items():
        for c in ("rolling_mean", "rolling_std", "upper_band", "lower_band"):
            assert got[k][c] == pytest.approx(row[c], abs=1e-9), (k, c)
        assert got[k]["is_anomaly"] == row["is_anomaly"] and got[k]["timestamp"] == row["timestamp"]
    assert got[41]["is_anomaly"]


def test_ring_state_stays_bounded_and_silent_series_go(spark, tmp_path):
    sizes = []
    for batch in range(4):
        rows = [(1000 * batch + i, "a", 1000 + 100_000 * batch + i, "", float(i)) for i in range(200)]
        rows += [(9000 + i, "silent", 1000 + i, "", 1.0) for i in range(5)] if batch == 0 else []
        land(posts(spark, rows), tmp_path / "in")
        sizes.append(run(rings.rolling_bands(stream(spark, tmp_path / "in"), value="value", delay="1 minute", retention_ms=60_000), tmp_path / "out"))
    assert max(sizes[1:]) <= sizes[0] + 20 and spark.read.parquet(f"{tmp_path}/out/rows").count() == 805


def test_newest_rows_of_an_entity(spark, tmp_path):
    texts = ["apple", "pear and apple", "none", "PEAR"]
    rows = [(i, "p", 1000 + (i * 7919) % 1000 // 3, texts[i % 4], float(i)) for i in range(300)]
    for at in range(0, 300, 100):
        land(posts(spark, rows[at : at + 100]), tmp_path / "in")
        tagged = entities.tag_entities(stream(spark, tmp_path / "in"), ["apple", "pear"])
        state = run(rings.newest_per_entity(tagged, 7, ["value", "text"], salts=3), tmp_path / "out")
        got = rings.newest_lists(spark.read.parquet(f"{tmp_path}/out/rows"), 7)
        whole = entities.latest_per_entity(entities.tag_entities(posts(spark, rows[: at + 100]), ["apple", "pear"]), 7)
        columns = ("entity", "timestamp", "post_id", "value", "text")
        assert sorted(got.select(*columns).collect()) == sorted(whole.select(*columns).collect())
        assert state <= 2 * 3 * (7 + 3)
    assert got.agg(F.count("*")).first()[0] == 14


class Held:
    """The state of one key, in place of the store."""

    def __init__(self):
        self.value, self.timers = None, []

    def getListState(self, *_):
        return Held()

    getValueState = getListState

    def get(self):
        return self.value or []

    def exists(self):
        return self.value is not None

    def put(self, value):
        self.value = value

    update = put

    def clear(self):
        self.value = None

    def listTimers(self):
        return self.timers

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)

    def getCurrentWatermarkInMs(self):
        return 0


def test_a_hot_series_comes_out_in_parts_of_bounded_size():
    many = 3 * rings.OUT_ROWS + 7
    ids = np.random.default_rng(3).permutation(many)
    rows = pd.DataFrame({"t": pd.to_datetime(1_000_000_000 + ids // 3, unit="s"), "k": ids, "x": (ids * 37 % 101).astype(float)})
    ring = rings.RollingRing(["s", "t", "k", "x"], 10, 2.0, False, 1000)
    ring.init(Held())
    half = many // 2
    sizes, found = [], []
    for batch in (rows.iloc[:half], rows.iloc[half:]):
        for out in ring.handleInputRows(("a",), (batch.iloc[i : i + 10_000] for i in range(0, len(batch), 10_000)), Held()):
            sizes.append(len(out))
            found.append(out[["k", "rolling_mean", "rolling_std", "version"]])
    last = pd.concat(found).sort_values("version").drop_duplicates("k", keep="last").sort_values("k")
    x = rows.sort_values("k")["x"]
    assert max(sizes) <= rings.OUT_ROWS and len(last) == many
    np.testing.assert_allclose(last["rolling_mean"], x.rolling(10, min_periods=1).mean(), atol=1e-9)
    np.testing.assert_allclose(last["rolling_std"], x.rolling(10, min_periods=1).std().fillna(0), atol=1e-9)


def test_rows_without_a_key_come_first_of_their_time(spark, tmp_path):
    rows = [(i if i % 5 else None, "a", 1000 + i // 5, "", float(i)) for i in range(40)]
    land(posts(spark, rows), tmp_path / "in")
    run(rings.rolling_bands(stream(spark, tmp_path / "in"), value="value"), tmp_path / "out")
    got = {r["value"]: r["rolling_mean"] for r in spark.read.parquet(f"{tmp_path}/out/rows").collect()}
    batch = {r["value"]: r["rolling_mean"] for r in rolling.rolling_stats(posts(spark, rows), value="value").collect()}
    assert got == pytest.approx(batch) and len(got) == 40
