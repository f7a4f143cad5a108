import statistics

import pytest
from pyspark.sql import functions as F

from tidepost.operators import rolling

DDL = "post_id int, platform string, timestamp int, value double"


def by_hand(rows, exclude=False):
    out = {}
    for name in {r[1] for r in rows}:
        series = sorted((r for r in rows if r[1] == name), key=lambda r: (r[2], r[0]))
        for i, r in enumerate(series):
            frame = [x[3] for x in series[max(0, i - 9) : i + 1]]
            if exclude:
                frame = [x[3] for x in series[max(0, i - 10) : i]]
            mean = statistics.fmean(frame) if frame else r[3]
            std = statistics.stdev(frame) if len(frame) > 1 else 0.0
            if len(series) <= 2:
                mean, std, odd = r[3], 0.0, False
            else:
                odd = r[3] > mean + 2 * std or r[3] < mean - 2 * std
                odd = odd and (std > 0 or not exclude)
            out[r[0]] = (mean, std, odd)
    return out


def make(sizes):
    rows, i = [], 0
    for name, n in sizes.items():
        for k in range(n):
            # repeated times, an outlier now and then
            rows.append((i, name, k // 3, float((k * 7919) % 101) + (1000.0 if k % 53 == 5 else 0.0)))
            i += 1
    return rows


@pytest.mark.parametrize("partitions", [1, 7, 300, None])
@pytest.mark.parametrize("exclude", [False, True])
def test_split_series_give_the_same_result(spark, partitions, exclude):
    # one series holds most rows; others are shorter than a frame
    rows = make({"big": 3000, "one": 1, "two": 2, "three": 3, "five": 5, "ten": 10, "eleven": 11})
    df = spark.createDataFrame(rows, DDL)
    out = rolling.rolling_stats(df, value="value", partitions=partitions, exclude_current=exclude)
    expected = by_hand(rows, exclude)
    got = {r["post_id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for key, (mean, std, odd) in expected.items():
        assert got[key]["rolling_mean"] == pytest.approx(mean)
        assert got[key]["rolling_std"] == pytest.approx(std, abs=1e-9)
        assert got[key]["is_anomaly"] == odd
    assert any(v[2] for v in expected.values())


def test_one_series_is_spread_over_hundreds_of_partitions(spark):
    """Its rows are ranged in order, and no row of the tables between grows with them."""
    df = spark.createDataFrame(make({"big": 4000, "small": 40}), DDL)
    parts = rolling.ranged(df, "platform", ("timestamp", "post_id"), 300)
    sizes = [r["count"] for r in parts.filter("platform = 'big'").groupBy("_chunk").count().collect()]
    assert len(sizes) > 200 and max(sizes) < 4000 / 50
    bounds = parts.filter("platform = 'big'").groupBy("_chunk").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    ends = [(r["a"], r["b"]) for r in bounds.orderBy("_chunk").collect()]
    assert all(x[1] <= y[0] for x, y in zip(ends, ends[1:]))
    carried = rolling._carried(parts, "platform", ("timestamp", "post_id"), "value", 9)
    assert carried.groupBy("platform", "_chunk").count().agg(F.max("count")).first()[0] <= 10
    assert not any(t.startswith("array") for _, t in (*parts.dtypes, *carried.dtypes))


def test_null_series_and_null_times_are_kept(spark):
    rows = [(i, None, None if i < 3 else i, float(i)) for i in range(40)]
    out = rolling.rolling_stats(spark.createDataFrame(rows, DDL), value="value", partitions=10).collect()
    got = {r["post_id"]: r["rolling_mean"] for r in out}
    assert len(got) == 40 and got[39] == pytest.approx(34.5) and got[2] == pytest.approx(1.0)


def test_first_outlier_can_be_the_sixth_row(spark):
    rows = [(i, "s", i, 0.0) for i in range(5)] + [(5, "s", 5, 9.0)]
    df = spark.createDataFrame(rows, DDL)
    assert [r["post_id"] for r in rolling.anomalies(df, value="value").collect()] == [5]
    assert rolling.anomalies(df.filter("post_id <> 0"), value="value").count() == 0
