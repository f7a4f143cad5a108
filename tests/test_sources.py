import pytest
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions.text import joined_text
from tidepost.sources import demo, files, listing, workdir
from tidepost.streaming import live, sinks


def test_demo_posts(spark):
    df = demo.demo_posts(spark, 50)
    assert df.count() == 50
    assert {"text", "sentiment_label", "sentiment_score", "platform"} <= set(df.columns)
    many = demo.demo_posts(spark, 20000, partitions=4)
    shares = {r[0]: r[1] / 20000 for r in many.groupBy("sentiment_label").count().collect()}
    assert abs(shares["positive"] - 0.4) < 0.02 and abs(shares["negative"] - 0.3) < 0.02
    for label, (low, high) in demo.SCORE_RANGE.items():
        row = many.filter(F.col("sentiment_label") == label).agg(F.min("sentiment_score"), F.max("sentiment_score")).first()
        assert low <= row[0] <= row[1] <= high
    assert many.agg(F.countDistinct("topic"), F.countDistinct("platform")).first()[:] == (10, 5)
    times = [r[0] for r in df.select("timestamp").collect()]
    assert times == sorted(times)


def test_csv_posts_round_trip(spark, tmp_path):
    rows = [
        (4, 1, "Mon May 11 03:17:40 UTC 2009", "NO_QUERY", "ann", 'he said "hi", then left'),
        (0, 2, "Mon May 11 03:17:41 UTC 2009", "NO_QUERY", "bob", " ñandú über café "),
        (2, 3, "Mon May 11 03:17:42 UTC 2009", "q", "cid", "a,b,,c"),
    ]
    df = spark.createDataFrame(rows, files.CSV_SCHEMA)
    files.write_csv_posts(df, str(tmp_path / "posts"))
    back = files.read_csv_posts(spark, str(tmp_path / "posts"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert files.read_csv_posts(spark, str(tmp_path / "posts"), limit=2).count() == 2


def test_latin_bytes_are_read(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes('"4","7","d","f","u","caf\xe9 ""x"""\n'.encode("latin-1"))
    assert files.read_csv_posts(spark, str(tmp_path / "*.csv")).first()["text"] == 'café "x"'


def test_export_keeps_display_columns(spark, tmp_path):
    df = demo.demo_posts(spark, 30).withColumn("extra", F.lit(1)).drop("shares")
    files.export_csv(df, str(tmp_path / "csv"))
    shown = [c for c in rules.DISPLAY_COLUMNS if c != "shares"]
    back = files.read_export(spark, str(tmp_path / "csv"), files.existing_columns(df).schema)
    assert back.columns == shown and back.count() == 30
    files.export_parquet(df, str(tmp_path / "pq"))
    one_day = df.select(F.to_date("timestamp")).first()[0]
    read = spark.read.parquet(str(tmp_path / "pq")).filter(F.col("day") == F.lit(one_day))
    assert "PartitionFilters: [isnotnull(day" in read._jdf.queryExecution().toString()
    assert read.count() == df.filter(F.to_date("timestamp") == F.lit(one_day)).count()


def test_listing(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"data": {"children": ['
        '{"data": {"id": "1", "title": "Hi", "selftext": "there", "author": "x", "created_utc": 10.0, "permalink": "/r/1", "subreddit": "s"}},'
        '{"data": {"id": "2", "title": "", "selftext": "", "author": "y", "created_utc": 20.0}},'
        '{"data": {"id": "3", "title": "Only title", "author": "z", "created_utc": 30.0, "permalink": "/r/3"}}]}}'
    )
    flat = listing.flatten_listing(listing.read_listing(spark, str(tmp_path)))
    rows = listing.newest(flat, 10).collect()
    assert [(r["id"], r["text"]) for r in rows] == [("3", "Only title"), ("1", "Hi there")]
    assert rows[1]["url"].endswith("/r/1") and rows[1]["timestamp"].second == 10
    found = listing.search_newest(flat, "TITLE", 5)
    assert [r["id"] for r in found.collect()] == ["3"]
    stream = listing.flatten_listing(listing.stream_listing(spark, str(tmp_path)))
    assert stream.isStreaming and stream.columns == flat.columns


def test_preview_takes_existing_columns(spark):
    df = demo.demo_posts(spark, 300)
    assert files.preview(df).count() == 200


class FakeSession:
    """Just what the choice of a folder looks at."""

    def __init__(self, named=None, master="local[2]"):
        self.named, self.master, self.set_to = named, master, None
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return self.named if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.set_to

    def setCheckpointDir(self, path):
        self.set_to = path


def test_shared_dir_comes_from_the_session():
    assert workdir.shared_dir(FakeSession("hdfs://x/y/")) == "hdfs://x/y"
    unset = FakeSession()
    own = workdir.shared_dir(unset)
    assert own and workdir.shared_dir(unset) == own
    assert workdir.fresh_path(unset, "a") != workdir.fresh_path(unset, "a")
    with pytest.raises(ValueError):
        workdir.shared_dir(FakeSession(master="yarn"))


def test_texts_of_several_lines_and_white_space(spark, tmp_path):
    texts = ["one\ntwo", "a\r\nb", "back\\slash \\n", 'quote " , comma', "plain"]
    rows = [(4, i, "d", "f", "u", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, files.CSV_SCHEMA)
    files.write_csv_posts(df, str(tmp_path / "posts"))
    back = files.read_csv_posts(spark, str(tmp_path / "posts"), escaped=True)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    pairs = spark.createDataFrame([("\n", "\t"), (" a\u00a0", "\nb ")], "t string, b string")
    assert [r[0] for r in pairs.select(joined_text(F.col("t"), F.col("b"))).collect()] == ["", "a\u00a0 \nb"]


def test_a_stream_reads_its_own_folder_only(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "posts"))
    spark.range(5).write.parquet(str(tmp_path / "posts_old"))
    assert sinks.drain(live.stream_table(spark, str(tmp_path / "posts")), "own").count() == 3
