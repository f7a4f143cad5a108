"""Running streams into shared tables.

Rows go to parquet files written by the executors, never through the driver. Changing
results (update and complete mode) are written once per batch under the batch id, so a
batch that is run again after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepost.operators.rolling import WINDOW_ROWS, rolling_stats
from tidepost.sources.workdir import fresh_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_on_disk(spark: SparkSession):
    """Keyed state in RocksDB instead of executor heap, for streams started inside."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _finish(query, seconds: int | None) -> None:
    """Waits for the end; only a caller's own limit stops a stream before it."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream did not finish within {seconds} s")


def _start(writer, spark: SparkSession, checkpoint: str, every: str | None):
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    with state_on_disk(spark):
        return writer.trigger(**trigger).start()


def append_to(df: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """Start an append-only stream into parquet; without ``every`` it stops when caught up."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer, df.sparkSession, checkpoint, every)


def batches_to(df: DataFrame, path: str, checkpoint: str, mode: str, every: str | None = None):
    """Start an update or complete stream; each batch owns one folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _start(df.writeStream.outputMode(mode).foreachBatch(write), df.sparkSession, checkpoint, every)


def drain(df: DataFrame, name: str, seconds: int | None = None, steps: Iterable = (None,)) -> DataFrame:
    """Append everything available and read it back.

    The stream is run once for each of ``steps``, from where it stopped; a generator may make new
    files arrive between them.
    """
    spark = df.sparkSession
    out = fresh_path(spark, name)
    for _ in steps:
        _finish(append_to(df, f"{out}/rows", f"{out}/checkpoint"), seconds)
    return spark.read.schema(df.schema).parquet(f"{out}/rows")


def drain_complete(df: DataFrame, name: str, seconds: int | None = None, steps: Iterable = (None,)) -> DataFrame:
    """Complete mode: the result is the newest batch."""
    rows = _drain_batches(df, name, "complete", seconds, steps)
    newest = rows.agg(F.max("batch")).scalar()
    return rows.filter(F.col("batch") == newest).drop("batch")


def drain_update(df: DataFrame, name: str, keys: list[str], seconds: int | None = None, steps: Iterable = (None,)) -> DataFrame:
    """Update mode: per key, the value of the newest batch that changed it."""
    rows = _drain_batches(df, name, "update", seconds, steps)
    values = [c for c in df.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*keys, "v.*")


def _drain_batches(df: DataFrame, name: str, mode: str, seconds: int | None, steps: Iterable) -> DataFrame:
    spark = df.sparkSession
    out = fresh_path(spark, name)
    for _ in steps:
        _finish(batches_to(df, f"{out}/rows", f"{out}/checkpoint", mode), seconds)
    return spark.read.parquet(f"{out}/rows")


class RollingBands:
    """Rolling bands over a stream, batch by batch, with the last rows of each series as state.

    Row-count windows do not exist on streams. Each batch is put below the rows carried from
    the batch before and goes through the batch operator, which splits long series; then the
    last rows per series are written for the next batch. Two state folders are used in turn:
    a batch reads one and replaces the other, so running it again gives the same result.

    Where a batch has rows older than the newest ones of their series, the rows from there on
    are computed again with what stands before them, and written under the new batch;
    :meth:`result` takes the newest version of each row. The rule for series of one or two rows
    looks at the rows seen so far. ``key`` tells the rows of a series apart.
    """

    def __init__(self, path: str, series: str, value: str, ts: str, key: str, partitions: int | None = None, **options):
        self.path, self.series, self.value, self.ts, self.key = path, series, value, ts, key
        self.partitions, self.options = partitions, options
        window = options.get("window", WINDOW_ROWS)
        # three rows tell a short series from a long one
        self.carry = max(window - (0 if options.get("exclude_current") else 1), 3)

    def _state(self, batch_id: int) -> str:
        return f"{self.path}/state/{batch_id % 2}"

    def _place(self) -> Column:
        return F.struct(F.col(self.ts).alias("t"), F.col(self.key).alias("k"))

    def _last(self, rows: DataFrame) -> DataFrame:
        """The last rows of each series; cut per map task before the shuffle."""
        newest = W.partitionBy(self.series).orderBy(F.col(self.ts).desc_nulls_last(), F.col(self.key).desc_nulls_last())
        return rows.withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= self.carry).drop("_back")

    def _before(self, spark: SparkSession, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """Rows to stand before the batch, and old rows to compute again."""
        carried = spark.read.schema(batch.schema).parquet(self._state(batch_id - 1))
        same = F.col("_series").eqNullSafe(F.col(self.series))
        newest = carried.groupBy(F.col(self.series).alias("_series")).agg(F.max(self._place()).alias("_newest"))
        late = batch.join(newest, same).filter(self._place() < F.col("_newest"))
        late = late.groupBy("_series").agg(F.min(self._place()).alias("_from"))
        if late.isEmpty():
            return carried, batch.limit(0)
        known = self.result(spark).select(*batch.columns).join(late, same, "left")
        again = known.filter(self._place() >= F.col("_from")).select(*batch.columns)
        earlier = known.filter(F.col("_from").isNull() | (self._place() < F.col("_from"))).select(*batch.columns)
        return self._last(earlier), again

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = batch.withColumn("_new", F.lit(True))
            if batch_id > 0:
                context, again = self._before(spark, batch, batch_id)
                rows = rows.unionByName(again.withColumn("_new", F.lit(True)))
                rows = rows.unionByName(context.withColumn("_new", F.lit(False)))
            stats = rolling_stats(
                rows, self.series, self.value, self.ts, self.key, partitions=self.partitions, **self.options
            )
            stats.filter("_new").drop("_new").write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")
            self._last(rows.select(*batch.columns)).write.mode("overwrite").parquet(self._state(batch_id))
        finally:
            batch.unpersist()

    def start(self, df: DataFrame, every: str | None = None):
        return _start(
            df.writeStream.outputMode("append").foreachBatch(self),
            df.sparkSession,
            f"{self.path}/checkpoint",
            every,
        )

    def run_available(self, df: DataFrame, seconds: int | None = None) -> None:
        _finish(self.start(df), seconds)

    def result(self, spark: SparkSession) -> DataFrame:
        """Every row once, in its newest version."""
        rows = spark.read.parquet(f"{self.path}/rows")
        keys = [F.col(self.series).alias("_s"), F.col(self.key).alias("_k")]
        newest = rows.groupBy(*keys).agg(F.max("batch").alias("_b"))
        same = F.col("_s").eqNullSafe(F.col(self.series)) & F.col("_k").eqNullSafe(F.col(self.key))
        return rows.join(newest, same & (F.col("_b") == F.col("batch")), "left_semi").drop("batch")
