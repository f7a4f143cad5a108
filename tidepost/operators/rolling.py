"""Rolling mean, deviation, bands and outliers over the last rows of each series.

``Window.partitionBy(series)`` alone would put a whole series into one task, and one series
may hold a third of all rows. All rows are therefore ranged by (series, time, id) into partitions
of about equal size, whatever the series; the partitions are written, so that every later read sees
the same ones, and each is handed the few rows of its series that stand before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepost.sources.workdir import fresh_path

# Frame length and band width.
WINDOW_ROWS = 10
BAND_WIDTH = 2.0


def ranged(df: DataFrame, series: str, order: tuple[str, str], partitions: int | None = None) -> DataFrame:
    """``df`` with ``_chunk``, the number of the range of (series, time, id) a row is in, as a stored table.

    Spark samples the input for the bounds and reads it once more to deal it out. The ranges are
    written because a range computed again may have other bounds.
    """
    by = [F.col(c) for c in (series, *order)]
    dealt = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    path = fresh_path(df.sparkSession, "ranges")
    rows = dealt.withColumn("_chunk", F.spark_partition_id())
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def _carried(rows: DataFrame, series: str, order: tuple[str, str], value: str, before: int) -> DataFrame:
    """Per chunk: the up to ``before`` rows preceding it, and a header row that says how many
    rows the series has (exact up to three, a lower bound beyond).

    ``row_number() <= k`` is cut to k rows per chunk in every map task before the shuffle, so
    this side holds a few rows per chunk whatever the size of the input.
    """
    ts, key = order
    latest_first = W.partitionBy(series, "_chunk").orderBy(
        F.col(ts).desc_nulls_last(), F.col(key).desc_nulls_last()
    )
    tails = (
        rows.select(series, "_chunk", F.struct(ts, key, value).alias("r"), ts, key)
        .withColumn("_back", F.row_number().over(latest_first))
        .filter(F.col("_back") <= max(before, 3))
        .groupBy(series, "_chunk")
        .agg(F.sort_array(F.collect_list("r")).alias("tail"))
    )
    # a chunk has at least one row, so ``before`` chunks back are always enough
    earlier = W.partitionBy(series).orderBy("_chunk").rowsBetween(-before, -1)
    chunks = tails.select(
        series,
        "_chunk",
        F.sum(F.size("tail")).over(W.partitionBy(series)).alias("_series_rows"),
        F.flatten(F.collect_list("tail").over(earlier)).alias("past"),
    )
    last = F.slice("past", F.greatest(F.size("past") - before + 1, F.lit(1)), before)
    header = F.array(F.lit(None).cast(tails.schema["tail"].dataType.elementType))
    return chunks.select(series, "_chunk", "_series_rows", F.explode(F.concat(header, last)).alias("r")).select(
        series, "_chunk", "_series_rows", f"r.{ts}", f"r.{key}", f"r.{value}"
    )


def rolling_stats(
    df: DataFrame,
    series: str = "platform",
    value: str = "sentiment_score",
    ts: str = "timestamp",
    key: str = "post_id",
    window: int = WINDOW_ROWS,
    width: float = BAND_WIDTH,
    exclude_current: bool = False,
    partitions: int | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Adds ``rolling_mean``, ``rolling_std``, ``upper_band``, ``lower_band``, ``is_anomaly``.

    The frame is the last ``window`` rows of the series up to the current row, or the
    ``window`` rows before it with ``exclude_current``. A series of one or two rows has bands
    equal to its values and no outliers. ``value`` must not be null. ``partitions`` is the number of
    ranges; Spark decides without it. The result is the same for any.
    """
    before = window if exclude_current else window - 1
    rows = ranged(df, series, (ts, key), partitions)
    carried = _carried(rows, series, (ts, key), value, before)
    both = rows.withColumn("_own", F.lit(True)).unionByName(
        carried.withColumn("_own", F.lit(False)), allowMissingColumns=True
    )
    # header rows have no time: they sort first and carry no value into the frame
    in_time = W.partitionBy(series, "_chunk").orderBy(
        F.col(ts).asc_nulls_first(), F.col(key).asc_nulls_first()
    )
    frame = in_time.rowsBetween(-before, -1 if exclude_current else 0)
    so_far = in_time.rowsBetween(W.unboundedPreceding, 0)

    def shown(c: Column) -> Column:
        return F.round(c, digits) if digits is not None else c

    x = F.col(value)
    out = (
        both.withColumn("_mean", F.avg(value).over(frame))
        .withColumn("_std", F.coalesce(F.stddev_samp(value).over(frame), F.lit(0.0)))
        .withColumn("_total", F.first("_series_rows", ignorenulls=True).over(so_far))
        .filter("_own")
        .withColumn("_short", F.col("_total") <= 2)
        .withColumn("_mean", F.when(F.col("_short"), x).otherwise(F.coalesce("_mean", x)))
        .withColumn("_std", F.when(F.col("_short"), 0.0).otherwise(F.col("_std")))
        .withColumn("_up", F.col("_mean") + width * F.col("_std"))
        .withColumn("_down", F.col("_mean") - width * F.col("_std"))
    )
    known = F.lit(True) if not exclude_current else F.col("_std") > 0
    return out.select(
        *df.columns,
        shown(F.col("_mean")).alias("rolling_mean"),
        shown(F.col("_std")).alias("rolling_std"),
        shown(F.col("_up")).alias("upper_band"),
        shown(F.col("_down")).alias("lower_band"),
        (~F.col("_short") & known & ((x > F.col("_up")) | (x < F.col("_down")))).alias("is_anomaly"),
    )


def anomalies(df: DataFrame, **options) -> DataFrame:
    return rolling_stats(df, **options).filter("is_anomaly")
