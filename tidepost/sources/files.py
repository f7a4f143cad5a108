"""CSV posts, previews and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepost import rules

# Layout of the headerless post file.
CSV_SCHEMA = T.StructType(
    [
        T.StructField("target", T.IntegerType()),
        T.StructField("ids", T.LongType()),
        T.StructField("date", T.StringType()),
        T.StructField("flag", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
CSV_ENCODING = "ISO-8859-1"


def _one_line(text: Column) -> Column:
    """Line ends and backslashes escaped, so that a row is a line and files can be split."""
    for found, mark in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(found), F.lit(mark))
    return text


def _whole_text(text: Column) -> Column:
    """The text that :func:`_one_line` was given (which must not hold the null character)."""
    for found, mark in (("\\\\", "\0"), ("\\n", "\n"), ("\\r", "\r"), ("\0", "\\")):
        text = F.replace(text, F.lit(found), F.lit(mark))
    return text


def _on_strings(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(F.col(n)).alias(n) if t == "string" else F.col(n) for n, t in df.dtypes])


def read_csv_posts(
    spark: SparkSession, path, limit: int | None = None, encoding: str = CSV_ENCODING, escaped: bool = False
) -> DataFrame:
    """Scan one path, a list of paths or a glob; ``limit`` caps the rows read.

    ``escaped`` reads what :func:`write_csv_posts` wrote, whose texts may have several lines.
    """
    df = (
        spark.read.schema(CSV_SCHEMA)
        .option("header", False)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    df = df.limit(limit) if limit else df
    return _on_strings(df, _whole_text) if escaped else df


def write_csv_posts(df: DataFrame, path: str, encoding: str = CSV_ENCODING) -> None:
    """The same layout, written by the executors; line ends are escaped (see ``escaped``)."""
    (
        _on_strings(df.select(*CSV_SCHEMA.fieldNames()), _one_line)
        .write.mode("overwrite")
        .option("header", False)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def existing_columns(df: DataFrame, wanted=rules.DISPLAY_COLUMNS) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def first_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """Row cap. With an order it is repeatable and runs as one bounded top-k."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def preview(df: DataFrame, n: int = 200, order=("timestamp", "post_id"), prepare=None) -> DataFrame:
    """Display columns of the first rows; ``prepare`` is applied to those rows alone."""
    keys = [c for c in order if c in df.columns]
    rows = first_rows(df, n, *keys)
    return existing_columns(prepare(rows) if prepare else rows)


def export_csv(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Display columns with a header; line ends are escaped, so files can be split when read."""
    (
        _on_strings(existing_columns(df), _one_line)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    df = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return _on_strings(df, _whole_text)


def export_parquet(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Display columns, one folder per day, so that later reads prune by date.

    Rows are not gathered by day first: one busy day would then be one task.
    """
    (
        existing_columns(df)
        .withColumn("day", F.to_date("timestamp"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("day")
        .parquet(path)
    )
