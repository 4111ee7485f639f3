"""Scans of fact tables and small inputs, and text exports."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymatrix.operators.prepare import date_range, day_of, require_columns
from daymatrix.sources.replace import settle

# Fixed value: first day accepted by default.
MIN_VALID_DAY = date(2000, 1, 1)


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with a header; every column is text, so codes keep leading zeros."""
    df = spark.read.option("header", True).csv(path)
    if columns:
        require_columns(df, columns, path)
        df = df.select(*columns)
    return df


def read_parquet(
    spark: SparkSession, *paths: str, columns: list[str] | None = None
) -> DataFrame | None:
    """Parquet files or folders whose columns may differ; None when missing.  A
    replacement of a folder that was stopped half-way is finished first."""
    for path in paths:
        settle(spark, path)
    try:
        df = spark.read.option("mergeSchema", True).parquet(*paths)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise
    return df.select(*columns) if columns else df


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_row``, which give the order rows were stored in."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )


FILE_ORDER = ["_file", "_row"]


def year_slices(start: date, end_exclusive: date) -> list[tuple[int, date, date]]:
    """The range cut at year boundaries: ``(year, first day, end exclusive)``."""
    last = end_exclusive - timedelta(days=1)
    return [
        (year, max(date(year, 1, 1), start), min(date(year + 1, 1, 1), end_exclusive))
        for year in range(start.year, last.year + 1)
    ]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    date_column: str | None = None,
    start: date | None = None,
    end_exclusive: date | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Database table; with a date range the years are read in parallel, one
    partition each.  Column pruning and filters reach the database."""
    if date_column is None or start is None or end_exclusive is None:
        return spark.read.jdbc(url, table, properties=properties or {})
    predicates = [
        f"{date_column} >= '{first}' AND {date_column} < '{end}'"
        for _, first, end in year_slices(start, end_exclusive)
    ]
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def scan_range(
    df: DataFrame,
    date_column: str,
    start: date | None,
    end_exclusive: date,
    columns: list[str] | None = None,
    after: date | None = None,
) -> DataFrame:
    """Rows of ``[start, end)`` or all before ``end``, optionally later than ``after``, and only the
    wanted columns.

    On date and timestamp columns the condition is on the stored column itself,
    so it reaches the file or database scan.
    """
    kind = df.schema[date_column].dataType
    column = day_of(df, date_column) if isinstance(kind, T.StringType) else F.col(date_column)
    target = T.DateType() if isinstance(kind, T.StringType) else kind
    condition = column < F.lit(end_exclusive).cast(target)
    if start is not None:
        condition = condition & (column >= F.lit(start).cast(target))
    if after is not None:
        condition = condition & (column > F.lit(after).cast(target))
    rows = df.where(condition)
    return rows.select(*columns) if columns else rows


def date_bounds(
    df: DataFrame,
    date_column: str,
    as_of: date,
    min_valid: date = MIN_VALID_DAY,
    max_valid: date | None = None,
) -> DataFrame:
    """One row ``(min_date, max_date)`` of the valid days ``[min_valid, max_valid)``,
    by default up to and including ``as_of``; both null when there are none."""
    end = max_valid or as_of + timedelta(days=1)
    rows = scan_range(df, date_column, min_valid, end)
    day = day_of(rows, date_column)
    return rows.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def rows_between(
    df: DataFrame,
    date_column: str,
    start: date | None,
    end: date | None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Rows of an inclusive date range; chosen columns follow the date column."""
    rows = df.where(date_range(day_of(df, date_column), start, end))
    if not columns:
        return rows
    shown = [date_column, *[c for c in columns if c != date_column]]
    missing = [c for c in shown if c not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return rows.select(*[f"`{c}`" for c in shown])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder with a header."""
    df.write.option("header", True).option("emptyValue", "").csv(path)


def convert_to_csv(spark: SparkSession, parquet_path: str, csv_path: str) -> None:
    df = read_parquet(spark, parquet_path)
    if df is None:
        raise FileNotFoundError(f"Parquet path not found: {parquet_path}")
    write_csv(df, csv_path)


def save_matrix_csv(wide: DataFrame, path: str, day: str = "day") -> None:
    """Wide matrix with its key column named ``Timestamp``, sorted by it."""
    write_csv(wide.withColumnRenamed(day, "Timestamp").orderBy("Timestamp"), path)


def load_matrix_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide matrix saved as CSV, sorted: a date key and number columns."""
    df = read_csv(spark, path)
    numbers = [F.col(f"`{c}`").try_cast("double").alias(c) for c in df.columns if c != "Timestamp"]
    return df.select(day_of(df, "Timestamp").alias("Timestamp"), *numbers).orderBy("Timestamp")
