"""Full runs without cursor and without estimates, and the final join."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daymatrix.functions.naming import DEMAND
from daymatrix.model import DAY, FEATURE, VALUE, DailyMatrix, observed_days
from daymatrix.operators.join import join_matrices
from daymatrix.operators.matrix import MAX_FEATURES, from_wide, matrix_to_wide
from daymatrix.plans.incremental import (
    CODED_COLUMNS,
    CODED_DATE,
    VISIT_COLUMNS,
    VISIT_DATE,
    Selections,
    coded_to_features,
    visits_to_features,
)
from daymatrix.session import materialize, scratch
from daymatrix.sources.readers import read_parquet, scan_range
from daymatrix.sources.store import CODEC, MatrixStore

def _scan(source, date_column, columns, as_of, start, end) -> DataFrame:
    """Needed columns and days only; the day condition reaches the scan."""
    last = min(end or as_of, as_of)
    present = [c for c in columns if c in source.columns]
    return scan_range(
        source, date_column, start, last + timedelta(days=1), [date_column, *present]
    )


def stored_days(values: DataFrame, name: str) -> DailyMatrix:
    """Values written once, and the list of their days as seen while they are written:
    at most one entry per calendar day."""
    seen = Observation()
    stored = materialize(values.observe(seen, F.collect_set(DAY).alias("days")), name)
    days = pa.array(sorted(seen.get["days"]), pa.date32())
    local = values.sparkSession.createDataFrame(pa.table({DAY: days}))
    return DailyMatrix(stored.select(DAY, FEATURE, F.col(VALUE).cast("double").alias(VALUE)), observed_days(local))


def full_visits(
    visits: DataFrame,
    lookup: DataFrame,
    as_of: date,
    selections: Selections = Selections(),
    start: date | None = None,
    end: date | None = None,
) -> DailyMatrix:
    """Matrix of all visits up to ``as_of``, optionally of an inclusive range."""
    rows = _scan(visits, VISIT_DATE, VISIT_COLUMNS, as_of, start, end)
    features = visits_to_features(rows, lookup, selections.of_places().usable())
    return stored_days(features, "visits")


def full_coded(
    coded: DataFrame,
    lookup: DataFrame,
    as_of: date,
    selections: Selections = Selections(),
    start: date | None = None,
    end: date | None = None,
) -> DailyMatrix:
    """Matrix of all coded rows up to ``as_of``, optionally of an inclusive range."""
    rows = _scan(coded, CODED_DATE, CODED_COLUMNS, as_of, start, end)
    features = coded_to_features(rows, lookup, selections.usable())
    return stored_days(features, "coded")


def join_stores(
    visits: MatrixStore,
    coded: MatrixStore,
    joined: MatrixStore,
    as_of: date,
    generated_at: datetime,
    fill: str | None = "ffill",
) -> int | None:
    """Join two stored matrices by day and store the result."""
    with scratch(joined.spark):
        matrix = join_matrices(visits.load(), coded.load(), as_of, fill)
        return joined.publish(matrix, as_of, generated_at)


def export_wide(
    matrix: DailyMatrix, path: str, codec: str = CODEC, max_features: int = MAX_FEATURES
) -> None:
    """Write the wide form, one row per day in day order, as a Parquet folder.  More than
    ``max_features`` columns are refused."""
    matrix_to_wide(matrix, max_features=max_features).orderBy(DAY).write.option("compression", codec).parquet(path)


def import_wide(
    spark: SparkSession, path: str, domain: str = DEMAND, day: str = "timestamp"
) -> DailyMatrix:
    """Matrix of wide Parquet files, also with names of older schemes."""
    wide = read_parquet(spark, path)
    if wide is None:
        raise FileNotFoundError(f"Parquet path not found: {path}")
    return from_wide(wide, domain, day)
