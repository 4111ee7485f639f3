"""Calendar days: grids, gaps and cursors over observed days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymatrix.functions import cleaning as C
from daymatrix.model import DAY, IS_IMPUTED, broadcast_days
from daymatrix.operators.prepare import day_of
from daymatrix.session import materialize


def calendar(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every day from ``start`` to ``end`` of a one-row frame."""
    days = F.when(start <= end, F.sequence(start, end))
    return bounds.select(F.explode(days).alias(DAY))


def daily_grid(
    df: DataFrame,
    day: str = DAY,
    start: date | None = None,
    end: date | None = None,
    fill: float = 0,
) -> DataFrame:
    """One row per calendar day of ``[start, end]``; gaps and nulls get ``fill``.

    Bounds default to the first and last day present.  Days outside the bounds
    and rows without a day are dropped; an empty frame stays empty.
    """
    rows = df.withColumn(day, day_of(df, day)).where(F.col(day).isNotNull())
    bounds = rows.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    bounds = bounds.where("first IS NOT NULL")
    first = F.lit(start) if start is not None else F.col("first")
    last = F.lit(end) if end is not None else F.col("last")
    grid = calendar(bounds, first, last).withColumnRenamed(DAY, day)
    columns = [c for c in df.columns if c != day]
    return grid.join(rows, day, "left").select(day, *columns).fillna(fill, subset=columns)


def real_days(df: DataFrame, day: str = DAY) -> DataFrame:
    """Distinct days of rows that are not estimates."""
    rows = df
    if IS_IMPUTED in df.columns:
        rows = df.where(~C.flag(IS_IMPUTED, df.schema[IS_IMPUTED].dataType))
    days = rows.select(day_of(df, day).alias(DAY))
    return days.where(F.col(DAY).isNotNull()).distinct()


def last_observed_day(df: DataFrame, day: str = DAY) -> DataFrame:
    """One row: the latest day that is not an estimate, or null."""
    return real_days(df, day).agg(F.max(DAY).alias("last_observed_day"))


def last_contiguous_day(df: DataFrame, day: str = DAY) -> DataFrame:
    """One row: the last observed day before the first calendar gap, or null.

    A day starts a gap when the next calendar day is unknown; the earliest such
    day is the answer, and without a gap it is the last day itself.
    """
    known = materialize(real_days(df, day), "days")
    next_known = known.select(F.date_sub(DAY, 1).alias(DAY))
    gap_starts = known.join(broadcast_days(next_known), DAY, "left_anti")
    return gap_starts.agg(F.min(DAY).alias("last_contiguous_day"))


def missing_days(days: DataFrame, first: date, last: date) -> DataFrame:
    """Calendar days of ``[first, last]`` that are not in ``days``."""
    one = days.sparkSession.range(1)
    grid = calendar(one, F.lit(first), F.lit(last))
    return grid.join(broadcast_days(days.select(DAY).distinct()), DAY, "left_anti")
