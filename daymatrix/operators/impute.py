"""Estimates for missing calendar days, always marked as such."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymatrix.functions import cleaning as C
from daymatrix.model import (
    CONTROL_COLUMNS,
    CREATED_AT,
    DAY,
    FEATURE,
    IS_IMPUTED,
    METHOD,
    SAME_MONTH_DAY_MEAN,
    SOURCE_LAST_DATE,
    VALUE,
    DailyMatrix,
    broadcast_days,
    observed_days,
)
from daymatrix.operators.calendar import missing_days
from daymatrix.session import held


MONTH_DAY = "md"


def month_day(column: Column | str) -> Column:
    """Month and day as one number."""
    return (F.month(column) * 100 + F.dayofmonth(column)).cast("int")


def drop_imputed_rows(df: DataFrame) -> DataFrame:
    """Remove estimated rows and the control columns of a wide frame."""
    if IS_IMPUTED not in df.columns:
        return df
    real = df.where(~C.flag(IS_IMPUTED, df.schema[IS_IMPUTED].dataType))
    return real.drop(*CONTROL_COLUMNS)


def drop_imputed(matrix: DailyMatrix) -> DailyMatrix:
    """Keep the observed days of a matrix only."""
    real = matrix.days.where(~F.coalesce(F.col(IS_IMPUTED), F.lit(False)))
    values = matrix.values.join(broadcast_days(real.select(DAY)), DAY, "left_semi")
    return DailyMatrix(values, observed_days(real))


def _gaps(observed: DataFrame, first: date, target: date) -> DataFrame:
    """Missing days with their history ``(day, past)``: the earlier observed days
    of the same month and day, at most one per year, possibly none."""

    missing = missing_days(observed, first, target).withColumn("md", month_day(DAY))
    history = observed.select(F.col(DAY).alias("past"), month_day(DAY).alias("md"))
    joined = missing.join(
        broadcast_days(history),
        (missing["md"] == history["md"]) & (F.col("past") < F.col(DAY)),
        "left",
    )
    return joined.groupBy(DAY).agg(F.collect_list("past").alias("past"))


def impute(
    matrix: DailyMatrix,
    as_of: date,
    created_at: datetime,
    observed_until: date | None = None,
    target_until: date | None = None,
) -> DailyMatrix:
    """Complete a matrix through ``target_until`` with marked estimates.

    Every missing day after the first observed one, inside gaps as well as at
    the end, gets per feature the mean over the earlier observed days with the
    same month and day, or the mean over all observed days when there is none.
    Estimates never feed estimates.  Means divide by observed days, not by rows:
    a feature without a row on an observed day is zero there.

    The values are read twice, once as they are and once for the means, where one
    aggregate computes both kinds; pass a matrix that is stored, not one that
    still has to be counted.
    """
    target = min(target_until or as_of, as_of)
    days = held(matrix.days, "days")
    real = DailyMatrix(matrix.values, days)
    is_real = ~F.coalesce(F.col(IS_IMPUTED), F.lit(False))
    first, last, num_real, num_all = days.agg(
        F.min(F.when(is_real, F.col(DAY))),
        F.max(F.when(is_real, F.col(DAY))),
        F.count_if(is_real),
        F.count("*"),
    ).first()
    if num_real < num_all:
        real = drop_imputed(real)
    if first is None:
        return real
    observed_day = min(observed_until or last, target, last)
    if observed_day < last:
        real = real.select_days(F.col(DAY) <= F.lit(observed_day))
    if observed_day < first:
        return real

    observed = real.days.select(DAY)
    gaps = held(_gaps(observed, first, target), "gaps")

    # A value row counts once for every missing day it is history of (at most one
    # per later year) and once, under a null day, for the overall mean.
    targets = (
        gaps.select(DAY, F.explode("past").alias("past"))
        .groupBy("past")
        .agg(F.collect_list(DAY).alias("targets"))
    )
    rows = real.values.withColumnRenamed(DAY, "past").join(
        broadcast_days(targets), "past", "left"
    )
    overall = F.array(F.lit(None).cast("date"))
    counted_for = F.concat(overall, F.coalesce("targets", F.array().cast("array<date>")))
    sums = (
        rows.select(FEATURE, VALUE, F.explode(counted_for).alias(DAY))
        .groupBy(DAY, FEATURE)
        .agg(F.sum(VALUE).alias("total"))
        .where(F.col("total") != 0)
    )

    # The overall sum stands for all missing days without history.
    no_history = gaps.where(F.size("past") == 0)
    fallback_days = no_history.agg(F.collect_list(DAY)).scalar()
    num_days = observed.agg(F.count("*")).scalar()
    stands_for = F.when(F.col(DAY).isNull(), fallback_days).otherwise(F.array(DAY))
    num_past = gaps.select(DAY, F.size("past").alias("num_past"))
    estimates = sums.join(broadcast_days(num_past), DAY, "left").select(
        F.explode(stands_for).alias(DAY),
        FEATURE,
        (F.col("total") / F.coalesce("num_past", num_days)).alias(VALUE),
    )

    estimated_days = _estimated_days(gaps, observed_day, created_at)
    return DailyMatrix(
        real.values.unionByName(estimates), real.days.unionByName(estimated_days)
    )


def estimates_from_sums(
    observed: DataFrame,
    sums: DataFrame,
    values_of: Callable[[list[int]], DataFrame],
    target: date,
    created_at: datetime,
) -> DailyMatrix:
    """The estimates of :func:`impute`, from sums instead of the whole history.

    ``observed`` is the table of observed days, ``sums`` holds the observed values summed
    per month and day (``md``) and feature, and ``values_of`` gives the observed values of
    some years.  Of a gap that days of the same month and day follow, those days are taken
    off the sum; no other value is read.  Sums of numbers that are not whole may differ in
    the last places from sums made anew.
    """
    first, last, num_days = observed.agg(F.min(DAY), F.max(DAY), F.count("*")).first()
    if first is None:
        return DailyMatrix.empty(observed.sparkSession)
    gaps = held(_gaps(observed, first, target), "gaps").withColumn(MONTH_DAY, month_day(DAY))
    known = gaps.where(F.size("past") > 0).select(DAY, MONTH_DAY)
    totals = sums.join(broadcast_days(known), MONTH_DAY).select(DAY, FEATURE, VALUE)
    after = observed.select(F.col(DAY).alias("later"), month_day(DAY).alias(MONTH_DAY))
    later = known.join(broadcast_days(after), MONTH_DAY).where(F.col("later") > F.col(DAY)).select("later", DAY)
    later = held(later, "later")
    years = later.agg(F.collect_set(F.year("later"))).first()[0]
    if years:
        values = values_of(years).withColumnRenamed(DAY, "later").join(broadcast_days(later), "later")
        totals = totals.unionByName(values.select(DAY, FEATURE, (-F.col(VALUE)).alias(VALUE)))
        totals = totals.groupBy(DAY, FEATURE).agg(F.sum(VALUE).alias(VALUE))
    num_past = gaps.select(DAY, F.size("past").alias("num_past"))
    means = totals.join(broadcast_days(num_past), DAY).select(DAY, FEATURE, (F.col(VALUE) / F.col("num_past")).alias(VALUE))
    # Days without history get the mean over all observed days.
    without = gaps.where(F.size("past") == 0).agg(F.collect_list(DAY)).scalar()
    overall = sums.groupBy(FEATURE).agg((F.sum(VALUE) / num_days).alias(VALUE))
    overall = overall.select(F.explode(without).alias(DAY), FEATURE, VALUE)
    return DailyMatrix(
        means.unionByName(overall).where(F.col(VALUE) != 0), _estimated_days(gaps, last, created_at)
    )


def _estimated_days(gaps: DataFrame, source_last: date, created_at: datetime) -> DataFrame:
    return gaps.select(
        DAY,
        F.lit(True).alias(IS_IMPUTED),
        F.lit(SAME_MONTH_DAY_MEAN).alias(METHOD),
        F.lit(source_last.isoformat()).alias(SOURCE_LAST_DATE),
        F.lit(created_at.isoformat()).alias(CREATED_AT),
    )
