"""The working form of a daily matrix: long values plus one row per day.

A matrix has as many columns as there are observed features, which can be
hundreds of thousands, so no operator works on the wide form.  ``values`` holds
one row per (day, feature); a feature without a row on a known day is zero
there.  ``days`` holds one row per known calendar day with the control columns
that say whether the day was observed or estimated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = "day"
FEATURE = "feature"
VALUE = "value"

# Names of the control columns.
IS_IMPUTED = "__is_imputed"
METHOD = "__imputation_method"
SOURCE_LAST_DATE = "__imputation_source_last_date"
CREATED_AT = "__imputation_created_at"
CONTROL_COLUMNS = [IS_IMPUTED, METHOD, SOURCE_LAST_DATE, CREATED_AT]

# Fixed value: the only estimation method.
SAME_MONTH_DAY_MEAN = "same_month_day_mean"

VALUES_SCHEMA = f"{DAY} date, {FEATURE} string, {VALUE} double"
DAYS_SCHEMA = (
    f"{DAY} date, {IS_IMPUTED} boolean, {METHOD} string, "
    f"{SOURCE_LAST_DATE} string, {CREATED_AT} string"
)


@dataclass(frozen=True)
class DailyMatrix:
    values: DataFrame
    days: DataFrame

    @staticmethod
    def observed(values: DataFrame) -> "DailyMatrix":
        """A matrix whose days are all real: the days are those with a value."""
        return DailyMatrix(
            values.select(DAY, FEATURE, F.col(VALUE).cast("double").alias(VALUE)),
            observed_days(values.select(DAY).distinct()),
        )

    @staticmethod
    def empty(spark) -> "DailyMatrix":
        return DailyMatrix(
            spark.createDataFrame([], VALUES_SCHEMA),
            spark.createDataFrame([], DAYS_SCHEMA),
        )

    def select_days(self, condition) -> "DailyMatrix":
        """Keep the days for which ``condition`` (on the day column) holds."""
        return DailyMatrix(self.values.where(condition), self.days.where(condition))


def observed_days(days: DataFrame) -> DataFrame:
    """Add the control columns of real days: not estimated, three empty texts."""
    return days.select(
        DAY,
        F.lit(False).alias(IS_IMPUTED),
        F.lit("").alias(METHOD),
        F.lit("").alias(SOURCE_LAST_DATE),
        F.lit("").alias(CREATED_AT),
    )


def broadcast_days(days: DataFrame) -> DataFrame:
    """Broadcast a frame with one row per distinct calendar day.

    Its size does not grow with the facts: a DATE holds 3,652,059 distinct days
    (years 1 to 9999), a few thousand in practice, and only the narrow columns
    needed for the join are passed in.
    """
    return F.broadcast(days)
