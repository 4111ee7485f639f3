"""Preparation of raw facts: cleaning and the facility lookup."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymatrix.functions import cleaning as C
from daymatrix.functions.naming import VISIT_CATEGORIES
from daymatrix.operators.dedup import keep_last, stored_order
from daymatrix.session import materialize


def require_columns(df: DataFrame, required: list[str], table: str = "input") -> None:
    """Fail when a required column is missing; names compare without case."""
    present = {c.upper() for c in df.columns}
    missing = [c for c in required if c.upper() not in present]
    if missing:
        raise ValueError(
            f"Missing columns: {table} lacks {', '.join(missing)}. Available: {', '.join(sorted(df.columns))}"
        )


def missing_columns(df: DataFrame, required: list[str], table: str = "input") -> DataFrame:
    """The column contract as a report: ``(table_name, column_name, stored_as, present)``,
    one row per required column; names compare without case."""
    stored = {c.upper(): c for c in df.columns}
    rows = [(table, c, stored.get(c.upper()), c.upper() in stored) for c in required]
    schema = "table_name string, column_name string, stored_as string, present boolean"
    return df.sparkSession.createDataFrame(rows, schema)


def day_of(df: DataFrame, column: str, formats: Sequence[str] = ()) -> Column:
    """Calendar day of a column, whatever it is stored as."""
    return C.to_day(F.col(column), df.schema[column].dataType, formats)


def with_read_days(df: DataFrame, column: str, formats: Sequence[str]) -> DataFrame:
    """A text column of dates in several formats read as days, null where unreadable."""
    return df.withColumn(column, day_of(df, column, formats))


def rejected_dates(df: DataFrame, column: str, formats: Sequence[str] = ()) -> DataFrame:
    """The rows whose date cannot be read, all columns as they are, and ``reason``: a
    ``missing``, ``blank`` or ``unreadable`` date."""
    text = F.col(column).cast("string")
    reason = F.when(text.isNull(), F.lit("missing")).when(C.blank_to_null(column).isNull(), F.lit("blank"))
    rows = df.where(day_of(df, column, formats).isNull())
    return rows.withColumn("reason", reason.otherwise(F.lit("unreadable")))


def with_day(df: DataFrame, column: str) -> DataFrame:
    """Rows with a readable date.  On a date or timestamp column the condition
    reaches the scan."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.where(day_of(df, column).isNotNull())
    return df.where(F.col(column).isNotNull())


def date_range(day: Column, start: date | None, end: date | None) -> Column:
    """Inclusive range, in a form that reaches the scan.  A null day gives null, which
    fails as a filter, as soon as one bound is given."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (day >= F.lit(start))
    if end is not None:
        condition = condition & (day < F.date_add(F.lit(end), 1))
    return condition


def drop_future_rows(df: DataFrame, column: str, as_of: date) -> DataFrame:
    """Remove rows without a readable date and rows after ``as_of``."""
    day = day_of(df, column)
    return df.where(day.isNotNull() & (day <= F.lit(as_of)))


def facility_lookup(
    lookup: DataFrame, code: str = "Codi UP", region: str = "RS", order: str | None = None
) -> DataFrame:
    """Clean facility to region table ``(up, rs)``, one row per facility.

    Of several rows for one facility the last in ``order`` wins; without ``order``
    the rows count as they are stored, so the frame must be a scan or local rows.
    """
    cleaned = lookup.select(
        C.facility(code).alias("up"),
        C.region(region).alias("rs"),
        (F.col(order) if order else stored_order(lookup)).alias("_order"),
    ).where("up IS NOT NULL")
    return keep_last(cleaned, ["up"], ["_order"])


def lookup_duplicates(lookup: DataFrame, code: str = "Codi UP") -> DataFrame:
    """Facilities that occur more than once in the raw lookup."""
    counts = lookup.groupBy(C.facility(code).alias("up")).agg(F.count("*").alias("n"))
    return counts.where("n > 1")


def with_region(df: DataFrame, lookup: DataFrame, default: str) -> DataFrame:
    """Left join of facts with the lookup on ``up``; unknown regions get a label.

    No hint: the lookup comes from a file, so its size estimate decides between
    a broadcast and a shuffled join.
    """
    joined = df.join(lookup, "up", "left")
    return joined.withColumn("rs", C.region_or_default("rs", default))


def clean_visits(
    visits: DataFrame,
    date_column: str = "DATA_VISITA",
    facility_column: str = "UP",
    class_column: str = "TIPUS_CLASS",
    value_column: str | None = None,
) -> DataFrame:
    """Cleaned facts ``(day, up, <categories>, counts)``; undated rows are dropped."""
    has_class = class_column in visits.columns
    label = C.visit_class(class_column) if has_class else F.lit(C.NOT_AVAILABLE)
    raw = [c for c in VISIT_CATEGORIES if c in visits.columns and c != class_column]
    counts = C.number(value_column) if value_column else F.lit(1).cast("bigint")
    cleaned = with_day(visits, date_column).select(
        day_of(visits, date_column).alias("day"),
        F.coalesce(C.facility(facility_column), F.lit(C.UNKNOWN)).alias("up"),
        *[C.category(c).alias(c) for c in raw],
        label.alias("TIPUS_CLASS"),
        counts.alias("counts"),
    )
    return cleaned.withColumn("TIPUS_VISITA_AGRUPAT", C.visit_class_group("TIPUS_CLASS"))


def prepare_visits(visits: DataFrame, lookup: DataFrame, **columns) -> DataFrame:
    """Cleaned visits with their region."""
    return with_region(clean_visits(visits, **columns), lookup, C.UNSPECIFIED_REGION)


def clean_coded_rows(
    coded: DataFrame,
    date_column: str = "data_visita",
    facility_column: str = "up_c",
    code_column: str = "problema_salut_c",
) -> DataFrame:
    """Cleaned coded rows ``(day, up, code)``; undated and uncoded rows are dropped."""
    # one cheap test per row: the code holds something besides white space
    coded = with_day(coded, date_column).where(
        F.col(code_column).cast("string").rlike(r"\S")
    )
    return coded.select(
        day_of(coded, date_column).alias("day"),
        F.coalesce(C.facility(facility_column), F.lit(C.UNKNOWN)).alias("up"),
        C.code3(code_column).alias("code"),
    )


def day_code_counts(coded: DataFrame, **columns) -> DataFrame:
    """Rows per day, facility and three-character code: ``(day, up, code, n)``."""
    cleaned = clean_coded_rows(coded, **columns)
    return cleaned.groupBy("day", "up", "code").agg(F.count("*").alias("n"))


def unknown_facilities(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Rows per facility that the lookup does not know: ``(up, num_rows)``."""
    counts = df.groupBy("up").agg(F.count("*").alias("num_rows"))
    return counts.join(lookup, "up", "left_anti")


def unknown_facility_report(df: DataFrame, lookup: DataFrame, first: int = 10) -> DataFrame:
    """Totals over all rows and the first unknown facilities by code.

    One row: ``total_rows, unknown_rows, unknown_facilities, examples``.
    """
    counts = materialize(df.groupBy("up").agg(F.count("*").alias("n")), "facilities")
    known = lookup.select("up", F.lit(True).alias("known"))
    marked = counts.join(known, "up", "left").withColumn("unknown", F.col("known").isNull())
    totals = marked.agg(
        F.sum("n").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("unknown"), F.col("n"))), F.lit(0)).alias("unknown_rows"),
        F.count_if("unknown").alias("unknown_facilities"),
    )
    examples = (
        marked.where("unknown")
        .orderBy("up")
        .limit(first)
        .agg(F.array_join(F.sort_array(F.collect_list("up")), ",").alias("examples"))
    )
    return totals.withColumn("examples", examples.scalar())
