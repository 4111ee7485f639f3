"""Showing and deleting date ranges of stored results."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymatrix.model import DAY, IS_IMPUTED, DailyMatrix
from daymatrix.operators.prepare import date_range, day_of
from daymatrix.session import materialize
from daymatrix.sources.readers import read_parquet, rows_between
from daymatrix.sources.replace import replace_dataset
from daymatrix.sources.store import ESTIMATED, CursorStore, MatrixStore, StagingArea, cursor_of


class Shown(NamedTuple):
    rows: DataFrame
    matched: int
    total: int


def show_rows(
    df: DataFrame,
    day: str = "timestamp",
    start: date | None = None,
    end: date | None = None,
    columns: list[str] | None = None,
    limit: int = 100,
) -> Shown:
    """Rows of an inclusive date range in date order, the first ``limit`` of them
    (0 for all), with the numbers of matching and of all rows."""
    if limit < 0:
        raise ValueError("limit must be 0 or positive")
    inside = date_range(day_of(df, day), start, end)
    matched, total = df.agg(F.count_if(inside), F.count("*")).first()
    rows = rows_between(df, day, start, end, columns).orderBy(day)
    return Shown(rows.limit(limit) if limit else rows, matched, total)


def without_days(df: DataFrame, start: date, end: date, day: str = DAY) -> DataFrame:
    """Rows outside an inclusive date range; rows without a date are kept."""
    if start is None or end is None:
        raise ValueError("deleting rows needs a start and an end")
    if start > end:
        raise ValueError("start cannot be after end")
    # Written so that on stored dates and times it reaches the scan.
    if isinstance(df.schema[day].dataType, T.StringType):
        column, kind = day_of(df, day), T.DateType()
    else:
        column, kind = F.col(f"`{day}`"), df.schema[day].dataType
    after = F.lit(end + timedelta(days=1)).cast(kind)
    return df.where((column < F.lit(start).cast(kind)) | (column >= after) | column.isNull())


class Deleted(NamedTuple):
    deleted: int
    remaining: int
    backup: str | None
    cursor: DataFrame | None


def delete_days(
    store: MatrixStore,
    start: date,
    end: date,
    now: datetime,
    staging: StagingArea | None = None,
    dry_run: bool = False,
    create_backup: bool = True,
) -> Deleted:
    """Delete days of a stored matrix and set the cursor back.

    The new cursor covers the observed days before the deleted range, so the next
    run starts there.  A dry run only reports; without a matching day nothing is
    written.  The backup is the previous version.
    """
    stored = store.days()
    days = without_days(stored, start, end)
    remaining, total = days.count(), stored.count()
    cursor = cursor_of(days, now, before=start)
    if dry_run or remaining == total:
        return Deleted(total - remaining, remaining, None, cursor if dry_run else None)
    previous = store.versions.latest()
    gone = stored.where(date_range(F.col(DAY), start, end))
    estimated = F.coalesce(F.col(IS_IMPUTED), F.lit(False))
    draft = store.revise(gone.where(~estimated), DailyMatrix.empty(store.spark))
    years = gone.where(estimated).agg(F.collect_set(F.year(DAY))).first()[0]
    left = without_days(store.read_parts(draft.former, ESTIMATED, years), start, end)
    draft.publish(days, now, left if years else None, years)
    if staging is not None:
        staging.cursor.write(cursor)
    if not create_backup:
        store.drop(previous)
    backup = store.versions.path(previous) if create_backup else None
    return Deleted(total - remaining, remaining, backup, cursor)


def delete_staged_days(
    staging: StagingArea,
    run: str,
    start: date,
    end: date,
    now: datetime,
    day: str = DAY,
    dry_run: bool = False,
) -> Deleted:
    """Delete days of one staged run.  The cursor is rebuilt from all runs, with
    the remaining rows in place of that run."""
    rows = staging.load([run])
    if rows is None:
        raise FileNotFoundError(f"no staged run {run}")
    kept = without_days(rows, start, end, day)
    remaining, total = kept.count(), rows.count()
    others = staging.load([r for r in staging.runs() if r != run])
    combined = kept if others is None else kept.unionByName(others, allowMissingColumns=True)
    cursor = cursor_of(combined, now, day, before=start)
    if dry_run or remaining == total:
        return Deleted(total - remaining, remaining, None, cursor if dry_run else None)
    cursor = materialize(cursor, "cursor")  # it is read from what is about to go
    staging.remove_days(run, start, end, day)
    staging.cursor.write(cursor)
    return Deleted(total - remaining, remaining, None, staging.cursor.read())


def delete_parquet_rows(
    spark: SparkSession,
    path: str,
    start: date,
    end: date,
    now: datetime,
    day: str = "timestamp",
    dry_run: bool = False,
    create_backup: bool = True,
    cursors: CursorStore | None = None,
) -> Deleted:
    """Delete an inclusive date range from any Parquet folder.

    The cursor goes back before the range, and into ``cursors`` once the rows are gone.
    A deletion that was stopped is finished or undone by the next reader of the folder
    (see :mod:`daymatrix.sources.replace`).
    """
    df = read_parquet(spark, path)
    if df is None:
        raise FileNotFoundError(f"Parquet path not found: {path}")
    kept = without_days(df, start, end, day)
    inside = date_range(day_of(df, day), start, end)
    deleted, total = df.agg(F.count_if(inside), F.count("*")).first()
    cursor = cursor_of(kept, now, day, before=start)
    if dry_run or deleted == 0:
        return Deleted(deleted, total - deleted, None, cursor if dry_run else None)
    backup = f"{path.rstrip('/')}.bak_{now:%Y%m%d_%H%M%S}" if create_backup else None
    replace_dataset(kept, path, backup)
    cursor = cursor_of(read_parquet(spark, path), now, day, before=start)
    if cursors is not None:
        cursors.write(cursor)
    return Deleted(deleted, total - deleted, backup, cursor)
