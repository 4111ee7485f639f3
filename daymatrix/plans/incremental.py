"""Incremental runs: new source days are counted, staged and published."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymatrix.model import (
    DAY,
    FEATURE,
    VALUE,
    DailyMatrix,
    broadcast_days,
    observed_days,
)
from daymatrix.operators.calendar import last_contiguous_day
from daymatrix.operators.features import coded_features, visit_features
from daymatrix.operators.impute import drop_imputed, estimates_from_sums
from daymatrix.operators.prepare import (
    clean_coded_rows,
    clean_visits,
    date_range,
    day_code_counts,
    rejected_dates,
    require_columns,
    with_read_days,
)
from daymatrix.operators.selection import non_empty
from daymatrix.plans.windows import Window, latest, processing_window, resume_day
from daymatrix.session import held, is_small, materialize, scratch
from daymatrix.sources.readers import date_bounds, scan_range
from daymatrix.sources.store import MatrixStore, StagingArea, cursor_of

# Fixed value: first day of source data that counts.
FIRST_VALID_DAY = date(2008, 1, 1)


def replace_days(stored: DailyMatrix, new: DailyMatrix) -> DailyMatrix:
    """Stored real days, except those that ``new`` has, plus the new days.

    Days are replaced whole: a feature that a recomputed day no longer has does
    not survive, and doing it twice equals doing it once.
    """
    kept = drop_imputed(stored)
    replaced = broadcast_days(new.days.select(DAY))
    return DailyMatrix(
        kept.values.join(replaced, DAY, "left_anti").unionByName(new.values),
        kept.days.join(replaced, DAY, "left_anti").unionByName(new.days),
    )


def staged_matrix(
    staging: StagingArea,
    runs: list[str],
    with_range: tuple[date, date] | None = None,
    news: list[str] | None = None,
) -> DailyMatrix | None:
    """Staged rows as a matrix.  Pieces of one run add up; of several runs that
    hold the same day the latest run counts.  ``news`` limits it to the days of
    those runs.  Files that cannot hold a wanted day are not read."""
    touched = None
    if news is not None:
        fresh = staging.load(news, with_range)
        if fresh is None:
            return None
        touched = held(fresh.select(DAY).distinct(), "touched")
    rows = staging.load(runs, with_range if touched is None else None, touched)
    if rows is None:
        return None
    if with_range:
        rows = rows.where(date_range(F.col(DAY), *with_range))
    if touched is not None:
        rows = rows.join(broadcast_days(touched), DAY, "left_semi")
    return latest_run_per_day(rows)


def latest_run_per_day(rows: DataFrame) -> DailyMatrix:
    """Matrix of staged rows with their ``run``: of every day the latest run."""
    last_run = held(rows.groupBy(DAY).agg(F.max("run").alias("run")), "days")
    rows = rows.join(broadcast_days(last_run), [DAY, "run"], "left_semi")
    summed = rows.groupBy(DAY, FEATURE).agg(F.sum(VALUE).cast("double").alias(VALUE))
    return DailyMatrix(summed.select(DAY, FEATURE, VALUE), observed_days(last_run))


def publish(
    store: MatrixStore,
    staging: StagingArea,
    as_of: date,
    created_at: datetime,
    impute_until: date | None = None,
    with_range: tuple[date, date] | None = None,
    clear: bool = True,
    news: list[str] | None = None,
) -> int | None:
    """Publish staged rows: replace whole days of the stored matrix, estimate
    missing days when a target day is given, write a new version.

    Later days that are already stored stay observed, also when an older range
    was reprocessed.  Staged rows are removed only after the version is written, and
    only those in ``with_range``; a run that has others keeps them.  ``news`` names
    the runs whose days are published, by default all.  Rows past the retention
    period are removed once everything staged is published.
    """
    with scratch(store.spark):
        runs = staging.runs()
        new = staged_matrix(staging, runs, with_range, news)
        if new is None:
            return None
        new = DailyMatrix(materialize(new.values, "new"), held(new.days, "new-days"))
        version = _publish_changes(store, new, as_of, created_at, impute_until)
        if version is None:
            return None
        staging.cursor.write(cursor_of(store.days(), created_at))
    if clear and with_range:
        _clear_range(staging, runs, *with_range)
    elif clear:
        staging.clear(runs)
    elif with_range is None and news is None:
        staging.expire(as_of)
    return version


def _publish_changes(
    store: MatrixStore, new: DailyMatrix, as_of: date, created_at: datetime, impute_until: date | None
) -> int | None:
    """A version with the observed days of ``new`` in place of the stored ones, without
    days after ``as_of``, and with all estimates made anew if there is a target day.

    What is read are the years and months that change, the sums, and the day table.
    """
    until = F.col(DAY) <= F.lit(as_of)
    new, stored = new.select_days(until), store.observed_days()
    kept = stored.where(until).join(broadcast_days(new.days), DAY, "left_anti")
    days = held(kept.unionByName(new.days), "observed")
    last = days.agg(F.max(DAY)).first()[0]
    if last is None:
        return None
    draft = store.revise(stored.where(~until), new)
    if impute_until is None:
        return draft.publish(days, created_at)
    target = min(latest(impute_until, last), as_of)
    estimates = estimates_from_sums(days.select(DAY), draft.sums(), draft.observed, target, created_at)
    return draft.publish(days.unionByName(estimates.days), created_at, estimates.values)


def _clear_range(staging: StagingArea, runs: list[str], start: date, end: date) -> None:
    """Remove the staged rows of an inclusive range of days, and runs left empty."""
    for run in runs:
        staging.remove_days(run, start, end)
        rest = staging.load([run])
        if rest is None or rest.isEmpty():
            staging.clear([run])


def refresh_imputation(
    store: MatrixStore, as_of: date, created_at: datetime, impute_until: date | None
) -> int | None:
    """Estimate the stored matrix anew when the source has no new days."""
    if not store.exists() or impute_until is None:
        return None
    with scratch(store.spark):
        return _publish_changes(store, DailyMatrix.empty(store.spark), as_of, created_at, impute_until)


@dataclass(frozen=True)
class Selections:
    """Which places and code groups get columns; None means all places, and no
    code columns."""

    regions: DataFrame | None = None
    facilities: DataFrame | None = None
    codes: DataFrame | None = None

    def usable(self) -> "Selections":
        return Selections(
            non_empty(self.regions), non_empty(self.facilities), non_empty(self.codes)
        )

    def of_places(self) -> "Selections":
        """Without the codes, which visits have none of."""
        return Selections(self.regions, self.facilities)


@dataclass(frozen=True)
class Run:
    """Where a fact is kept and which days a run covers."""

    store: MatrixStore
    staging: StagingArea
    as_of: date
    created_at: datetime
    start: date | None = None
    end: date | None = None
    min_valid: date = FIRST_VALID_DAY
    name: str = field(default="")
    #: Formats of dates that are text, tried after ISO, and a folder for the rows of every
    #: run whose date cannot be read; without one they are dropped.
    date_formats: tuple[str, ...] = ()
    rejected: str | None = None

    @property
    def run_name(self) -> str:
        return self.name or self.created_at.strftime("%Y%m%dT%H%M%S%f")


@dataclass(frozen=True)
class Outcome:
    window: Window | None
    version: int | None


def run_increment(
    source: DataFrame,
    date_column: str,
    columns: list[str],
    features: Callable[[DataFrame], DataFrame],
    run: Run,
) -> Outcome:
    """Process the source days that are new.

    The source is scanned once, for its needed columns and days only; the counts
    are staged, so publishing never goes back to the source.
    """
    require_columns(source, [date_column, *columns])
    if run.rejected:
        bad = rejected_dates(source.select(date_column, *columns), date_column, run.date_formats)
        bad.write.mode("overwrite").parquet(f"{run.rejected.rstrip('/')}/run={run.run_name}")
    if isinstance(source.schema[date_column].dataType, T.StringType):
        source = with_read_days(source, date_column, run.date_formats)
    contiguous = last_contiguous_day(run.store.days()).first()[0]
    cursor = run.staging.cursor
    last = resume_day(cursor.exists(), cursor.last_day(), contiguous)

    first_day, last_day = date_bounds(source, date_column, run.as_of, run.min_valid).first()
    if first_day is None:
        return Outcome(None, None)
    requested_end = min(run.end or run.as_of, run.as_of)
    window = processing_window(first_day, last_day, last, run.start, run.end, run.as_of)
    if window is None:
        version = refresh_imputation(run.store, run.as_of, run.created_at, requested_end)
        return Outcome(None, version)

    rows = scan_range(
        source, date_column, window.start, window.end_exclusive, [date_column, *columns]
    )
    counts = features(rows).withColumn(VALUE, F.col(VALUE).cast("double"))
    run.staging.append(counts, run.run_name, run.as_of)
    version = publish(
        run.store,
        run.staging,
        run.as_of,
        run.created_at,
        impute_until=requested_end,
    )
    return Outcome(window, version)


# Source columns of the two facts.
VISIT_DATE = "DATA_VISITA"
VISIT_COLUMNS = [
    "UP",
    "VISI_LLOC_VISITA",
    "VISI_SITUACIO_VISITA",
    "SERVEI_CODI",
    "TIPUS_CLASS",
    "VISI_TIPUS_VISITA",
]
CODED_DATE = "data_visita"
CODED_COLUMNS = ["up_c", "problema_salut_c"]


def visits_to_features(
    visits: DataFrame, lookup: DataFrame, selections: Selections
) -> DataFrame:
    return visit_features(
        clean_visits(visits), lookup, selections.regions, selections.facilities
    )


def coded_to_features(
    coded: DataFrame, lookup: DataFrame, selections: Selections
) -> DataFrame:
    # A small code map joins the raw rows in the map tasks, which then combine per
    # code group; beyond that the rows are counted per code before they are joined.
    small = selections.codes is None or is_small(selections.codes)
    if small:
        rows = clean_coded_rows(coded).withColumn("n", F.lit(1).cast("bigint"))
    else:
        rows = day_code_counts(coded)
    return coded_features(
        rows,
        lookup,
        selections.codes,
        selections.regions,
        selections.facilities,
        small_codes=small,
    )


def run_visits(
    visits: DataFrame, lookup: DataFrame, run: Run, selections: Selections = Selections()
) -> Outcome:
    """Incremental run of the visit fact.  ``lookup`` is a clean (up, rs) table."""
    with scratch(visits.sparkSession):
        chosen = selections.of_places().usable()
        return run_increment(
            visits,
            VISIT_DATE,
            VISIT_COLUMNS,
            lambda rows: visits_to_features(rows, lookup, chosen),
            run,
        )


def run_coded(
    coded: DataFrame, lookup: DataFrame, run: Run, selections: Selections = Selections()
) -> Outcome:
    """Incremental run of the coded fact.  ``lookup`` is a clean (up, rs) table."""
    with scratch(coded.sparkSession):
        chosen = selections.usable()
        return run_increment(
            coded,
            CODED_DATE,
            CODED_COLUMNS,
            lambda rows: coded_to_features(rows, lookup, chosen),
            run,
        )
