"""Stored matrices and staged rows in shared folders.

A stored matrix is never overwritten in place: reading and replacing the same
path in one job loses it when the job fails.  Each publication is a new version,
a manifest of folders that counts once its marker file exists; folders that a
version did not change are shared with the one before it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.functions.cleaning import flag
from daymatrix.model import (
    DAY,
    DAYS_SCHEMA,
    FEATURE,
    IS_IMPUTED,
    VALUE,
    VALUES_SCHEMA,
    DailyMatrix,
    broadcast_days,
    observed_days,
)
from daymatrix.operators.dedup import keep_last
from daymatrix.operators.impute import MONTH_DAY, month_day
from daymatrix.operators.prepare import date_range, day_of, drop_future_rows
from daymatrix.operators.quality import write_imputation_metadata
from daymatrix.session import Folder
from daymatrix.sources.readers import FILE_ORDER, read_parquet, with_file_order

# Fixed value: codec of stored files.
CODEC = "snappy"
# Most long rows in one staged file.
CHUNK_ROWS = 5_000_000
# Column that tells rows apart; of several rows with one identity the last stored one counts.
IDENTITY = "data_id"
CURSOR_SCHEMA = "last_update timestamp, min_timestamp date, max_timestamp date, num_rows bigint"


class _Versions:
    """Numbered folders ``v=0001`` below a path, valid once marked complete."""

    MARKER = "_COMPLETE"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.folder = Folder(spark, path)

    def all(self) -> list[int]:
        names = [n for n in self.folder.names() if n.startswith("v=")]
        return [int(n[2:]) for n in names if self.folder.exists(f"{n}/{self.MARKER}")]

    def latest(self) -> int | None:
        return max(self.all(), default=None)

    def path(self, version: int) -> str:
        return f"{self.folder.path}/v={version:06d}"

    def next(self) -> int:
        started = [int(n[2:]) for n in self.folder.names() if n.startswith("v=")]
        return max(started, default=0) + 1

    def complete(self, version: int) -> None:
        self.folder.touch(f"v={version:06d}/{self.MARKER}")

    def expire(self, keep: int) -> list[int]:
        """Delete all but the newest ``keep`` complete versions."""
        old = sorted(self.all())[:-keep] if keep > 0 else []
        for version in old:
            self.folder.delete(f"v={version:06d}")
        return old


# Kinds of folders a version is made of, and what their number stands for.
OBSERVED, ESTIMATED = "observed", "estimated"  # values, by year
SUMS = "sums"  # of the observed values, per month and day (``md``) and feature, by month
_SCHEMAS = {OBSERVED: VALUES_SCHEMA, ESTIMATED: VALUES_SCHEMA, SUMS: f"{MONTH_DAY} int, {FEATURE} string, {VALUE} double"}


class Part(NamedTuple):
    """One folder of values: its kind, its year or month, and the version that wrote it."""

    kind: str
    key: int
    version: int


def _years(start: date | None, end: date | None) -> range:
    return range(start.year if start else 1, (end.year if end else 9999) + 1)


class MatrixStore:
    """Versions of one matrix.

    A version is its day table and a manifest of folders: the observed values by year, the
    estimates by year, and sums of the observed values by month, from which estimates are
    made.  A publication writes the folders that change and names the others again.

    ``keep`` versions stay after a publication, by default all; frames read from
    older ones end with them.
    """

    MANIFEST = "manifest.json"

    def __init__(self, spark: SparkSession, path: str, keep: int | None = None):
        self.spark = spark
        self.keep = keep
        self.versions = _Versions(spark, path)
        self.parts_path = f"{self.versions.folder.path}/parts"

    def exists(self) -> bool:
        return self.versions.latest() is not None

    def parts(self, version: int | None = None) -> list[Part]:
        """The folders of the latest or a given version; none when there is no version."""
        version = version or self.versions.latest()
        if version is None:
            return []
        manifest = Folder(self.spark, self.versions.path(version)).read_text(self.MANIFEST)
        return [Part(*part) for part in json.loads(manifest)]

    def read_parts(self, parts: Iterable[Part], kind: str, keys: Iterable[int] | None = None) -> DataFrame:
        """Rows of the folders of one kind, by default of all years or months; those of
        others are not listed, and the year or month is a condition on the partition."""
        wanted = [p for p in parts if p.kind == kind and (keys is None or p.key in keys)]
        if not wanted:
            return self.spark.createDataFrame([], _SCHEMAS[kind])
        paths = [f"{self.parts_path}/w={p.version:06d}/kind={p.kind}/key={p.key}" for p in wanted]
        schema = f"{_SCHEMAS[kind]}, w int, kind string, key int"
        rows = self.spark.read.schema(schema).option("basePath", self.parts_path).parquet(*paths)
        if keys is not None:
            rows = rows.where(F.col("key").between(min(p.key for p in wanted), max(p.key for p in wanted)))
        return rows.drop("w", "kind", "key")

    def days(self, version: int | None = None) -> DataFrame:
        """The day table; an empty one when there is no version."""
        version = version or self.versions.latest()
        if version is None:
            return self.spark.createDataFrame([], DAYS_SCHEMA)
        return self.spark.read.parquet(f"{self.versions.path(version)}/days")

    def load(self, version: int | None = None, start: date | None = None, end: date | None = None) -> DailyMatrix:
        """The latest or a given version; an empty matrix when there is none.

        Of an inclusive range only the folders of its years are read, and of those the
        row groups that may hold its days.
        """
        version = version or self.versions.latest()
        if version is None:
            return DailyMatrix.empty(self.spark)
        parts, years = self.parts(version), _years(start, end) if start or end else None
        values = self.read_parts(parts, OBSERVED, years).unionByName(self.read_parts(parts, ESTIMATED, years))
        matrix = DailyMatrix(values, self.days(version))
        return matrix.select_days(date_range(F.col(DAY), start, end)) if start or end else matrix

    def observed_days(self) -> DataFrame:
        """The observed days of the latest version, with their control columns."""
        return observed_days(self.days().where(~F.coalesce(F.col(IS_IMPUTED), F.lit(False))))

    def publish(
        self,
        matrix: DailyMatrix,
        as_of: date,
        generated_at: datetime,
        codec: str = CODEC,
        allow_empty: bool = False,
    ) -> int | None:
        """Write all of a matrix as a new version, without days after ``as_of``, and its
        imputation metadata.  Nothing is written when no day is left, unless that is wanted."""
        kept = matrix.select_days(F.col(DAY).isNotNull() & (F.col(DAY) <= F.lit(as_of)))
        if not allow_empty and kept.days.isEmpty():
            return None
        draft = Revision(self, [], codec)
        days, values = draft.write_days(kept.days), kept.values
        estimated = F.lit(False)
        if IS_IMPUTED in days.columns:
            flags = days.select(DAY, F.col(IS_IMPUTED).alias("_estimated"))
            values, estimated = values.join(broadcast_days(flags), DAY, "left"), F.coalesce("_estimated", F.lit(False))
        draft.write_values(values, estimated)
        if IS_IMPUTED in days.columns:
            draft.write_sums(draft.observed(), None)
        return draft.complete(days, generated_at)

    def revise(self, removed: DataFrame, added: DailyMatrix, codec: str = CODEC) -> "Revision":
        """A new version, not complete yet, in which the observed values of ``removed`` days
        and of the days that ``added`` has are replaced by those of ``added``.

        Only the years and months of these days are read and written.
        """
        changed = removed.select(DAY).unionByName(added.days.select(DAY)).distinct()
        years, months = changed.agg(F.collect_set(F.year(DAY)), F.collect_set(F.month(DAY))).first()
        parts = self.parts()
        stale = [p for p in parts if p.kind == ESTIMATED or p.key in (years if p.kind == OBSERVED else months)]
        draft = Revision(self, [p for p in parts if p not in stale], codec)
        draft.former = [p for p in parts if p.kind == ESTIMATED]
        if not years:
            return draft
        stored = self.read_parts(parts, OBSERVED, years)
        kept = stored.join(broadcast_days(changed), DAY, "left_anti")
        draft.write_values(kept.unionByName(added.values), F.lit(False))
        gone = stored.join(broadcast_days(changed), DAY, "left_semi").withColumn(VALUE, -F.col(VALUE))
        draft.write_sums(gone.unionByName(added.values), self.read_parts(parts, SUMS, months))
        return draft

    def drop(self, version: int) -> None:
        """Delete a version, and the folders that no other one names."""
        self.versions.folder.delete(f"v={version:06d}")
        self._collect()

    def expire(self, keep: int) -> list[int]:
        """Delete all but the newest ``keep`` versions and what only they named."""
        old = self.versions.expire(keep)
        if old:
            self._collect()
        return old

    def _collect(self) -> None:
        """Delete the folders that no complete version names."""
        named = {part for version in self.versions.all() for part in self.parts(version)}
        root = Folder(self.spark, self.parts_path)
        for write in root.names():
            left = 0
            for kind in Folder(self.spark, f"{root.path}/{write}").names():
                for key in Folder(self.spark, f"{root.path}/{write}/{kind}").names():
                    if not (kind.startswith("kind=") and key.startswith("key=")):
                        continue
                    if Part(kind[5:], int(key[4:]), int(write[2:])) in named:
                        left += 1
                    else:
                        root.delete(f"{write}/{kind}/{key}")
            if not left:
                root.delete(write)


class Revision:
    """A version in the making.  It counts once it is complete; what a broken one left is
    written over by the next."""

    def __init__(self, store: MatrixStore, parts: list[Part], codec: str):
        self.store, self.parts, self.codec = store, parts, codec
        self.former: list[Part] = []  # folders of estimates of the version before
        self.number = store.versions.next()
        self.path = store.versions.path(self.number)
        self.folder = Folder(store.spark, f"{store.parts_path}/w={self.number:06d}")
        self.folder.delete()

    def observed(self, years: Iterable[int] | None = None) -> DataFrame:
        return self.store.read_parts(self.parts, OBSERVED, years)

    def sums(self) -> DataFrame:
        return self.store.read_parts(self.parts, SUMS)

    def write_days(self, days: DataFrame) -> DataFrame:
        days.coalesce(1).write.mode("overwrite").option("compression", self.codec).parquet(f"{self.path}/days")
        return self.store.spark.read.parquet(f"{self.path}/days")

    def write_values(self, values: DataFrame, estimated: Column) -> None:
        kind = F.when(estimated, F.lit(ESTIMATED)).otherwise(F.lit(OBSERVED))
        self._write(values.select(DAY, FEATURE, VALUE, kind.alias("kind"), F.year(DAY).alias("key")), DAY)

    def write_sums(self, changes: DataFrame, before: DataFrame | None) -> None:
        """Sums of values, on top of those ``before``; what comes to nothing goes."""
        rows = changes.select(month_day(DAY).alias(MONTH_DAY), FEATURE, VALUE)
        if before is not None:
            rows = rows.unionByName(before)
        sums = rows.groupBy(MONTH_DAY, FEATURE).agg(F.sum(VALUE).alias(VALUE)).where(F.col(VALUE) != 0)
        month = F.floor(F.col(MONTH_DAY) / 100).cast("int")
        self._write(sums.withColumns({"kind": F.lit(SUMS), "key": month}), MONTH_DAY)

    def _write(self, rows: DataFrame, order: str) -> None:
        """Rows by kind and key, each folder in the order of its days, so that a reader of
        a few days skips the rest."""
        # a rebalance lets the engine split or merge folders to even file sizes
        even = rows.hint("rebalance", "kind", "key").sortWithinPartitions("kind", "key", order)
        even.write.mode("append").option("compression", self.codec).partitionBy("kind", "key").parquet(self.folder.path)
        known = {(p.kind, p.key) for p in self.parts if p.version == self.number}
        for kind in (n[5:] for n in self.folder.names() if n.startswith("kind=")):
            for name in Folder(self.store.spark, f"{self.folder.path}/kind={kind}").names():
                if name.startswith("key=") and (kind, int(name[4:])) not in known:
                    self.parts.append(Part(kind, int(name[4:]), self.number))

    def publish(
        self,
        days: DataFrame,
        generated_at: datetime,
        estimates: DataFrame | None = None,
        estimated_years: Iterable[int] | None = None,
    ) -> int:
        """Complete the version with its day table and the values of estimated days, by
        default all of them, else those of some years; other years keep theirs."""
        if estimated_years is not None:
            self.parts += [p for p in self.former if p.key not in estimated_years]
        if estimates is not None:
            self.write_values(estimates, F.lit(True))
        return self.complete(self.write_days(days), generated_at)

    def complete(self, days: DataFrame, generated_at: datetime) -> int:
        """``days`` is the written day table."""
        write_imputation_metadata(days, self.path, self.path, generated_at)
        manifest = json.dumps(sorted(self.parts))
        Folder(self.store.spark, self.path).write_text(MatrixStore.MANIFEST, manifest)
        self.store.versions.complete(self.number)
        if self.store.keep:
            self.store.expire(self.store.keep)
        return self.number


class CursorStore:
    """One-row table that says which days have been processed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.versions = _Versions(spark, path)

    def exists(self) -> bool:
        return self.versions.latest() is not None

    def write(self, cursor: DataFrame) -> None:
        version = self.versions.next()
        cursor.coalesce(1).write.parquet(self.versions.path(version))
        self.versions.complete(version)

    def read(self) -> DataFrame:
        version = self.versions.latest()
        if version is None:
            return self.spark.createDataFrame([], CURSOR_SCHEMA)
        return self.spark.read.schema(CURSOR_SCHEMA).parquet(self.versions.path(version))

    def last_day(self) -> date | None:
        row = self.read().agg(F.max("max_timestamp")).first()
        return row[0]


def cursor_of(
    rows: DataFrame, updated_at: datetime, day: str = DAY, before: date | None = None
) -> DataFrame:
    """Cursor over the observed rows, optionally only those before a day.

    One row, or none when no observed row is left.
    """
    when = day_of(rows, day)
    observed = when.isNotNull()
    if IS_IMPUTED in rows.columns:
        observed = observed & ~flag(IS_IMPUTED, rows.schema[IS_IMPUTED].dataType)
    if before is not None:
        observed = observed & (when < F.lit(before))
    summary = rows.where(observed).agg(
        F.lit(updated_at).cast("timestamp").alias("last_update"),
        F.min(when).alias("min_timestamp"),
        F.max(when).alias("max_timestamp"),
        F.count("*").alias("num_rows"),
    )
    return summary.where("num_rows > 0")


class StagingArea:
    """Rows waiting for publication, one folder per run.

    A run that is repeated replaces its own rows, so a crash between staging and
    publishing cannot count anything twice.  A run's files hold ranges of days, and the
    first and last day of each file is noted beside the run, so that publishing a range
    and expiry deal with whole files.  Days are removed from a run by one marker, which
    readers heed at once; files that hold nothing else go after it.
    """

    BOUNDS_SCHEMA = "file string, column string, first_day date, last_day date"

    def __init__(self, spark: SparkSession, path: str, retention_days: int | None = None):
        self.spark = spark
        path = path.rstrip("/")
        self.folder = Folder(spark, f"{path}/runs")
        self.bounds_folder = Folder(spark, f"{path}/bounds")
        self.removed_folder = Folder(spark, f"{path}/removed")
        self.cursor = CursorStore(spark, f"{path}/cursor")
        self.retention_days = retention_days

    def runs(self) -> list[str]:
        """Completely written runs in order."""
        names = [n for n in self.folder.names() if n.startswith("run=")]
        return [n[4:] for n in names if self.folder.exists(f"{n}/_SUCCESS")]

    def append(
        self,
        rows: DataFrame,
        run: str,
        as_of: date,
        timestamp: str = DAY,
        chunk_rows: int = CHUNK_ROWS,
    ) -> None:
        """Stage the rows dated up to ``as_of`` under a run name.  Run names sort
        in the order they should apply.  Rows without a time column get ``as_of``."""
        if timestamp not in rows.columns:
            rows = rows.withColumn(timestamp, F.lit(as_of))
        kept = drop_future_rows(rows, timestamp, as_of)
        path = f"{self.folder.path}/run={run}"
        self.clear([run])
        (
            kept.repartitionByRange(timestamp)
            .sortWithinPartitions(timestamp, *({IDENTITY} & set(kept.columns) - {timestamp}))
            .write.mode("overwrite")
            .option("compression", CODEC)
            .option("maxRecordsPerFile", chunk_rows)
            .parquet(path)
        )
        written = self.spark.read.schema(kept.schema).parquet(path)
        self._file_bounds(written, timestamp).coalesce(1).write.parquet(f"{self.bounds_folder.path}/run={run}")

    @staticmethod
    def _file_bounds(rows: DataFrame, timestamp: str) -> DataFrame:
        when = day_of(rows, timestamp)
        bounds = rows.groupBy(F.col("_metadata.file_name").alias("file"))
        return bounds.agg(F.min(when).alias("first_day"), F.max(when).alias("last_day")).select(
            "file", F.lit(timestamp).alias("column"), "first_day", "last_day"
        )

    def bounds(self, runs: list[str], timestamp: str = DAY) -> DataFrame:
        """``(run, file, first_day, last_day)`` of the files of some runs, as noted when
        they were staged, or as found in runs that others wrote."""
        none = self.spark.createDataFrame([], f"run string, {self.BOUNDS_SCHEMA}").drop("column")
        noted = [r for r in runs if self.bounds_folder.exists(f"run={r}/_SUCCESS")]
        paths = [f"{self.bounds_folder.path}/run={r}" for r in noted]
        found = none
        if paths:
            read = self.spark.read.schema(f"{self.BOUNDS_SCHEMA}, run string").option("basePath", self.bounds_folder.path)
            found = read.parquet(*paths).where(F.col("column") == timestamp).select(none.columns)
        for run in set(runs) - set(noted):
            rows = self._read([f"{self.folder.path}/run={run}"])
            if timestamp in rows.columns:
                named = self._file_bounds(rows, timestamp).withColumn("run", F.lit(run))
                found = found.unionByName(named.select(none.columns))
        return found

    def _files(self, run: str) -> list[str]:
        folder = Folder(self.spark, f"{self.folder.path}/run={run}")
        return [n for n in folder.names() if not n.startswith(("_", "."))]

    def removed(self, run: str) -> list[tuple[str, date, date]]:
        """Column, first and last day of the ranges removed from a run."""
        names = Folder(self.spark, f"{self.removed_folder.path}/run={run}").names()
        ranges = [n.rsplit("_", 2) for n in names if not n.startswith(".")]
        return [(column, date.fromisoformat(start), date.fromisoformat(end)) for column, start, end in ranges]

    def load(
        self,
        runs: list[str] | None = None,
        within: tuple[date, date] | None = None,
        touching: DataFrame | None = None,
        timestamp: str = DAY,
    ) -> DataFrame | None:
        """Rows of the given or all runs with their ``run``; None when empty.

        ``within`` an inclusive range or ``touching`` days of a table, only files that may
        hold such days are read; they may hold others too.
        """
        runs = self.runs() if runs is None else runs
        paths = [f"{self.folder.path}/run={r}" for r in runs if self._files(r)]
        if within or touching is not None:
            bounds = self.bounds(runs, timestamp)
            if within:
                bounds = bounds.withColumn("_in", date_overlap(F.col("first_day"), F.col("last_day"), *within))
            else:
                days = broadcast_days(touching.select(F.col(DAY).alias("_touched")))
                inside = F.col("_touched").between(F.col("first_day"), F.col("last_day"))
                hit = bounds.join(days, inside, "left_semi").withColumn("_in", F.lit(True))
                bounds = bounds.join(hit.select("run", "file", "_in"), ["run", "file"], "left")
            known = {(r["run"], r["file"]): r["_in"] for r in bounds.select("run", "file", "_in").collect()}
            # A file nobody noted may hold any day.
            wanted = [(r, f) for r in runs for f in self._files(r) if known.get((r, f), (r, f) not in known)]
            paths = [f"{self.folder.path}/run={r}/{f}" for r, f in wanted]
        if not paths:
            return None
        rows = self._read(paths)
        for run in runs:
            for column, start, end in self.removed(run):
                gone = (F.col("run") == run) & date_range(day_of(rows, column), start, end)
                rows = rows.where(~F.coalesce(gone, F.lit(False)))
        return rows

    def _read(self, paths: list[str]) -> DataFrame:
        # the run name is text even when it looks like a number
        schema = read_parquet(self.spark, *paths).schema.add("run", "string")
        read = self.spark.read.option("basePath", self.folder.path).option("mergeSchema", True)
        return read.schema(schema).parquet(*paths)

    def load_rows(self, identity: str = IDENTITY, columns: list[str] | None = None) -> DataFrame | None:
        """All staged rows; of rows with one identity the last stored one.  Of given
        columns only these are read, besides the identity and the run."""
        rows = self.load()
        if rows is not None and columns is not None:
            rows = rows.select(*[c for c in rows.columns if c in (identity, "run", *columns)])
        if rows is not None and identity in rows.columns:
            rows = keep_last(with_file_order(rows), [identity], ["run", *FILE_ORDER])
        return rows

    def remove_days(self, run: str, start: date, end: date, timestamp: str = DAY) -> None:
        """Remove an inclusive range of days from a run, in one step for its readers."""
        self.removed_folder.touch(f"run={run}/{timestamp}_{start}_{end}")
        inside = date_range(F.col("first_day"), start, end) & date_range(F.col("last_day"), start, end)
        for row in self.bounds([run], timestamp).where(inside).collect():
            self.folder.delete(f"run={run}/{row['file']}")

    def clear(self, runs: list[str] | None = None) -> int:
        """Remove runs, by default all of them; the cursor stays."""
        runs = self.runs() if runs is None else runs
        for run in runs:
            # Rows go first: what was removed from them must not come back.
            for folder in (self.folder, self.bounds_folder, self.removed_folder):
                folder.delete(f"run={run}")
        return len(runs)

    def expire(self, as_of: date, timestamp: str = DAY, runs: list[str] | None = None) -> list[str]:
        """Remove files whose latest row is older than the retention period, and runs of
        which nothing is left.

        Meant for rows that are published; publications that keep their runs call it.
        """
        runs = self.runs() if runs is None else [r for r in runs if r in self.runs()]
        if not runs or not self.retention_days or self.retention_days <= 0:
            return []
        cutoff = as_of - timedelta(days=self.retention_days)
        old = []
        for row in self.bounds(runs, timestamp).where(F.col("last_day") < F.lit(cutoff)).collect():
            name = f"run={row['run']}/{row['file']}"
            if self.folder.exists(name):
                self.folder.delete(name)
                old.append(f"{self.folder.path}/{name}")
        self.clear([run for run in runs if not self._files(run)])
        return old


def date_overlap(first: Column, last: Column, start: date, end: date) -> Column:
    """Whether the days from ``first`` to ``last`` reach into an inclusive range."""
    return (first <= F.lit(end)) & (last >= F.lit(start))


def expired_files(
    rows: DataFrame, as_of: date, retention_days: int, timestamp: str = DAY
) -> DataFrame:
    """Files of a Parquet scan whose latest day is before ``as_of`` minus the
    retention period: ``(file, last_day)``."""
    cutoff = as_of - timedelta(days=retention_days)
    files = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.max(day_of(rows, timestamp)).alias("last_day")
    )
    return files.where(F.col("last_day") < F.lit(cutoff))
