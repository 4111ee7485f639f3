"""Stored matrices as manifests of folders, staged files by days, replaced folders."""

from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from daymatrix.model import DailyMatrix, observed_days
from daymatrix.operators.impute import impute
from daymatrix.plans.incremental import publish, refresh_imputation, replace_days, staged_matrix
from daymatrix.plans.maintenance import delete_days, delete_parquet_rows, delete_staged_days, without_days
from daymatrix.session import Folder
from daymatrix.sources.readers import read_parquet
from daymatrix.sources.replace import replace_dataset
from daymatrix.sources.store import ESTIMATED, OBSERVED, SUMS, MatrixStore, StagingArea


def values(m):
    return {(str(r["day"]), r["feature"]): r["value"] for r in m.values.collect() if r["value"]}


def day_table(m):
    return sorted(tuple(r) for r in m.days.collect())


def rows_of(spark, *spans, factor=1):
    """Two features on every second day of the spans."""
    rows = []
    for start, end in spans:
        day = date.fromisoformat(start)
        while day <= date.fromisoformat(end):
            rows += [(day, "x", float(factor * (day.day + day.month))), (day, "y", float(factor * (day.year % 7)))]
            day += timedelta(days=2)
    return spark.createDataFrame(rows, "day date, feature string, value double")


@pytest.fixture
def four_years(spark, tmp_path, as_of, now):
    """Days of 2020 to 2023 published with estimates."""
    store, staging = MatrixStore(spark, f"{tmp_path}/m"), StagingArea(spark, f"{tmp_path}/s")
    staging.append(rows_of(spark, ("2020-01-01", "2022-03-01"), ("2022-03-08", "2023-06-30")), "1", as_of)
    publish(store, staging, as_of, now, impute_until=date(2023, 7, 10))
    return store, staging


def test_an_increment_writes_the_folders_it_changes(spark, four_years, as_of, now):
    store, staging = four_years
    before = set(store.parts())
    staging.append(rows_of(spark, ("2023-07-11", "2023-07-11")), "2", as_of)
    publish(store, staging, as_of, now, impute_until=date(2023, 7, 12))
    written = set(store.parts()) - before
    assert {(p.kind, p.key) for p in written if p.kind != ESTIMATED} == {(OBSERVED, 2023), (SUMS, 7)}
    assert {p.key for p in written if p.kind == ESTIMATED} == {2020, 2021, 2022, 2023}
    kept = {(p.kind, p.key) for p in store.parts() if p in before}
    assert kept == {(OBSERVED, y) for y in (2020, 2021, 2022)} | {(SUMS, m) for m in range(1, 13) if m != 7}
    assert ("2023-07-11", "x") in values(store.load()) and ("2020-01-01", "x") in values(store.load())


def test_estimates_from_sums_equal_those_of_the_whole_history(spark, four_years, as_of, now):
    store, staging = four_years
    steps = [
        rows_of(spark, ("2021-01-02", "2021-01-06"), ("2023-07-20", "2023-07-22"), factor=3),
        rows_of(spark, ("2020-02-28", "2020-03-03"), factor=5),  # history of later gaps, and a leap day
        rows_of(spark, ("2019-12-30", "2019-12-30")),  # before all others
    ]
    expected = drop = store.load()
    for run, rows in enumerate(steps, 2):
        staging.append(rows, str(run), as_of)
        publish(store, staging, as_of, now, impute_until=date(2023, 8, 1))
        new = DailyMatrix(rows, observed_days(rows.select("day").distinct()))
        drop = replace_days(expected, new)
        expected = impute(drop, as_of, now, target_until=date(2023, 8, 1))
        found, wanted = values(store.load()), values(expected)
        assert set(found) == set(wanted)
        assert all(found[k] == pytest.approx(wanted[k]) for k in wanted)
        assert day_table(store.load()) == day_table(expected)
        expected = store.load()


def test_new_days_do_not_read_the_history(spark, four_years):
    store, _ = four_years
    draft = store.revise(store.days().limit(0), DailyMatrix.observed(rows_of(spark, ("2023-07-11", "2023-07-11"))))
    read = draft.observed([2023]).inputFiles() + draft.sums().inputFiles()
    assert not [f for f in read if "kind=observed/key=202" in f and "key=2023" not in f]


def test_a_range_reads_the_folders_of_its_years(spark, four_years):
    store, _ = four_years
    some = store.load(start=date(2021, 3, 1), end=date(2021, 4, 30))
    assert {f.split("key=")[1][:4] for f in some.values.inputFiles()} == {"2021"}
    plan = some.values._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key" in plan and "GreaterThanOrEqual(day,2021-03-01)" in plan
    whole = store.load().select_days(F.col("day").between("2021-03-01", "2021-04-30"))
    assert values(some) == values(whole) and day_table(some) == day_table(whole)
    open_end = store.load(start=date(2023, 1, 1))
    assert {d[:4] for d, _ in values(open_end)} == {"2023"}
    assert store.load(start=date(1990, 1, 1), end=date(1991, 1, 1)).values.count() == 0


def test_old_folders_go_with_the_last_version_that_names_them(spark, tmp_path, as_of, now):
    store, staging = MatrixStore(spark, f"{tmp_path}/m", keep=2), StagingArea(spark, f"{tmp_path}/s")
    for run, (start, end) in enumerate([("2020-01-01", "2021-02-01"), ("2021-02-02", "2021-02-05"), ("2021-02-06", "2021-02-07")]):
        staging.append(rows_of(spark, (start, end)), str(run), as_of)
        publish(store, staging, as_of, now)
    assert store.versions.all() == [2, 3]
    on_disk = {str(p.relative_to(tmp_path / "m" / "parts")) for p in (tmp_path / "m" / "parts").glob("w=*/kind=*/key=*")}
    named = {p for v in (2, 3) for p in store.parts(v)}
    assert on_disk == {f"w={p.version:06d}/kind={p.kind}/key={p.key}" for p in named}
    assert "w=000001/kind=observed/key=2020" in on_disk and "w=000001/kind=observed/key=2021" not in on_disk
    assert len(values(store.load(2))) < len(values(store.load(3)))


def test_a_broken_publication_changes_nothing(spark, four_years, as_of, now, monkeypatch):
    store, staging = four_years
    before = values(store.load())
    staging.append(rows_of(spark, ("2023-07-11", "2023-07-11")), "2", as_of)
    with monkeypatch.context() as broken:
        broken.setattr(MatrixStore, "MANIFEST", "no/such\0name")
        with pytest.raises(Exception):
            publish(store, staging, as_of, now)
    assert values(store.load()) == before and staging.runs() == ["2"]
    publish(store, staging, as_of, now)
    assert ("2023-07-11", "x") in values(store.load()) and staging.runs() == []


def test_deletion_writes_the_years_of_its_range(spark, four_years, now):
    store, _ = four_years
    before, whole = set(store.parts()), store.load()
    wanted = values(whole.select_days(~F.col("day").between("2021-12-30", "2022-03-05")))
    delete_days(store, date(2021, 12, 30), date(2022, 3, 5), now)
    assert values(store.load()) == wanted
    written = {(p.kind, p.key) for p in set(store.parts()) - before}
    assert written == {(k, y) for k in (OBSERVED, ESTIMATED) for y in (2021, 2022)} | {(SUMS, m) for m in (1, 2, 3, 12)}
    # What is estimated afterwards no longer knows the deleted days.
    refresh_imputation(store, date(2023, 7, 10), now, date(2023, 7, 10))
    observed = whole.select_days(~F.col("day").between("2021-12-30", "2022-03-05"))
    fresh = impute(observed, date(2023, 7, 10), now, target_until=date(2023, 7, 10))
    found, wanted = values(store.load()), values(fresh)
    assert found.keys() == wanted.keys() and all(found[k] == pytest.approx(wanted[k]) for k in wanted)


def test_days_of_zeros_are_days(spark, tmp_path, as_of, now, series):
    store = MatrixStore(spark, f"{tmp_path}/m")
    days = observed_days(series({"2019-05-01": 1, "2020-05-01": 1}).select("day"))
    store.publish(DailyMatrix(series({"2020-05-01": 1}), days), as_of, now)  # no value in 2019
    assert store.load().days.count() == 2 and values(store.load()) == {("2020-05-01", "x"): 1}


# --- staged files ----------------------------------------------------------------------


def test_staged_files_hold_ranges_of_days(spark, tmp_path, as_of):
    staging = StagingArea(spark, f"{tmp_path}/s")
    staging.append(rows_of(spark, ("2020-01-01", "2023-12-31")), "1", as_of, chunk_rows=100)
    staging.append(rows_of(spark, ("2022-05-05", "2022-05-07"), factor=2), "2", as_of)
    bounds = sorted((r["first_day"], r["last_day"]) for r in staging.bounds(["1"]).collect())
    assert len(bounds) > 10 and all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))
    few = staging.load(within=(date(2021, 3, 1), date(2021, 3, 5)))
    assert len(few.inputFiles()) <= 2 and few.where("day BETWEEN '2021-03-01' AND '2021-03-05'").count() == 4
    touched = staging.load(["2"]).select("day")
    assert len(staging.load(touching=touched).inputFiles()) <= 3
    m = staged_matrix(staging, ["1", "2"], news=["2"])
    assert values(m)["2022-05-05", "x"] == 20 and {d for d, _ in values(m)} == {"2022-05-05", "2022-05-07"}


def test_files_nobody_noted_are_read(spark, tmp_path, as_of, series):
    staging = StagingArea(spark, f"{tmp_path}/s")
    staging.append(series({"2024-01-01": 1}), "1", as_of)
    series({"2024-02-02": 2}).write.mode("append").parquet(f"{tmp_path}/s/runs/run=1")
    series({"2024-03-03": 3}).write.parquet(f"{tmp_path}/s/runs/run=2")
    found = staging.load(within=(date(2024, 2, 1), date(2024, 3, 31))).select("day").distinct().collect()
    assert {str(r[0]) for r in found} == {"2024-02-02", "2024-03-03"}


def test_removed_days_stay_away_until_the_run_is_staged_again(spark, tmp_path, as_of, now, monkeypatch):
    staging = StagingArea(spark, f"{tmp_path}/s")
    staging.append(rows_of(spark, ("2024-01-01", "2024-01-31")), "1", as_of, chunk_rows=4)
    with monkeypatch.context() as broken:  # stopped between the marker and the files
        broken.setattr(StagingArea, "bounds", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            staging.remove_days("1", date(2024, 1, 3), date(2024, 1, 29))
    assert {str(r[0]) for r in staging.load().select("day").distinct().collect()} == {"2024-01-01", "2024-01-31"}
    files = len(list((tmp_path / "s/runs/run=1").glob("*.parquet")))
    done = delete_staged_days(staging, "1", date(2024, 1, 1), date(2024, 1, 30), now)
    assert (done.deleted, done.remaining) == (2, 2)
    assert len(list((tmp_path / "s/runs/run=1").glob("*.parquet"))) < files
    staging.append(rows_of(spark, ("2024-01-01", "2024-01-31")), "1", as_of)
    assert staging.load().select("day").distinct().count() == 16


def test_rows_expire_under_the_stream(spark, tmp_path, now, series):
    from daymatrix.streaming.publish import publish_available

    as_of = date(2023, 12, 31)
    store, staging = MatrixStore(spark, f"{tmp_path}/m"), StagingArea(spark, f"{tmp_path}/s", retention_days=30)
    staging.append(rows_of(spark, ("2020-01-01", "2023-12-31")), "1", as_of, chunk_rows=50)
    staging.append(series({"2020-01-01": 7}), "2", as_of)
    publish_available(spark, staging, store, f"{tmp_path}/c", as_of, now)
    left = staging.load().agg(F.min("day"), F.max("day")).first()
    assert left[0] > date(2023, 10, 1) and left[1] >= date(2023, 12, 30)
    assert staging.runs() == ["1"]  # nothing of the other is left
    assert len(store.load().days.collect()) == 731 and values(store.load())["2020-01-01", "x"] == 7
    staging.append(series({"2023-12-31": 9}), "3", as_of)
    publish_available(spark, staging, store, f"{tmp_path}/c", as_of, now)
    found = values(store.load())
    assert found["2023-12-31", "x"] == 9 and found["2020-01-03", "x"] == 4


# --- replaced folders ------------------------------------------------------------------


@pytest.mark.parametrize("stop", ["copy", "switch", "first rename", "second rename", "clean-up"])
@pytest.mark.parametrize("backup", [True, False])
def test_a_stopped_replacement_is_finished_or_undone(spark, tmp_path, now, monkeypatch, stop, backup):
    path = f"{tmp_path}/t"
    rows = [(date(2024, 1, 1), 1), (date(2024, 1, 2), 2), (None, 3)]
    spark.createDataFrame(rows, "timestamp date, x int").write.parquet(path)
    calls = {"n": 0}

    def stopped(real, at):
        def call(*a, **b):
            calls["n"] += 1
            if calls["n"] == at:
                raise KeyboardInterrupt
            return real(*a, **b)

        return call

    with monkeypatch.context() as broken:
        if stop in ("copy", "switch"):
            broken.setattr(Folder, "write_text", stopped(Folder.write_text, 1))
        elif stop == "clean-up":
            broken.setattr(Folder, "delete", stopped(Folder.delete, 1))
        else:
            broken.setattr(Folder, "rename", stopped(Folder.rename, 1 if stop == "first rename" else 2))
        with pytest.raises(KeyboardInterrupt):
            delete_parquet_rows(spark, path, date(2024, 1, 2), date(2024, 1, 2), now, create_backup=backup)
    left = sorted(r["x"] for r in read_parquet(spark, path).collect())
    assert left == ([1, 2, 3] if stop in ("copy", "switch") else [1, 3])
    # The next replacement finds nothing in its way.
    replace_dataset(spark.createDataFrame([(None, 9)], "timestamp date, x int"), path, None)
    assert [r["x"] for r in spark.read.parquet(path).collect()] == [9]
    backups = [p for p in Path(tmp_path).glob("t.bak*")]
    assert len(backups) == (backup and stop not in ("copy", "switch"))
    hidden = {p.name for p in Path(tmp_path).iterdir() if p.name.startswith(".t")}
    assert hidden <= {".t.switch.crc", "..t.switch.crc"}


def test_days_outside_a_range_reach_the_scan(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([(date(2024, 1, 1),), (None,)], "day date").write.parquet(path)
    kept = without_days(spark.read.parquet(path), date(2024, 1, 1), date(2024, 1, 1))
    assert "PushedFilters: [Or(" in kept._jdf.queryExecution().executedPlan().toString()
    assert [r["day"] for r in kept.collect()] == [None]
