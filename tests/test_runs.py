import json
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from frames import wide_rows
from pyspark.sql import functions as F

from daymatrix.model import DailyMatrix
from daymatrix.operators.identity import with_row_identity
from daymatrix.operators.impute import drop_imputed
from daymatrix.operators.prepare import facility_lookup
from daymatrix.operators.selection import code_selection, region_selection
from daymatrix.plans.full import full_coded, full_visits, join_stores
from daymatrix.plans.incremental import (
    Run,
    Selections,
    publish,
    refresh_imputation,
    replace_days,
    run_coded,
    run_visits,
)
from daymatrix.plans.maintenance import (
    delete_days,
    delete_parquet_rows,
    delete_staged_days,
    show_rows,
)
from daymatrix.plans.windows import latest, processing_window, resume_day
from daymatrix.sources import readers
from daymatrix.sources.store import CursorStore, MatrixStore, StagingArea


def values(m):
    return {(r["day"].isoformat(), r["feature"]): r["value"] for r in m.values.collect()}


@pytest.fixture
def places(spark, tmp_path):
    return MatrixStore(spark, f"{tmp_path}/store"), StagingArea(spark, f"{tmp_path}/staging")


def test_windows():
    day = date.fromisoformat
    window = processing_window(
        day("2026-01-01"), day("2026-05-27"), day("2025-12-31"), None, day("2026-06-02"), day("2026-06-02")
    )
    assert window == (day("2026-01-01"), day("2026-05-28"), day("2026-05-27"))
    assert processing_window(day("2026-01-01"), day("2026-05-27"), day("2026-05-27"), today=day("2026-06-02")) is None
    requested = processing_window(
        day("2026-01-01"), day("2026-05-27"), day("2026-05-01"), day("2025-01-01"), day("2026-02-01"), day("2026-06-02")
    )
    assert requested == (day("2026-01-01"), day("2026-02-02"), day("2026-02-01"))
    a, b = day("2024-01-01"), day("2024-02-01")
    assert resume_day(True, b, a) == a
    assert resume_day(True, None, a) is None
    assert resume_day(False, None, a) == a
    assert resume_day(True, b, None) == b
    assert latest(None, a, b) == b and latest(None) is None


def test_year_slices():
    slices = readers.year_slices(date(2023, 12, 30), date(2025, 1, 1))
    assert slices == [
        (2023, date(2023, 12, 30), date(2024, 1, 1)),
        (2024, date(2024, 1, 1), date(2025, 1, 1)),
    ]


def test_scans(spark, tmp_path):
    (tmp_path / "in.csv").write_text("UP,day\n00348,2024-01-01\n7,x\n9,2024-01-03\n8,2090-01-01\n")
    df = readers.read_csv(spark, f"{tmp_path}/in.csv", ["UP", "day"])
    assert [r["UP"] for r in df.collect()] == ["00348", "7", "9", "8"]
    with pytest.raises(ValueError):
        readers.read_csv(spark, f"{tmp_path}/in.csv", ["other"])
    bounds = readers.date_bounds(df, "day", date(2024, 6, 1)).first()
    assert tuple(bounds) == (date(2024, 1, 1), date(2024, 1, 3))
    assert tuple(readers.date_bounds(df, "day", date(2020, 6, 1)).first()) == (None, None)
    assert readers.read_parquet(spark, f"{tmp_path}/missing") is None


def test_range_condition_reaches_the_scan(spark, tmp_path):
    path = f"{tmp_path}/facts"
    spark.range(10).selectExpr(
        "id", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id AS int)) AS at", "id AS other"
    ).write.parquet(path)
    rows = readers.scan_range(spark.read.parquet(path), "at", date(2024, 1, 3), date(2024, 1, 5), ["id"])
    plan = rows._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(at" in plan and "LessThan(at" in plan
    assert "other" not in plan.split("ReadSchema")[1]
    assert sorted(r["id"] for r in rows.collect()) == [2, 3]


def test_full_run_of_the_sample(spark, sample, as_of):
    visits, coded, raw = sample
    lookup = facility_lookup(raw)
    codes = code_selection(
        spark.createDataFrame([("J00-J06", "G01"), ("J00", "D01")], "ICD10_3 string, feature_name string")
    )
    regions = region_selection(spark.createDataFrame([("RS_64", "GIRONA")], "geo_id string, RS string"))
    chosen = Selections(regions=regions, codes=codes)
    a = full_visits(visits, lookup, as_of, chosen)
    b = full_coded(coded, lookup, as_of, chosen, start=date(2026, 1, 1), end=date(2026, 1, 2))
    assert {d for d, _ in values(a)} == {"2026-01-01", "2026-01-02", "2026-01-04"}
    assert {d for d, _ in values(b)} == {"2026-01-01", "2026-01-02"}
    names = {f for _, f in values(b)}
    assert {"DIAGNOSIS__TOTAL__RS__RS_64", "DIAGNOSIS__ICD10_3__G01__RS__RS_64"} <= names


def test_incremental_equals_full(spark, sample, as_of, now, places):
    visits, _, raw = sample
    lookup = facility_lookup(raw)
    store, staging = places
    first = run_visits(visits, lookup, Run(store, staging, as_of, now, end=date(2026, 1, 2)))
    assert first.window.last_day == date(2026, 1, 2)
    second = run_visits(visits, lookup, Run(store, staging, as_of, now + timedelta(hours=1)))
    # 3 January is missing in the source, so it is estimated, and so is the tail
    assert second.window.start == date(2026, 1, 3)
    full = full_visits(visits, lookup, as_of)
    assert values(drop_imputed(store.load())) == values(full)
    assert store.load().days.count() == (as_of - date(2026, 1, 1)).days + 1
    assert staging.runs() == []
    assert staging.cursor.last_day() == date(2026, 1, 4)


def test_nothing_new_refreshes_the_estimates(spark, sample, as_of, now, places):
    visits, _, raw = sample
    store, staging = places
    complete = visits.where("DATA_VISITA LIKE '2026-01-01%' OR DATA_VISITA LIKE '2026-01-02%'")
    run = Run(store, staging, as_of, now, end=date(2026, 1, 2))
    run_visits(complete, facility_lookup(raw), run)
    again = run_visits(complete, facility_lookup(raw), Run(store, staging, as_of, now, end=date(2026, 1, 5)))
    assert again.window is None and again.version == 2
    assert store.load().days.where("__is_imputed").count() == 3
    assert refresh_imputation(store, as_of, now, None) is None


def test_reprocessing_an_old_range_keeps_later_days(spark, sample, as_of, now, places):
    _, coded, raw = sample
    store, staging = places
    run_coded(coded, facility_lookup(raw), Run(store, staging, as_of, now, end=date(2026, 1, 4)))
    before = values(store.load())
    changed = coded.where("problema_salut_c <> 'J00'")
    run = Run(store, staging, as_of, now, date(2026, 1, 1), date(2026, 1, 1), name="again")
    run_coded(changed, facility_lookup(raw), run)
    after = values(store.load())
    assert after["2026-01-01", "DIAGNOSIS__TOTAL"] == before["2026-01-01", "DIAGNOSIS__TOTAL"] - 1
    assert ("2026-01-01", "DIAGNOSIS__TOTAL__UP__00348") not in after
    assert {k: v for k, v in after.items() if k[0] > "2026-01-01"} == {
        k: v for k, v in before.items() if k[0] > "2026-01-01"
    }


def test_missing_source_columns(spark, sample, as_of, now, places):
    with pytest.raises(ValueError, match="Missing columns"):
        run_coded(sample[1].drop("up_c"), facility_lookup(sample[2]), Run(*places, as_of, now))


def test_repeated_staging_counts_once(series, as_of, now, places):
    store, staging = places
    rows = series({"2024-01-01": 1, "2024-01-02": 2})
    staging.append(rows, "1", as_of)
    staging.append(rows, "1", as_of)  # the same run again
    staging.append(series({"2024-01-02": 5}), "2", as_of)  # a later run of one day
    publish(store, staging, as_of, now)
    assert values(store.load()) == {("2024-01-01", "x"): 1, ("2024-01-02", "x"): 5}
    assert publish(store, staging, as_of, now) is None


def test_publishing_a_range_and_keeping_the_stage(series, as_of, now, places):
    store, staging = places
    staging.append(series({"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 3, "2090-01-01": 4}), "1", as_of)
    publish(store, staging, as_of, now, with_range=(date(2024, 1, 2), date(2024, 1, 3)), clear=False)
    assert {d for d, _ in values(store.load())} == {"2024-01-02", "2024-01-03"}
    assert staging.runs() == ["1"]
    assert staging.clear() == 1


def test_replacing_days_twice_equals_once(series):
    stored = DailyMatrix.observed(
        series({"2024-01-01": 1, "2024-01-02": 2}).union(series({"2024-01-02": 9}, "gone"))
    )
    new = DailyMatrix.observed(series({"2024-01-02": 7}))
    once = replace_days(stored, new)
    assert values(once) == {("2024-01-01", "x"): 1, ("2024-01-02", "x"): 7}
    assert values(replace_days(once, new)) == values(once)


def test_published_metadata(spark, series, as_of, now, places):
    store, staging = places
    staging.append(series({"2024-01-01": 10, "2024-01-03": 20}), "1", as_of)
    version = publish(store, staging, as_of, now, impute_until=date(2024, 1, 3))
    folder = Path(store.versions.path(version))
    text = next((folder / "imputation_metadata").glob("*.txt")).read_text()
    summary = json.loads(text)
    assert summary["total_rows"] == 3 and summary["total_imputed_rows"] == 1
    assert summary["groups"][0]["imputed_dates"] == ["2024-01-02"]
    listed = spark.read.option("header", True).csv(str(folder / "imputed_rows")).collect()
    assert [r["timestamp"] for r in listed] == ["2024-01-02"]
    assert store.versions.expire(keep=1) == []


@pytest.fixture
def stored(series, as_of, now, places):
    store, staging = places
    staging.append(series({"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 3}), "1", as_of)
    publish(store, staging, as_of, now)
    return store, staging


def test_delete_days(stored, now):
    store, staging = stored
    dry = delete_days(store, date(2024, 1, 3), date(2024, 1, 3), now, staging, dry_run=True)
    assert (dry.deleted, dry.remaining, dry.cursor.first()["max_timestamp"]) == (1, 2, date(2024, 1, 2))
    assert store.load().days.count() == 3
    done = delete_days(store, date(2024, 1, 3), date(2024, 1, 3), now, staging)
    assert (done.deleted, done.remaining) == (1, 2) and Path(done.backup).exists()
    assert staging.cursor.last_day() == date(2024, 1, 2)
    assert set(values(store.load())) == {("2024-01-01", "x"), ("2024-01-02", "x")}
    nothing = delete_days(store, date(2030, 1, 1), date(2030, 1, 2), now, staging)
    assert nothing.deleted == 0 and nothing.backup is None
    with pytest.raises(ValueError):
        delete_days(store, date(2024, 1, 3), date(2024, 1, 1), now)
    everything = delete_days(store, date(2024, 1, 1), date(2024, 1, 9), now, staging, create_backup=False)
    assert everything.remaining == 0 and everything.backup is None
    assert staging.cursor.exists() and staging.cursor.last_day() is None


def test_cursor_skips_estimates(series, as_of, now, places):
    store, staging = places
    staging.append(series({"2024-01-01": 1, "2024-01-02": 2}), "1", as_of)
    publish(store, staging, as_of, now, impute_until=date(2024, 1, 3))
    delete_days(store, date(2024, 1, 2), date(2024, 1, 2), now, staging)
    assert staging.cursor.last_day() == date(2024, 1, 1)


def test_cursor_goes_before_the_deleted_range(series, as_of, now, places):
    store, staging = places
    staging.append(
        series({"2025-12-30": 1, "2025-12-31": 2, "2026-01-01": 3, "2026-05-29": 4}), "1", as_of
    )
    publish(store, staging, as_of, now)
    delete_days(store, date(2026, 1, 1), date(2026, 3, 1), now, staging)
    assert staging.cursor.last_day() == date(2025, 12, 31)  # not the later day that is left


def test_delete_staged_days(series, as_of, now, places):
    _, staging = places
    staging.append(series({"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 3}), "1", as_of)
    staging.append(series({"2024-01-04": 4}), "2", as_of)
    done = delete_staged_days(staging, "1", date(2024, 1, 2), date(2024, 1, 3), now)
    assert (done.deleted, done.remaining) == (2, 1)
    assert staging.cursor.last_day() == date(2024, 1, 1)
    assert staging.load().count() == 2 and staging.runs() == ["1", "2"]


def test_delete_from_any_parquet(spark, tmp_path, now):
    path = f"{tmp_path}/wide"
    rows = [("2024-01-01", 1), ("2024-01-02", 2), (None, 3)]
    spark.createDataFrame(rows, "timestamp string, x int").write.parquet(path)
    done = delete_parquet_rows(spark, path, date(2024, 1, 2), date(2024, 1, 5), now)
    assert (done.deleted, done.remaining) == (1, 2)
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [1, 3]
    assert spark.read.parquet(done.backup).count() == 3
    with pytest.raises(FileNotFoundError):
        delete_parquet_rows(spark, f"{tmp_path}/none", date(2024, 1, 2), date(2024, 1, 5), now)


def test_delete_keeps_partitions_and_stores_the_cursor(spark, tmp_path, now):
    path = f"{tmp_path}/parts"
    rows = [("2023-12-31", 2023, "a", 1), ("2024-01-01", 2024, "a", 2), ("2024-01-02", 2024, "b", 3)]
    df = spark.createDataFrame(rows, "timestamp string, y int, k string, x int")
    df.write.partitionBy("y", "k").parquet(path)
    cursors = CursorStore(spark, f"{tmp_path}/cursor")
    day = date(2024, 1, 1)
    assert delete_parquet_rows(spark, path, day, day, now, dry_run=True, cursors=cursors).deleted == 1
    assert not cursors.exists()
    delete_parquet_rows(spark, path, day, day, now, cursors=cursors)
    assert sorted(p.name for p in Path(path).glob("y=*/k=*")) == ["k=a", "k=b"]
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [1, 3]
    assert cursors.last_day() == date(2023, 12, 31)


def test_a_store_keeps_the_wanted_number_of_versions(spark, series, as_of, now, tmp_path):
    store = MatrixStore(spark, f"{tmp_path}/m", keep=2)
    for value in (1, 2, 3):
        store.publish(DailyMatrix.observed(series({"2024-01-01": value})), as_of, now)
    assert store.versions.all() == [2, 3]
    assert values(store.load()) == {("2024-01-01", "x"): 3}


def test_rows_without_a_time_column_are_staged_under_the_day_of_the_run(spark, as_of, tmp_path):
    staging = StagingArea(spark, f"{tmp_path}/s")
    staging.append(spark.createDataFrame([(1,)], "n int"), "1", as_of, "timestamp")
    assert staging.load().first()["timestamp"] == as_of


def test_show_rows(spark):
    df = spark.createDataFrame(
        [("2024-01-03", 3, 0), ("2024-01-02", 2, 0), ("2024-01-01", 1, 0), (None, 4, 0)],
        "timestamp string, x int, y int",
    )
    shown = show_rows(df, start=date(2024, 1, 2), end=date(2024, 1, 3), columns=["x"], limit=1)
    assert (shown.matched, shown.total) == (2, 4)
    assert [tuple(r) for r in shown.rows.collect()] == [("2024-01-02", 2)]
    assert show_rows(df, limit=0).matched == 4
    with pytest.raises(ValueError):
        show_rows(df, columns=["z"])
    with pytest.raises(ValueError):
        show_rows(df, limit=-1)


def test_stores_are_joined(spark, series, as_of, now, tmp_path):
    a, b, c = (MatrixStore(spark, f"{tmp_path}/{n}") for n in "abc")
    a.publish(DailyMatrix.observed(series({"2024-01-01": 1}, "DEMAND__TOTAL")), as_of, now)
    b.publish(DailyMatrix.observed(series({"2024-01-02": 2}, "DIAGNOSIS__TOTAL")), as_of, now)
    assert join_stores(a, b, c, as_of, now) == 1
    assert values(c.load())["2024-01-02", "DEMAND__TOTAL"] == 1


def test_staged_rows_and_retention(spark, tmp_path):
    staging = StagingArea(spark, f"{tmp_path}/staging", retention_days=10)
    rows = spark.createDataFrame(
        [("2024-01-01", "A", 1), ("2024-01-20", "B", 2), ("2024-01-20", "B", 3)],
        "timestamp string, DIAG_CODE string, n int",
    ).withColumn("timestamp", F.to_date("timestamp"))
    named = with_row_identity(rows)
    staging.append(named.where("n < 3"), "1", date(2024, 1, 5), "timestamp", chunk_rows=1)
    assert staging.load().count() == 1  # the later row was in the future
    staging.append(named.where("n > 1"), "2", date(2024, 1, 21), "timestamp")
    assert staging.load_rows().count() == 2  # nothing goes before it is published
    staging.expire(date(2024, 1, 21), "timestamp")
    loaded = staging.load_rows().collect()  # the first file has expired
    assert [(r["DIAG_CODE"], r["data_id"]) for r in loaded] == [("B", "2024-01-20_B")]
    unnamed = with_row_identity(spark.createDataFrame([(date(2024, 1, 1), 1)], "timestamp date, n int"))
    assert unnamed.first()["data_id"] == "2024-01-01_7b8b965a"


def test_csv_matrix(spark, tmp_path, series):
    from daymatrix.operators.matrix import to_wide

    wide = to_wide(series({"2024-01-02": 2, "2024-01-01": 1.5}))
    readers.save_matrix_csv(wide, f"{tmp_path}/m")
    assert wide_rows(readers.load_matrix_csv(spark, f"{tmp_path}/m"), "Timestamp") == {
        "2024-01-01": {"x": 1.5},
        "2024-01-02": {"x": 2.0},
    }
    wide.write.parquet(f"{tmp_path}/p")
    readers.convert_to_csv(spark, f"{tmp_path}/p", f"{tmp_path}/c")
    assert readers.read_csv(spark, f"{tmp_path}/c").columns == ["day", "x"]
    with pytest.raises(FileNotFoundError):
        readers.convert_to_csv(spark, f"{tmp_path}/none", f"{tmp_path}/c2")


def test_wide_files(spark, tmp_path, series, as_of, now):
    from daymatrix.operators.impute import impute
    from daymatrix.plans.full import export_wide, import_wide

    real = series({"2024-01-01": 10, "2024-01-03": 20}, "DEMAND__TOTAL")
    m = impute(DailyMatrix.observed(real), as_of, now, target_until=date(2024, 1, 3))
    export_wide(m, f"{tmp_path}/wide")
    back = import_wide(spark, f"{tmp_path}/wide", day="day")
    assert values(back) == values(m)
    assert {tuple(r) for r in back.days.collect()} == {tuple(r) for r in m.days.collect()}
    with pytest.raises(FileNotFoundError):
        import_wide(spark, f"{tmp_path}/none")


def test_scratch_tables_are_removed(spark, series):
    from daymatrix.session import Folder, materialize, scratch

    with scratch(spark) as path:
        assert materialize(series({"2024-01-01": 1})).count() == 1
        assert Folder(spark, path).exists()
    assert not Folder(spark, path).exists()


def test_one_facility_may_own_most_rows(spark, as_of):
    from daymatrix.operators.features import visit_features
    from daymatrix.operators.prepare import clean_visits

    rows = spark.range(30_000).selectExpr(
        "date_add(DATE'2024-01-01', cast(id % 3 AS int)) AS DATA_VISITA",
        "CASE WHEN id % 3 < 2 THEN '1' ELSE cast(id % 50 AS string) END AS UP",
        "'S' AS SERVEI_CODI",
    )
    out = visit_features(clean_visits(rows), levels=("GLOBAL", "UP"))
    totals = out.where("feature LIKE 'DEMAND!_!_TOTAL!_!_UP%' ESCAPE '!'")
    assert totals.agg(F.sum("value")).first()[0] == 30_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.split("Exchange hashpartitioning")[2]
    assert "partial_sum" in first_exchange  # combined before the first shuffle


def test_staged_files_are_published_once_by_the_stream(spark, tmp_path, series, as_of, now, places):
    from daymatrix.streaming.publish import publish_available

    store, staging = places
    checkpoint = f"{tmp_path}/checkpoint"
    staging.append(series({"2024-01-01": 1, "2024-01-02": 2}), "1", as_of)
    publish_available(spark, staging, store, checkpoint, as_of, now)
    staging.append(series({"2024-01-02": 5, "2024-01-04": 6}), "2", as_of)
    publish_available(spark, staging, store, checkpoint, as_of, now, impute_until=date(2024, 1, 4))
    publish_available(spark, staging, store, checkpoint, as_of, now)
    assert store.versions.all() == [1, 2]  # the third time there was nothing new
    out = values(store.load())
    assert (out["2024-01-01", "x"], out["2024-01-02", "x"], out["2024-01-03", "x"]) == (1, 5, 4)
    assert staging.cursor.last_day() == date(2024, 1, 4)


def staged(spark, staging, run, values, as_of):
    rows = [(date.fromisoformat(d), f, float(v)) for d, f, v in values]
    staging.append(spark.createDataFrame(rows, "day date, feature string, value double"), run, as_of)


def test_stream_keeps_later_days_split_runs_and_newer_runs(spark, as_of, now, tmp_path):
    from daymatrix.streaming.publish import publish_available

    staging, store = StagingArea(spark, f"{tmp_path}/s"), MatrixStore(spark, f"{tmp_path}/m")
    staged(spark, staging, "2", [("2024-01-01", "x", 1), ("2024-03-01", "x", 5)], as_of)
    publish = lambda: publish_available(
        spark, staging, store, f"{tmp_path}/c", as_of, now, impute_until=date(2024, 1, 10)
    )
    publish()
    assert values(store.load())["2024-03-01", "x"] == 5  # later than the target
    staged(spark, staging, "1", [("2024-01-01", "x", 7), ("2024-01-01", "y", 8)], as_of)
    publish()
    found = values(store.load())  # the older run arrived late
    assert found["2024-01-01", "x"] == 1 and ("2024-01-01", "y") not in found
    # A run that is still being written is published once it is complete.
    staged(spark, staging, "3", [("2024-01-01", "y", 2)], as_of)
    marker = tmp_path / "s" / "runs" / "run=3" / "_SUCCESS"
    marker.unlink()
    publish()
    assert ("2024-01-01", "y") not in values(store.load())
    spark.createDataFrame([(date(2024, 1, 1), "z", 3.0)], "day date, feature string, value double").write.mode(
        "append"
    ).parquet(f"{tmp_path}/s/runs/run=3")
    publish()
    found = values(store.load())
    assert found["2024-01-01", "y"] == 2 and found["2024-01-01", "z"] == 3


def test_publishing_a_range_keeps_the_other_staged_days(spark, as_of, now, tmp_path):
    from daymatrix.plans.incremental import publish

    staging, store = StagingArea(spark, f"{tmp_path}/s", retention_days=1), MatrixStore(spark, f"{tmp_path}/m")
    staged(spark, staging, "1", [("2024-01-01", "x", 1), ("2024-01-02", "x", 2)], as_of)
    first = date(2024, 1, 1)
    publish(store, staging, as_of, now, with_range=(first, first))
    assert staging.runs() == ["1"] and staging.load().count() == 1
    publish(store, staging, as_of, now)
    assert staging.runs() == []
    assert values(store.load()) == {("2024-01-01", "x"): 1, ("2024-01-02", "x"): 2}


def test_deleting_days_keeps_days_after_now(spark, series, now, tmp_path):
    store = MatrixStore(spark, f"{tmp_path}/m")
    store.publish(DailyMatrix.observed(series({"2026-01-01": 1, "2026-01-02": 2, "2026-09-01": 3})), date(2026, 12, 1), now)
    day = date(2026, 1, 2)
    done = delete_days(store, day, day, now)
    assert done.remaining == 2
    assert values(store.load()) == {("2026-01-01", "x"): 1, ("2026-09-01", "x"): 3}


def test_an_empty_selection_selects_everything(spark, sample, as_of):
    from daymatrix.plans.full import full_visits
    from daymatrix.plans.incremental import Selections

    visits, _, lookup = sample
    none = facility_lookup(lookup).select(F.col("rs").alias("source"), F.col("rs").alias("alias")).limit(0)
    every = full_visits(visits, facility_lookup(lookup), as_of)
    assert values(full_visits(visits, facility_lookup(lookup), as_of, Selections(regions=none))) == values(every)


def test_the_last_stored_row_of_a_lookup_or_selection_wins(spark, tmp_path):
    from daymatrix.operators.selection import region_selection
    from daymatrix.sources.readers import read_csv

    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.csv").write_text("Codi UP,RS\n1,z\n1,a\n2,q\n")
    (tmp_path / "l" / "b.csv").write_text("Codi UP,RS\n2,b\n" + "".join(f"{i},r\n" for i in range(3, 500)))
    found = {r["up"]: r["rs"] for r in facility_lookup(read_csv(spark, f"{tmp_path}/l")).collect()}
    assert found["00001"] == "A" and found["00002"] == "B"
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.csv").write_text("geo_id,RS\nX,GIRONA\n")
    (tmp_path / "r" / "b.csv").write_text("geo_id,RS\nY,GIRONA\n" + "".join(f"N{i},R{i}\n" for i in range(500)))
    found = {r["source"]: r["alias"] for r in region_selection(read_csv(spark, f"{tmp_path}/r")).collect()}
    assert found["GIRONA"] == "Y"


def test_ranges_reach_the_scan(spark, tmp_path):
    from daymatrix.sources.readers import rows_between

    spark.createDataFrame([(date(2024, 1, 1), 1)], "day date, n int").write.parquet(f"{tmp_path}/t")
    rows = rows_between(spark.read.parquet(f"{tmp_path}/t"), "day", date(2024, 1, 1), date(2024, 2, 1))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day" in plan and "LessThan(day" in plan
