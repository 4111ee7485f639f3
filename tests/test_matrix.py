from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from frames import wide_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daymatrix.model import CONTROL_COLUMNS, IS_IMPUTED, DailyMatrix
from daymatrix.operators import calendar, dedup, fill, matrix, quality
from daymatrix.operators.impute import drop_imputed, drop_imputed_rows, impute
from daymatrix.operators.join import join_incremental, join_matrices, merge_on_keys


def values(m):
    return {(r["day"].isoformat(), r["feature"]): r["value"] for r in m.values.collect()}


def imputed(m):
    return {r["day"].isoformat() for r in m.days.collect() if r[IS_IMPUTED]}


def test_same_month_day_mean(series, now):
    real = series({"2022-01-02": 8, "2023-01-02": 12, "2024-01-01": 30})
    m = impute(DailyMatrix.observed(real), date(2026, 6, 2), now, date(2024, 1, 1), date(2024, 1, 2))
    assert values(m)["2024-01-02", "x"] == 10
    rows = wide_rows(m.days)
    assert rows["2024-01-02"] == dict(
        zip(CONTROL_COLUMNS, [True, "same_month_day_mean", "2024-01-01", now.isoformat()])
    )
    for day in ("2022-01-02", "2023-01-02", "2024-01-01"):
        assert list(rows[day].values()) == [False, "", "", ""]


def test_interior_gap_gets_the_overall_mean(series, as_of, now):
    m = impute(DailyMatrix.observed(series({"2024-01-01": 10, "2024-01-03": 20})), as_of, now,
               target_until=date(2024, 1, 3))
    assert values(m)["2024-01-02", "x"] == 15
    assert imputed(m) == {"2024-01-02"}


def test_leap_day_and_absent_features(spark, series, as_of, now):
    real = series({"2020-02-29": 4, "2021-02-28": 2, "2024-02-28": 9}).union(
        series({"2021-02-28": 6}, "y")
    )
    m = impute(DailyMatrix.observed(real), as_of, now, target_until=date(2024, 2, 29))
    out = values(m)
    assert out["2024-02-29", "x"] == 4  # the earlier leap year only
    assert ("2024-02-29", "y") not in out  # y is zero on that day
    assert out["2023-02-28", "y"] == 6
    assert out["2021-03-01", "y"] == 2  # overall mean divides by days, not by rows


def test_target_is_capped_and_later_days_are_cut(series, now):
    real = series({"2024-01-01": 1, "2024-01-02": 2, "2024-01-05": 5})
    m = impute(DailyMatrix.observed(real), date(2024, 1, 4), now, date(2024, 1, 2), date(2030, 1, 1))
    assert {d for d, _ in values(m)} == {"2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"}
    assert imputed(m) == {"2024-01-03", "2024-01-04"}


def test_estimates_are_dropped_and_made_anew(series, as_of, now):
    once = impute(DailyMatrix.observed(series({"2024-01-01": 30})), as_of, now,
                  target_until=date(2024, 1, 3))
    twice = impute(once, as_of, now, target_until=date(2024, 1, 3))
    assert values(once) == values(twice)
    assert set(values(drop_imputed(once))) == {("2024-01-01", "x")}
    wide = matrix.matrix_to_wide(once)
    assert drop_imputed_rows(wide).columns == ["day", "x"]
    assert drop_imputed_rows(wide).count() == 1


def test_nothing_to_impute(spark, series, as_of, now):
    assert impute(DailyMatrix.empty(spark), as_of, now).days.count() == 0
    m = impute(DailyMatrix.observed(series({"2024-01-01": 1})), as_of, now, target_until=date(2024, 1, 1))
    assert imputed(m) == set()


def test_imputation_matches_a_dense_computation(spark, now):
    random = np.random.default_rng(7)
    days = pd.date_range("2019-01-01", "2022-12-31")
    kept = days[random.random(len(days)) > 0.2]
    wide = pd.DataFrame(random.integers(0, 4, (len(kept), 3)), index=kept, columns=list("abc"), dtype=float)
    wide["a"] += 1
    long = wide.stack().reset_index()
    long.columns = ["day", "feature", "value"]
    long["day"] = long["day"].dt.date
    sparse = spark.createDataFrame(long[long["value"] != 0], "day date, feature string, value double")
    m = impute(DailyMatrix.observed(sparse), date(2023, 2, 28), now)
    got = matrix.matrix_to_wide(m, list("abc")).toPandas().set_index("day").sort_index()

    expected = wide.reindex(pd.date_range(kept[0], "2023-02-28"))
    for day in expected.index[expected["a"].isna()]:
        same = wide[(wide.index.month == day.month) & (wide.index.day == day.day) & (wide.index < day)]
        expected.loc[day] = same.mean() if len(same) else wide.mean()
    assert list(pd.to_datetime(got.index)) == list(expected.index)
    np.testing.assert_allclose(got[list("abc")].to_numpy(), expected.to_numpy())


def test_wide_and_back(spark, series):
    long = series({"2024-01-01": 1, "2024-01-02": 2}).union(series({"2024-01-02": 3}, "y"))
    wide = matrix.to_wide(long)
    assert wide_rows(wide) == {"2024-01-01": {"x": 1.0, "y": 0.0}, "2024-01-02": {"x": 2.0, "y": 3.0}}
    assert sorted(map(tuple, matrix.to_long(wide).collect())) == sorted(map(tuple, long.collect()))
    assert matrix.to_long(wide, keep_zeros=True).count() == 4
    with pytest.raises(ValueError, match="Refusing"):
        matrix.feature_list(long, max_features=1)


def test_from_wide(spark):
    wide = spark.createDataFrame(
        [
            ("2024-01-01", "1", 2, "no"),
            ("2024-01-02", "x", 5, "True"),
            ("2024-01-02", "3", 1, "false"),
            ("2024-01-03", "4", 4, " yes"),
        ],
        "day string, demanda__TOTAL_CAT string, DEMANDA_TOTAL int, __is_imputed string",
    )
    m = matrix.from_wide(wide, "DEMAND")
    assert values(m) == {
        ("2024-01-01", "DEMAND__TOTAL"): 3,
        ("2024-01-02", "DEMAND__TOTAL"): 4,
        ("2024-01-03", "DEMAND__TOTAL"): 8,
    }
    assert imputed(m) == {"2024-01-03"}


def test_combine_pieces(spark):
    a = spark.createDataFrame([(date(2024, 1, 1), 1, None)], "day date, x int, y int")
    b = spark.createDataFrame([(date(2024, 1, 1), 2), (date(2024, 1, 2), 3)], "day date, z int")
    assert wide_rows(matrix.combine_wide([a, b, a])) == {
        "2024-01-01": {"x": 2, "y": 0, "z": 2},
        "2024-01-02": {"x": 0, "y": 0, "z": 3},
    }


def test_mixed_rows(spark):
    mixed = spark.createDataFrame(
        [
            ("2024-01-01", 5, None, None, None, None, None),
            ("2024-01-01", 2, None, None, None, None, None),
            ("2024-01-01", None, "A09", 3, None, None, None),
            ("2024-01-01", None, "A09", None, "girona", None, "4"),
            ("2024-01-01", None, "A09", None, None, "348", "x"),
            ("2024-01-01", None, None, 9, None, None, None),
        ],
        "timestamp string, DIAG_TOTAL int, DIAG_DIAG_CODE string, DIAG_COUNT int, "
        "DIAG_RS string, DIAG_up_c string, count string",
    )
    out = {r["feature"]: r["value"] for r in matrix.mixed_to_long(mixed).collect()}
    assert out == {
        "DIAGNOSIS__TOTAL": 7,
        "DIAGNOSIS__ICD10_3__A09": 3,
        "DIAGNOSIS__ICD10_3__A09__RS__GIRONA": 4,
        "DIAGNOSIS__ICD10_3__A09__UP__00348": 0,
    }
    with_codes = mixed.selectExpr("*", "1 AS DIAG_CODE_B01")
    names = {r["feature"] for r in matrix.mixed_to_long(with_codes).collect()}
    assert "DIAGNOSIS__ICD10_3__A09" not in names and "DIAGNOSIS__ICD10_3__B01" in names
    with pytest.raises(ValueError):
        matrix.mixed_to_long(mixed.select("timestamp"))


def test_daily_grid(spark):
    df = spark.createDataFrame(
        [("2024-01-01", 1), ("2024-01-03", None), ("2024-01-09", 4), (None, 5)], "day string, x int"
    )
    assert {k: v["x"] for k, v in wide_rows(calendar.daily_grid(df, end=date(2024, 1, 4), fill=7)).items()} == {
        "2024-01-01": 1,
        "2024-01-02": 7,
        "2024-01-03": 7,
        "2024-01-04": 7,
    }
    assert calendar.daily_grid(df).count() == 9
    assert calendar.daily_grid(df.limit(0)).count() == 0


def test_last_days(spark):
    days = [("2025-12-30", None), ("2025-12-31", "no"), ("2026-05-27", "0"), ("2026-05-28", "TRUE")]
    df = spark.createDataFrame(days, f"day string, {IS_IMPUTED} string")
    assert calendar.last_observed_day(df).first()[0] == date(2026, 5, 27)
    assert calendar.last_contiguous_day(df).first()[0] == date(2025, 12, 31)
    assert calendar.last_contiguous_day(df.limit(0)).first()[0] is None


def dense_join(a, b, method):
    """The same join on wide pandas frames."""
    merged = a.join(b, how="outer").sort_index()
    if method == "ffill":
        merged = merged.ffill()
    elif method == "bfill":
        merged = merged.bfill()
    elif method == "interpolate":
        merged = merged.interpolate(method="linear")
    return merged.fillna(0)


@pytest.mark.parametrize("method", ["ffill", "bfill", "interpolate", None])
def test_joins_match_dense_fills(spark, method):
    random = np.random.default_rng(3)
    days = pd.date_range("2024-01-01", periods=40)

    def side(prefix, share):
        kept = days[random.random(len(days)) > share]
        return pd.DataFrame(
            random.integers(1, 9, (len(kept), 2)), index=kept, columns=[f"{prefix}__a", f"{prefix}__b"], dtype=float
        )

    def as_matrix(wide):
        long = wide.stack().reset_index()
        long.columns = ["day", "feature", "value"]
        long["day"] = long["day"].dt.date
        return DailyMatrix.observed(spark.createDataFrame(long, "day date, feature string, value double"))

    a, b = side("DEMAND", 0.5), side("DIAGNOSIS", 0.6)
    joined = join_matrices(as_matrix(a), as_matrix(b), date(2026, 1, 1), method)
    got = matrix.matrix_to_wide(joined).toPandas().set_index("day").sort_index()
    expected = dense_join(a, b, method)
    assert list(pd.to_datetime(got.index)) == list(expected.index)
    np.testing.assert_allclose(got[expected.columns].to_numpy(dtype=float), expected.to_numpy())


def test_join_control_columns_follow_the_fill(spark, series, as_of, now):
    a = impute(DailyMatrix.observed(series({"2024-01-01": 1}, "DEMAND__TOTAL")), as_of, now,
               target_until=date(2024, 1, 2))
    b = DailyMatrix.observed(series({"2024-01-02": 2, "2024-01-03": 3}, "DIAGNOSIS__TOTAL"))
    rows = wide_rows(join_matrices(a, b, as_of, "ffill").days)
    assert [rows[f"2024-01-0{i}"]["DEMAND___is_imputed"] for i in (1, 2, 3)] == [False, True, True]
    assert [rows[f"2024-01-0{i}"]["DIAGNOSIS___is_imputed"] for i in (1, 2, 3)] == [None, False, False]
    assert join_matrices(a, b, date(2024, 1, 2), "ffill").days.count() == 2
    with pytest.raises(ValueError):
        join_matrices(a, DailyMatrix.empty(spark), as_of)
    with pytest.raises(ValueError):
        join_matrices(a, b, as_of, "nearest")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=12))
def test_series_fills(spark, cells):
    start = date(2024, 1, 1)
    rows = [("k", start + timedelta(days=3 * i), None if c is None else float(c)) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, "k string, day date, v double")
    plain = pd.Series([r[2] for r in rows], dtype=float)
    for method, expected in {
        "ffill": plain.ffill(),
        "bfill": plain.bfill(),
        "interpolate": plain.interpolate(method="linear"),
        None: plain,
    }.items():
        out = fill.fill_nulls(df, ["k"], "day", ["v"], method).orderBy("day").collect()
        np.testing.assert_allclose([np.nan if r["v"] is None else r["v"] for r in out], expected)


def test_keep_last(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), (None, 1, "z"), (None, 0, "w")], "k string, at int, v string"
    )
    assert {tuple(r) for r in dedup.keep_last(df, ["k"], ["at"]).collect()} == {("a", "y"), (None, "z")}


def test_incremental_join(spark):
    a = spark.createDataFrame([("d1", 1, 1), ("d1", 2, 5)], "timestamp string, at int, DEMANDA_TOTAL int")
    b = spark.createDataFrame([("d2", 1, 7)], "timestamp string, at int, DIAG_TOTAL int")
    assert wide_rows(join_incremental(a, b, ["at"]), "timestamp") == {
        "d1": {"DEMAND__TOTAL": 5, "DIAGNOSIS__TOTAL": None},
        "d2": {"DEMAND__TOTAL": None, "DIAGNOSIS__TOTAL": 7},
    }


def test_merge_on_keys(spark):
    kind = "timestamp string, place string, x int"
    a = spark.createDataFrame([("2024-01-01", None, 1), ("2024-01-02", "p", 2)], kind).coalesce(1)
    a2 = spark.createDataFrame([("2024-01-02", "p", 3), ("2030-01-01", "p", 4)], kind).coalesce(1)
    b = spark.createDataFrame([("2024-01-01", None, 9)], kind)
    merged = merge_on_keys([a, a2], [b], date(2025, 1, 1), ["timestamp", "place"])
    assert sorted(map(tuple, merged.collect())) == [
        ("2024-01-01", None, 1, 9),
        ("2024-01-02", "p", 3, None),
    ]
    with pytest.raises(ValueError):
        merge_on_keys([], [b], date(2025, 1, 1))


def test_quality_of_estimates(spark, series, as_of, now):
    m = impute(DailyMatrix.observed(series({"2022-01-02": 8, "2024-01-01": 30})), as_of, now,
               target_until=date(2024, 1, 2))
    report = quality.check_imputation(m.days, as_of)
    assert quality.passes(report)
    row = report.first()
    assert (row["dataset"], row["observed_rows"], row["last_observed"]) == ("base", 2, "2024-01-01")
    assert not quality.passes(quality.check_imputation(m.days, date(2024, 1, 1)))
    assert not quality.passes(quality.check_imputation(m.days.union(m.days), as_of))
    assert not quality.passes(quality.check_imputation(m.days.drop("__imputation_method"), as_of))
    assert not quality.passes(quality.check_imputation(m.days.select("day"), as_of))
    blank = m.days.replace("same_month_day_mean", " ", ["__imputation_method"])
    assert quality.check_imputation(blank, as_of).first()["empty_method"] > 0


def test_imputation_reports(spark, series, as_of, now):
    m = impute(DailyMatrix.observed(series({"2024-01-01": 10, "2024-01-03": 20})), as_of, now,
               target_until=date(2024, 1, 3))
    row = quality.imputation_summary(m.days).first()
    assert (row["num_imputed_rows"], row["num_observed_rows"]) == (1, 2)
    assert row["imputed_dates"] == ["2024-01-02"]
    listed = quality.imputed_rows(m.days).collect()
    assert [r["timestamp"] for r in listed] == ["2024-01-02"]


def test_freshness_and_types(spark):
    df = spark.createDataFrame(
        [("2024-01-01", 1, 300, 1.5), ("x", 2, 70000, None)],
        "LastUpdate string, load_id int, n bigint, v double",
    )
    audit = {r["column_name"]: r for r in quality.freshness_audit(df, "t").collect()}
    assert audit["LastUpdate"]["max_upload_candidate"] == "2024-01-01 00:00:00"
    assert audit["load_id"]["status"] != "ok"
    assert dict(quality.narrow_types(df).dtypes) == {
        "LastUpdate": "string",
        "load_id": "tinyint",
        "n": "int",
        "v": "float",
    }
    assert quality.duplicate_rows(spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int"), "k").first()[0] == 2
