from datetime import date

import pytest
from pyspark.sql import functions as F

from daymatrix.functions import cleaning as C
from daymatrix.functions.naming import RS, UP
from daymatrix.operators import features, prepare, selection
from daymatrix.operators.features import GLOBAL


def as_dict(values):
    return {(r["day"].isoformat(), r["feature"]): r["value"] for r in values.collect()}


def test_prepared_visits(spark, sample):
    visits, _, raw_lookup = sample
    rows = prepare.prepare_visits(visits, prepare.facility_lookup(raw_lookup)).collect()
    assert len(rows) == 7  # the unreadable day is gone
    by_place = {r["up"]: r for r in rows if r["day"].year == 2026}
    assert by_place["00348"]["rs"] == "GIRONA"
    assert by_place["00443"]["TIPUS_VISITA_AGRUPAT"] == "PRESENCIAL"
    assert by_place["00065"]["day"] == date(2026, 1, 2)
    assert by_place["04903"]["VISI_SITUACIO_VISITA"] == "NA"
    assert by_place["04903"]["TIPUS_CLASS"] == "NA"
    assert by_place["UNKNOWN"]["rs"] == C.UNSPECIFIED_REGION


def test_visits_without_class_column(spark, sample):
    row = prepare.clean_visits(sample[0].drop("TIPUS_CLASS")).first()
    assert (row["TIPUS_CLASS"], row["TIPUS_VISITA_AGRUPAT"]) == ("NA", "NA")


def test_visit_feature_names_and_counts(spark, sample):
    visits, _, raw_lookup = sample
    lookup = prepare.facility_lookup(raw_lookup)
    out = as_dict(features.visit_features(prepare.clean_visits(visits), lookup))
    assert out["2026-01-01", "DEMAND__TOTAL"] == 2
    assert out["2026-01-01", "DEMAND__SERVEI_CODI__INF"] == 1
    assert out["2026-01-01", "DEMAND__SERVEI_CODI__INF__RS__BARCELONA CIUTAT"] == 1
    assert out["2026-01-01", "DEMAND__TOTAL__RS__GIRONA"] == 1
    assert out["2026-01-01", "DEMAND__TOTAL__UP__00348"] == 1
    assert out["2026-01-02", "DEMAND__TIPUS_CLASS__NA__UP__04903"] == 1
    assert out["2026-01-04", "DEMAND__SERVEI_CODI__U_RG"] == 1
    assert out["2026-01-04", "DEMAND__TOTAL__UP__UNKNOWN"] == 1


def test_every_level_adds_up_to_the_total(spark, sample):
    visits, _, raw_lookup = sample
    lookup = prepare.facility_lookup(raw_lookup)
    out = as_dict(features.visit_features(prepare.clean_visits(visits), lookup))
    for day in {d for d, _ in out}:
        total = out[day, "DEMAND__TOTAL"]
        for start in ("DEMAND__TOTAL__RS__", "DEMAND__TOTAL__UP__"):
            assert sum(v for (d, f), v in out.items() if d == day and f.startswith(start)) == total
        for variable in ("SERVEI_CODI", "TIPUS_CLASS", "VISI_SITUACIO_VISITA"):
            parts = [
                v
                for (d, f), v in out.items()
                if d == day and f.startswith(f"DEMAND__{variable}__") and f.count("__") == 2
            ]
            assert sum(parts) == total


def test_levels_can_be_chosen(spark, sample):
    cleaned = prepare.clean_visits(sample[0])
    names = {f for _, f in as_dict(features.visit_features(cleaned, levels=(GLOBAL,), with_total=False))}
    assert names and all(f.count("__") == 2 for f in names)
    with pytest.raises(ValueError):
        features.visit_features(cleaned, levels=(RS,))


def test_selection_restricts_its_own_level_only(spark, sample):
    visits, _, raw_lookup = sample
    chosen = selection.region_selection(
        spark.createDataFrame([("RS 64", "girona")], "geo_id string, RS string")
    )
    places = selection.facility_selection(
        spark.createDataFrame(
            [("micro_1", "348", "a"), ("micro_2", "443", "b"), ("micro_9", "348", "last wins")],
            "geo_id string, UP string, name string",
        ).coalesce(1)
    )
    out = as_dict(
        features.visit_features(
            prepare.clean_visits(visits), prepare.facility_lookup(raw_lookup), chosen, places
        )
    )
    ends = {f.split("__TOTAL__")[1] for _, f in out if "__TOTAL__" in f}
    assert ends == {"RS__RS_64", "UP__MICRO_9", "UP__MICRO_2"}
    assert out["2026-01-01", "DEMAND__TOTAL"] == 2


def test_selection_columns(spark):
    def pairs(df, build=selection.facility_selection):
        return {r["source"]: r["alias"] for r in build(df).collect()}

    assert pairs(spark.createDataFrame([("a", "7")], "first string, second string")) == {"00007": "A"}
    assert pairs(spark.createDataFrame([("7",)], "value string")) == {"00007": "7"}
    rows = spark.createDataFrame([("x", None), ("y", "12"), (None, "13")], "id string, UP string")
    assert pairs(rows) == {"00012": "Y", "00013": "00013"}
    empty = selection.region_selection(spark.createDataFrame([("a", None)], "geo_id string, RS string"))
    assert selection.non_empty(empty) is None
    assert selection.non_empty(None) is None


def test_rows_of_a_selection_get_its_alias(spark):
    rows = spark.createDataFrame([("Girona", 1), ("LLEIDA", 2), (None, 3)], "RS string, n int")
    chosen = selection.region_selection(
        spark.createDataFrame([("RS_64", "GIRONA")], "geo_id string, RS string")
    )
    kept = selection.keep_selected(rows, "RS", chosen, C.region).collect()
    assert [tuple(r) for r in kept] == [("RS_64", 1)]
    assert selection.keep_selected(rows, "RS", None, C.region).count() == 3


@pytest.fixture
def codes(spark):
    return selection.code_selection(
        spark.createDataFrame(
            [("J00-J06", "G01"), ("J00", "D01"), ("J09-J18", "G01"), ("U07.1", None), ("J00-J06", "G01")],
            "ICD10_3 string, feature_name string",
        )
    )


def test_code_selection(spark, codes):
    pairs = {tuple(r) for r in codes.collect()}
    assert ("J00", "G01") in pairs and ("J00", "D01") in pairs and ("U07", "U07") in pairs
    assert codes.count() == len(pairs) == 7 + 1 + 10 + 1
    plain = selection.code_selection(spark.createDataFrame([("A00-A01",)], "code string"))
    assert {tuple(r) for r in plain.collect()} == {("A00", "A00"), ("A01", "A01")}


def test_code_expansion(spark, sample, codes):
    counts = prepare.day_code_counts(sample[1])
    out = selection.expand_code_aliases(counts, codes)
    assert sorted(r["code"] for r in out.collect()) == ["D01", "G01", "G01", "G01", "U07"]
    assert selection.expand_code_aliases(counts, None).count() == 0


@pytest.mark.parametrize("counted", [True, False])
def test_coded_features(spark, sample, codes, counted):
    _, coded, raw_lookup = sample
    lookup = prepare.facility_lookup(raw_lookup)
    if counted:
        rows = prepare.day_code_counts(coded)
    else:
        rows = prepare.clean_coded_rows(coded).withColumn("n", F.lit(1))
    out = as_dict(features.coded_features(rows, lookup, codes))
    assert out["2026-01-01", "DIAGNOSIS__TOTAL"] == 3  # J00 is in two groups and counts once
    assert out["2026-01-01", "DIAGNOSIS__ICD10_3__G01"] == 3
    assert out["2026-01-01", "DIAGNOSIS__ICD10_3__D01"] == 1
    assert out["2026-01-01", "DIAGNOSIS__ICD10_3__G01__RS__GIRONA"] == 1
    assert out["2026-01-01", "DIAGNOSIS__ICD10_3__G01__UP__00348"] == 1
    assert out["2026-01-04", "DIAGNOSIS__TOTAL__RS__UNKNOWN"] == 2
    assert out["2026-01-04", "DIAGNOSIS__TOTAL__UP__999999"] == 1
    assert not any("Z99" in f for _, f in out)
    assert not any(d == "2026-01-05" for d, _ in out)


def test_no_code_selection_gives_totals_only(spark, sample):
    rows = prepare.day_code_counts(sample[1])
    out = as_dict(features.coded_features(rows, levels=(GLOBAL, UP)))
    assert all("TOTAL" in f for _, f in out)
    assert features.coded_features(rows, levels=(GLOBAL,), with_total=False).count() == 0


def test_unknown_facilities(spark, sample):
    _, coded, raw_lookup = sample
    lookup = prepare.facility_lookup(raw_lookup)
    rows = prepare.clean_coded_rows(coded)
    assert {tuple(r) for r in prepare.unknown_facilities(rows, lookup).collect()} == {
        ("999999", 1),
        ("UNKNOWN", 1),
    }
    report = prepare.unknown_facility_report(rows, lookup, first=1).first()
    assert tuple(report) == (9, 2, 2, "999999")


def test_lookup_duplicates(spark):
    """The last row of a facility wins."""
    raw = spark.createDataFrame([("1", "b"), ("00001", "a"), ("2", "c")], "`Codi UP` string, RS string")
    assert {tuple(r) for r in prepare.facility_lookup(raw).collect()} == {("00001", "A"), ("00002", "C")}
    assert [tuple(r) for r in prepare.lookup_duplicates(raw).collect()] == [("00001", 2)]


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([], "a int, B int")
    prepare.require_columns(df, ["A", "b"])
    with pytest.raises(ValueError, match="x.*Available"):
        prepare.require_columns(df, ["a", "x"])


def test_code_selection_expands_each_code_of_an_alias_once(spark):
    """Equal and overlapping ranges are joined before they become many rows."""
    rows = [("A00-C99", "g"), ("A50-B49", "g"), ("A00-A9", "g"), ("B00-D00", "g"), ("B10", "g"), ("F0-E0", "g")]
    rows += [("A00-A01", "h"), ("A01-A02", "h"), ("A05-x", "h"), (None, "h"), ("J10-J11", " "), ("U07.1", None)]
    pairs = selection.code_selection(spark.createDataFrame(rows, "code string, feature_name string"))
    g = {(f"{letter}{n:02d}", "G") for letter in "ABC" for n in range(100)} | {("D00", "G")}
    h = {("A00", "H"), ("A01", "H"), ("A02", "H"), ("A05", "H")}
    other = {("J10", "J10"), ("J11", "J10"), ("U07", "U07")}
    found = [tuple(r) for r in pairs.collect()]
    assert sorted(found) == sorted(g | h | other)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Window [")
