from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from daymatrix.functions import cleaning as C
from daymatrix.functions.codes import expand_code_spec
from daymatrix.functions.naming import (
    DEMAND,
    DIAGNOSIS,
    canonicalize_features,
    feature_name,
    rename_columns,
    with_canonical_name,
)


def values_of(spark, expression, inputs, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_facility_pads_and_never_cuts(spark):
    inputs = ["348", " 348", "00348", "1234567", "", None]
    assert values_of(spark, C.facility("v"), inputs) == [
        "00348",
        "00348",
        "00348",
        "1234567",
        "00000",
        None,
    ]


def test_category_and_class(spark):
    assert values_of(spark, C.category("v"), [" a ", "", "\t", None]) == ["a", "NA", "NA", "NA"]
    classes = ["c9c ", "C9R", "CALTRE", "d9d", "DALTRE", "9T", "x", "", None]
    groups = values_of(spark, C.visit_class_group(C.visit_class("v")), classes)
    assert groups == ["PRESENCIAL"] * 3 + ["DOMICILIARIA"] * 2 + ["TELEFONICA"] + ["NA"] * 3


def test_days_are_read_leniently(spark):
    texts = ["2024-01-01", "2024-01-01 23:59:59", "2024-02-30", "x", "", None]
    assert values_of(spark, C.to_day("v"), texts) == [date(2024, 1, 1)] * 2 + [None] * 4
    moments = [datetime(2024, 5, 6, 7, 8), None]
    days = values_of(
        spark, C.to_day(F.col("v"), spark.createDataFrame([], "v timestamp").schema[0].dataType),
        moments, "timestamp",
    )
    assert days == [date(2024, 5, 6), None]


def test_codes_flags_numbers_aliases(spark):
    assert values_of(spark, C.code3("v"), [" j06.9", "U07.1", "", "  ", None]) == [
        "J06",
        "U07",
        None,
        None,
        None,
    ]
    flags = ["True", " 1 ", "YES", "y", "no", "0", "", None]
    assert values_of(spark, C.flag("v"), flags) == [True] * 4 + [False] * 4
    assert values_of(spark, C.number("v"), ["1.5", "x", None]) == [1.5, None, None]
    names = [" rs-64 / a", "__", None, "Penedès"]
    assert values_of(spark, C.alias("v", F.lit("FALLBACK")), names) == [
        "RS_64_A",
        "FALLBACK",
        "FALLBACK",
        "PENED_S",
    ]


def test_regions(spark):
    raw = [None, "SENSEESPECIFICAR_SE", "GIRONA"]
    out = values_of(spark, C.region_or_default("v", C.UNSPECIFIED_REGION), raw)
    assert out == [C.UNSPECIFIED_REGION, C.UNSPECIFIED_REGION, "GIRONA"]
    assert values_of(spark, C.geo_label("v", "RS"), [" girona", "", None]) == [
        "GIRONA",
        "UNKNOWN",
        "UNKNOWN",
    ]


@pytest.mark.parametrize(
    "spec, expected",
    [
        ("J00-J02", ["J00", "J01", "J02"]),
        ("F40-F4", [f"F4{i}" for i in range(10)]),
        ("S00-T88", [f"S{i:02}" for i in range(100)] + [f"T{i:02}" for i in range(89)]),
        ("U07.1", ["U07"]),
        ("A00-A09", [f"A0{i}" for i in range(10)]),
        ("A00 - 09", [f"A0{i}" for i in range(10)]),
        ("j00–J01", ["J00", "J01"]),
        ("B05-A01", []),
        ("F4-F45", []),
        ("X-Y", ["X-Y"]),
        ("", []),
        (None, []),
    ],
)
def test_code_ranges(spark, spec, expected):
    assert values_of(spark, expand_code_spec("v"), [spec]) == [expected]


def test_feature_names(spark):
    rows = spark.createDataFrame(
        [("a__b", "RS", " x "), (None, "UP", ""), ("c", None, None)],
        "category string, level string, geo string",
    )
    name = feature_name(DEMAND, "V", F.col("category"), F.col("level"), F.col("geo"))
    assert [r[0] for r in rows.select(name).collect()] == [
        "DEMAND__V__a_b__RS__x",
        "DEMAND__V__UP__UNKNOWN",
        "DEMAND__V__c",
    ]


CANONICAL = {
    DEMAND: {
        "DEMANDA_TOTAL": "DEMAND__TOTAL",
        "demanda__TOTAL_CAT": "DEMAND__TOTAL",
        "demanda__TOTAL_RS_girona": "DEMAND__TOTAL__RS__GIRONA",
        "demanda__TOTAL_UP_348": "DEMAND__TOTAL__UP__00348",
        "demanda__SERVEI_CODI__INF": "DEMAND__SERVEI_CODI__INF",
        "demanda_SERVEI_CODI_A_UP_B_UP_348": "DEMAND__SERVEI_CODI__A_UP_B__UP__00348",
        "demanda_SERVEI_CODI_A_B_RS_64": "DEMAND__SERVEI_CODI__A_B__RS__RS_64",
        "demanda_SERVEI_CODI_A_B_girona": "DEMAND__SERVEI_CODI__A_B__RS__GIRONA",
        "demanda_SERVEI_CODI_x": "demanda_SERVEI_CODI_x",
        "DEMAND__TOTAL": "DEMAND__TOTAL",
        "timestamp": "timestamp",
        "other": "other",
    },
    DIAGNOSIS: {
        "DIAG_TOTAL": "DIAGNOSIS__TOTAL",
        "TOTAL": "DIAGNOSIS__TOTAL",
        "TOTAL__RS__girona": "DIAGNOSIS__TOTAL__RS__GIRONA",
        "DIAG_TOTAL__UP__348": "DIAGNOSIS__TOTAL__UP__00348",
        "DIAG_TOTAL_UP_348": "DIAGNOSIS__TOTAL__UP__00348",
        "DIAG_CODE_A09": "DIAGNOSIS__ICD10_3__A09",
        "ICD10_3_A09": "DIAGNOSIS__ICD10_3__A09",
        "ICD10_3__A09__RS__girona": "DIAGNOSIS__ICD10_3__A09__RS__GIRONA",
        "ICD10_3__A09__UP__348": "DIAGNOSIS__ICD10_3__A09__UP__00348",
    },
}


@pytest.mark.parametrize("domain", [DEMAND, DIAGNOSIS])
def test_older_names(spark, domain):
    names = spark.createDataFrame([(n,) for n in CANONICAL[domain]], "name string")
    assert dict(with_canonical_name(names, domain).collect()) == CANONICAL[domain]


def test_older_names_of_values_are_summed(spark, series):
    values = series({"2024-01-01": 1}, "TOTAL").union(series({"2024-01-01": 2}, "DIAG_TOTAL"))
    assert [tuple(r) for r in canonicalize_features(values, DIAGNOSIS).collect()] == [
        (date(2024, 1, 1), "DIAGNOSIS__TOTAL", 3.0)
    ]


def test_join_names_keep_one_prefix(spark):
    df = spark.createDataFrame([], "timestamp date, DEMAND__TOTAL int, other int, __is_imputed boolean")
    assert rename_columns(df, DEMAND).columns == [
        "timestamp",
        "DEMAND__TOTAL",
        "DEMAND_other",
        "DEMAND___is_imputed",
    ]


def test_codes_are_counted_without_a_row_each(spark, tmp_path):
    rows = [(4, "B1", 1), (2, "B1", 3), (2, "B1", 3), (7, "B2", 25), (5, "B1", 1), (None, "B3", 2)]
    spark.createDataFrame(rows, "p_partkey bigint, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    counted = QUERIES["code_range_expansion"](spark, str(tmp_path))
    assert "Generate" not in counted._jdf.queryExecution().optimizedPlan().toString()
    expected = {(2, 2 * 1238, "C02", "O39"), (7, 1619, "H07", "X25"), (5, 1, "F05", "F05")}
    assert {tuple(r) for r in counted.collect()} == expected
