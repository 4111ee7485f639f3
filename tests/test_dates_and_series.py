"""Dates in several formats, long series filled in blocks, days multiplied by feature."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from daymatrix.functions import cleaning as C
from daymatrix.operators import fill, prepare
from daymatrix.operators.dedup import stored_order
from daymatrix.plans.full import export_wide, full_visits
from daymatrix.plans.incremental import Run, run_visits
from daymatrix.sources.store import MatrixStore, StagingArea


def test_formats_are_tried_in_order(spark):
    formats = ["dd/MM/yyyy", "MM/dd/yyyy", "yyyyMMdd", "dd.MM.yyyy HH:mm:ss"]
    cells = {
        "2024-02-03": "2024-02-03", "2024-02-03 10:11:12": "2024-02-03", "03/02/2024": "2024-02-03", " 3/2/2024 ": "2024-02-03",
        "02/13/2024": "2024-02-13", "20240203": "2024-02-03", "03.02.2024 23:59:59": "2024-02-03", "03.02.2024 25:00:00": None,
        "30/02/2024": None, "3-2-2024": None, "": None, None: None, "x03/02/2024": None,
    }
    df = spark.createDataFrame([(k,) for k in cells], "seen string")
    found = df.select("seen", F.date_format(prepare.day_of(df, "seen", formats), "yyyy-MM-dd").alias("day")).collect()
    assert {r["seen"]: r["day"] for r in found} == cells
    reasons = {r["seen"]: r["reason"] for r in prepare.rejected_dates(df, "seen", formats).collect()}
    assert reasons == {k: "missing" if k is None else "blank" if not k else "unreadable" for k, v in cells.items() if v is None}
    for wrong in ("dd/MM", "dd/MM/yyyy dd"):
        with pytest.raises(ValueError):
            C.to_day("seen", None, [wrong])


def test_a_run_keeps_what_it_rejects(spark, sample, as_of, now, tmp_path):
    visits, _, raw = sample
    lookup = prepare.facility_lookup(raw)
    respelled = visits.withColumn(
        "DATA_VISITA", F.when(F.col("SERVEI_CODI") == "INF", F.regexp_replace("DATA_VISITA", r"(\\d+)-(\\d+)-(\\d+).*", "$3/$2/$1")).otherwise(F.col("DATA_VISITA"))
    )
    store = MatrixStore(spark, f"{tmp_path}/m")
    run = Run(store, StagingArea(spark, f"{tmp_path}/s"), as_of, now, end=date(2026, 1, 4), date_formats=("dd/MM/yyyy",), rejected=f"{tmp_path}/rejected")
    run_visits(respelled, lookup, run)
    plain = full_visits(visits, lookup, as_of)
    key = lambda m: {(r["day"], r["feature"]): r["value"] for r in m.values.collect()}
    wanted, found = key(plain), key(store.load())
    assert {k: v for k, v in found.items() if k in wanted} == wanted
    rejected = spark.read.parquet(f"{tmp_path}/rejected").collect()
    assert [(r["DATA_VISITA"], r["reason"], r["UP"]) for r in rejected] == [("not a day", "unreadable", "348")]


def plain_fill(cells, method):
    """One list filled as a whole."""
    known = [i for i, c in enumerate(cells) if c is not None]
    out = []
    for i, c in enumerate(cells):
        left = max((k for k in known if k <= i), default=None)
        right = min((k for k in known if k >= i), default=None)
        if method == "ffill":
            out.append(None if left is None else cells[left])
        elif method == "bfill":
            out.append(None if right is None else cells[right])
        elif left is None or right is None or left == right:
            out.append(None if left is None else float(cells[left]))
        else:
            out.append(cells[left] + (cells[right] - cells[left]) * (i - left) / (right - left))
    return out


@pytest.mark.parametrize("method", ["ffill", "bfill", "interpolate"])
def test_one_long_series_is_filled_block_by_block(spark, method):
    start, cells = date(2000, 1, 1), [None if i % 97 or i in (970, 1940) else float(i) for i in range(3000)]
    cells[:200] = [None] * 200
    cells[2600:] = [None] * 400
    other = [None if i % 5 else 1.0 * i for i in range(40)]
    rows = [("a", start + timedelta(days=2 * i), c) for i, c in enumerate(cells)]
    rows += [(None, start + timedelta(days=i), c) for i, c in enumerate(other)] + [("b", start, None)]
    df = spark.createDataFrame(rows, "key string, day date, value double").repartition(5)
    filled = fill.fill_nulls(df, ["key"], "day", ["value"], method, block=50)
    assert filled.columns == df.columns
    found = filled.orderBy("day").collect()
    for key, wanted in (("a", cells), (None, other), ("b", [None])):
        values = [r["value"] for r in found if r["key"] == key]
        expected = plain_fill(wanted, method)
        assert len(values) == len(expected)
        assert all(a == b if a is None or b is None else a == pytest.approx(b) for a, b in zip(values, expected))


def test_no_task_holds_one_key(spark):
    """The windows over rows are dealt by key and block."""
    df = spark.range(20_000).select(F.lit("a").alias("key"), F.col("id").alias("at"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    filled = fill.fill_nulls(df, ["key"], "at", ["v"], "ffill", block=100)
    sizes = [r["count"] for r in filled.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 12_000


def test_a_multiplied_day_is_dealt_by_feature(spark):
    last = date(2024, 1, 1)
    values = spark.createDataFrame([(last, f"f{i}", float(i)) for i in range(2000)], "day date, feature string, value double").coalesce(1)
    days = [last + timedelta(days=k) for k in range(30)]
    weights = spark.createDataFrame([(last, d, 1.0) for d in days], "source date, day date, weight double")
    made = fill.apply_weights(values, weights, "ffill")
    assert made.count() == 2000 * 30
    multiplied = made.where(F.col("day") > last)
    sizes = [r["count"] for r in multiplied.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 0.3 * 2000 * 29


def test_derived_rows_have_no_order(spark, tmp_path):
    local = spark.createDataFrame([("1", "a"), ("1", "b")], "`Codi UP` string, RS string")
    assert prepare.facility_lookup(local.where("RS <> 'x'")).first()["rs"] == "B"
    joined = local.join(local.select("RS"), "RS")
    with pytest.raises(ValueError, match="order"):
        stored_order(joined)
    with pytest.raises(ValueError, match="order"):
        prepare.facility_lookup(joined)
    assert prepare.facility_lookup(joined, order="RS").first()["rs"] == "B"


def test_the_limit_of_an_export_can_be_raised(spark, series, tmp_path):
    from daymatrix.model import DailyMatrix

    matrix = DailyMatrix.observed(series({"2024-01-01": 1}).union(series({"2024-01-01": 2}, "y")))
    with pytest.raises(ValueError, match="more than 1 "):
        export_wide(matrix, f"{tmp_path}/w", max_features=1)
    export_wide(matrix, f"{tmp_path}/w", max_features=2)
    assert spark.read.parquet(f"{tmp_path}/w").first()["y"] == 2


def test_column_report(spark):
    report = prepare.missing_columns(spark.createDataFrame([], "a int, B int"), ["A", "b", "c"], "t").collect()
    assert [(r["column_name"], r["stored_as"], r["present"]) for r in report] == [("A", "a", True), ("b", "B", True), ("c", None, False)]
