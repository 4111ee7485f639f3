"""What one task holds, and what is read, do not depend on how the engine packs its tasks."""

from datetime import date

from daymatrix.operators import matrix
from daymatrix.operators.identity import with_row_identity
from daymatrix.session import tasks_for
from daymatrix.sources.store import StagingArea


def test_tasks_follow_the_rows(spark):
    least = spark.sparkContext.defaultParallelism
    assert tasks_for(spark.range(0), 10) == least
    assert tasks_for(spark.range(1_000 * least), 10) == 100 * least


def test_mixed_rows_are_dealt_to_given_tasks(spark):
    rows = [("2024-01-01", c, float(n)) for c in ("A00", "A01", None) for n in (1, 2)] + [("2024-01-02", "A00", None)]
    mixed = spark.createDataFrame(rows, "timestamp string, DIAG_DIAG_CODE string, DIAG_COUNT double")
    once, dealt = matrix.mixed_to_long(mixed), matrix.mixed_to_long(mixed, tasks=7)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, once.collect()))
    assert len(once.collect()) == 3
    assert dealt.rdd.getNumPartitions() == 7


def test_staged_rows_lie_in_the_order_of_their_identities(spark, tmp_path):
    days = [date(2024, 1, 1 + i % 3) for i in range(300)]
    rows = spark.createDataFrame([(d, f"{(i * 37) % 300:03d}", i) for i, d in enumerate(days)], "timestamp date, DIAG_CODE string, n int")
    staging = StagingArea(spark, f"{tmp_path}/staging")
    staging.append(with_row_identity(rows), "1", date(2024, 1, 31), "timestamp")
    stored = {}
    for r in staging.load().selectExpr("_metadata.file_name f", "_metadata.row_index r", "data_id").collect():
        stored.setdefault(r.f, []).append((r.r, r.data_id))
    assert sum(map(len, stored.values())) == 300
    assert all([x for _, x in sorted(v)] == sorted(x for _, x in v) for v in stored.values())


def test_given_columns_of_staged_rows(spark, tmp_path):
    rows = spark.createDataFrame([(date(2024, 1, 1), "A", 1), (None, "A", 5)], "timestamp date, DIAG_CODE string, n int")
    staging = StagingArea(spark, f"{tmp_path}/staging")
    named = with_row_identity(rows)
    staging.append(named, "1", date(2024, 1, 31), "timestamp")
    staging.append(named.withColumn("n", named["n"] + 1), "2", date(2024, 1, 31), "timestamp")
    narrow, wide = staging.load_rows(columns=["n"]), staging.load_rows()
    assert narrow.columns == ["data_id", "n"]
    assert sorted(map(tuple, narrow.collect()), key=str) == sorted(map(tuple, wide.select("data_id", "n").collect()), key=str)
