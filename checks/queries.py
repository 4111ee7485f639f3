"""Registered queries: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import (
    AS_OF,
    NOW,
    TARGET,
    chosen_codes,
    chosen_facilities,
    chosen_regions,
    coded,
    lookup,
    raw_coded,
    raw_visits,
    rounded,
    table,
    text_days,
    visits,
)
from daymatrix.functions import cleaning as C
from daymatrix.functions.codes import expand_code_spec
from daymatrix.functions.naming import RS, UP, canonicalize_features
from daymatrix.model import CONTROL_COLUMNS, IS_IMPUTED, DailyMatrix
from daymatrix.operators import calendar, dedup, features, fill, identity, matrix, prepare, quality, selection
from daymatrix.operators.features import GLOBAL
from daymatrix.operators.impute import drop_imputed, drop_imputed_rows, impute
from daymatrix.operators.join import join_incremental, join_matrices, merge_on_keys
from daymatrix.operators.prepare import (
    day_of,
    drop_future_rows,
    facility_lookup,
    lookup_duplicates,
    prepare_visits,
    unknown_facilities,
    unknown_facility_report,
    with_read_days,
    with_region,
)
from daymatrix.plans.full import full_coded, full_visits
from daymatrix.plans.incremental import (
    Run,
    Selections,
    publish,
    refresh_imputation,
    replace_days,
    run_coded,
    run_visits,
)
from daymatrix.plans.maintenance import delete_days, delete_parquet_rows, show_rows, without_days
from daymatrix.plans.windows import processing_window
from daymatrix.session import materialize, new_folder, tasks_for
from daymatrix.sources import readers
from daymatrix.sources.store import CursorStore, MatrixStore, StagingArea, cursor_of, expired_files
from daymatrix.streaming.publish import publish_available

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    """Register a query; its days come out as ISO text."""
    QUERIES[run.__name__] = lambda spark, sf: text_days(run(spark, sf))
    return run


# --- scans and preparation ---------------------------------------------------


@query
def source_range_scan(spark, sf):
    orders = table(spark, sf, "orders")
    rows = readers.scan_range(
        orders,
        "o_orderdate",
        date(1996, 1, 1),
        date(1998, 1, 1),
        ["o_orderkey", "o_orderdate"],
        after=date(1996, 3, 1),
    )
    return rows.select("o_orderkey", day_of(rows, "o_orderdate").alias("day"))


@query
def source_date_bounds(spark, sf):
    lines = table(spark, sf, "lineitem")
    return readers.date_bounds(lines, "l_shipdate", date(2001, 6, 30), date(1995, 3, 1))


@query
def source_day_code_counts(spark, sf):
    return coded(spark, sf)


@query
def prepared_fact(spark, sf):
    return prepare_visits(raw_visits(spark, sf), lookup(spark, sf))


@query
def class_grouping(spark, sf):
    cleaned = visits(spark, sf)
    keys = ["TIPUS_CLASS", "TIPUS_VISITA_AGRUPAT"]
    return cleaned.groupBy(*keys).agg(F.sum("counts").alias("num_rows"))


@query
def lenient_dates(spark, sf):
    """Event times as text, some broken, floored to days."""
    events = table(spark, sf, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    broken = F.when(F.col("event_type") == "error", F.lit("2024-13-45")).otherwise(text)
    rows = events.select(broken.alias("seen"), F.col("props").alias("amount"))
    number = C.number(F.regexp_extract("amount", r"(\d+)", 1))
    days = rows.select(day_of(rows, "seen").alias("day"), number.alias("amount"))
    summary = days.where("day IS NOT NULL").groupBy("day")
    return summary.agg(F.count("*").alias("num_rows"), F.sum("amount").alias("amount"))


@query
def unknown_facility_counts(spark, sf):
    return unknown_facilities(visits(spark, sf), lookup(spark, sf))


@query
def unknown_facility_summary(spark, sf):
    return unknown_facility_report(visits(spark, sf), lookup(spark, sf))


@query
def region_totals(spark, sf):
    joined = with_region(visits(spark, sf), lookup(spark, sf), C.UNKNOWN)
    return joined.groupBy("rs").agg(F.count("*").alias("num_rows"))


@query
def duplicate_lookup_rows(spark, sf):
    """Facilities that several suppliers name."""
    suppliers = table(spark, sf, "supplier")
    raw = suppliers.select(F.col("s_nationkey").cast("string").alias("Codi UP"))
    return lookup_duplicates(raw)


@query
def geo_labels(spark, sf):
    """Cleaned labels of both levels over all customers."""
    customers = table(spark, sf, "customer")
    blank = F.when(F.col("c_acctbal") < 0, F.lit("  "))
    labels = customers.select(
        C.geo_label(F.coalesce(blank, F.lower("c_mktsegment")), RS).alias("region_label"),
        C.geo_label(F.coalesce(blank, F.col("c_custkey").cast("string")), UP).alias("facility_label"),
    )
    return labels.groupBy("region_label", "facility_label").agg(F.count("*").alias("num_rows"))


# --- features of the visit fact ------------------------------------------------


@query
def daily_total(spark, sf):
    return features.daily_total(visits(spark, sf))


@query
def daily_features_global(spark, sf):
    return features.visit_features(visits(spark, sf), levels=(GLOBAL,), with_total=False)


@query
def daily_features_by_region(spark, sf):
    return features.visit_features(visits(spark, sf), lookup(spark, sf), levels=(RS,))


@query
def daily_features_by_facility(spark, sf):
    return features.visit_features(visits(spark, sf), levels=(UP,))


@query
def daily_features_selected(spark, sf):
    return features.visit_features(
        visits(spark, sf),
        lookup(spark, sf),
        chosen_regions(spark, sf),
        chosen_facilities(spark, sf),
    )


@query
def rows_of_selected_regions(spark, sf):
    joined = with_region(visits(spark, sf), lookup(spark, sf), C.UNKNOWN)
    kept = selection.keep_selected(joined, "rs", chosen_regions(spark, sf), C.region)
    return kept.groupBy("rs", "up").agg(F.count("*").alias("num_rows"))


# --- features of the coded fact ------------------------------------------------


def _code_specs(spark, sf):
    """A code range per part, some inverted, some of one digit, some unreadable."""
    parts = table(spark, sf, "part")
    key = F.col("p_partkey")
    low = F.concat(F.char(F.lit(65) + key % 26), F.lpad((key % 100).cast("string"), 2, "0"))
    high = F.concat(
        F.char(F.lit(65) + (key * 7) % 26), (F.col("p_size") % 30).cast("string")
    )
    spec = F.when(key % 5 == 0, low).when(key % 5 == 1, F.concat(low, F.lit(" - x"))).otherwise(
        F.concat(F.lower(low), F.lit(" – "), high)
    )
    return parts.select("p_partkey", "p_brand", spec.alias("spec"))


@query
def code_range_expansion(spark, sf):
    # a short row becomes many codes, so rows are dealt to all tasks first
    specs = _code_specs(spark, sf).repartition(spark.sparkContext.defaultParallelism)
    # counted within each row: exploded, every code would be sorted to find the first and last
    codes = specs.select("p_partkey", expand_code_spec("spec").alias("codes"))
    rows = codes.select("p_partkey", F.size("codes").alias("n"), F.array_min("codes").alias("low"), F.array_max("codes").alias("high"))
    counted = rows.groupBy("p_partkey").agg(
        F.sum("n").alias("num_codes"), F.min("low").alias("first_code"), F.max("high").alias("last_code")
    )
    return counted.where("num_codes > 0")


@query
def code_alias_map(spark, sf):
    specs = _code_specs(spark, sf)
    return selection.code_selection(specs.select("spec", F.col("p_brand").alias("feature_name")))


@query
def coded_total(spark, sf):
    return features.coded_features(coded(spark, sf), levels=(GLOBAL,))


@query
def coded_total_by_geo(spark, sf):
    return features.coded_features(
        coded(spark, sf),
        lookup(spark, sf),
        regions=chosen_regions(spark, sf),
        levels=(RS, UP),
    )


@query
def coded_alias_counts(spark, sf):
    pairs = selection.expand_code_aliases(coded(spark, sf), chosen_codes(spark))
    return features.code_counts(pairs)


@query
def coded_alias_features(spark, sf):
    return features.coded_features(
        coded(spark, sf), lookup(spark, sf), chosen_codes(spark), with_total=False
    )


@query
def coded_selected_features(spark, sf):
    return features.coded_features(
        coded(spark, sf),
        lookup(spark, sf),
        chosen_codes(spark),
        chosen_regions(spark, sf),
        chosen_facilities(spark, sf),
    )


@query
def coded_counts_by_region(spark, sf):
    placed = with_region(coded(spark, sf), lookup(spark, sf), C.UNKNOWN)
    return features.code_counts(placed, ("rs",))


# --- long, wide and mixed forms ------------------------------------------------


def _global(spark, sf, materialized=True):
    values = features.visit_features(visits(spark, sf), levels=(GLOBAL,))
    return materialize(values, "values") if materialized else values


@query
def wide_matrix(spark, sf):
    return matrix.to_wide(_global(spark, sf))


@query
def wide_to_long(spark, sf):
    return matrix.to_long(matrix.to_wide(_global(spark, sf)))


@query
def feature_days(spark, sf):
    """Days on which each feature occurs, and whether a limit below their number refuses."""
    values = _global(spark, sf)
    known = len(matrix.feature_list(values))
    try:
        refused = not matrix.feature_list(values, known - 1)
    except ValueError:
        refused = True
    counted = values.groupBy("feature").agg(F.count("*").alias("num_days"))
    return counted.withColumns({"num_features": F.lit(known), "refused": F.lit(refused)})


@query
def combine_partials(spark, sf):
    """Wide pieces with differing columns, summed per day."""
    orders = visits(spark, sf).groupBy("day")
    lines = coded(spark, sf).groupBy("day")
    by_status = orders.agg(
        F.sum("counts").alias("TOTAL"), F.count_if(F.col("VISI_LLOC_VISITA") == "F").alias("F")
    )
    by_line = lines.agg(F.sum("n").alias("TOTAL"), F.count_if(F.col("n") > 1).alias("REPEATED"))
    return matrix.combine_wide([by_status, by_line, by_status.select("day", "TOTAL")])


@query
def assemble_pieces(spark, sf):
    """Long pieces of two facts, equal features summed."""
    a = features.daily_total(visits(spark, sf), "ALL")
    b = features.daily_total(coded(spark, sf), "ALL", "n")
    return matrix.sum_features(a, b)


@query
def mixed_to_final(spark, sf):
    """Wide totals, code rows and place rows in one frame."""
    written = materialize(with_region(coded(spark, sf), lookup(spark, sf), C.UNKNOWN))
    tasks = tasks_for(written)
    # dealt before they are counted: read, a few tasks would hold the groups of all rows
    counts = written.repartition(tasks, "day", "code")
    code, when = F.col("code").alias("DIAG_DIAG_CODE"), F.col("day").alias("timestamp")
    totals = counts.groupBy(when).agg(F.sum("n").alias("DIAG_TOTAL"))
    by_code = counts.groupBy(when, code).agg(F.sum("n").alias("DIAG_COUNT"))
    by_region = counts.groupBy(when, F.col("rs").alias("DIAG_RS"), code).agg(F.sum("n").alias("count"))
    by_place = counts.groupBy(when, F.col("up").alias("DIAG_up_c"), code).agg(F.sum("n").alias("count"))
    mixed = totals
    for piece in (by_code, by_region, by_place):
        mixed = mixed.unionByName(piece, allowMissingColumns=True)
    return matrix.mixed_to_long(mixed, tasks=tasks)


@query
def canonical_names(spark, sf):
    """Counts stored under older names."""
    rows = with_region(visits(spark, sf), lookup(spark, sf), C.UNKNOWN)
    service, place = F.col("SERVEI_CODI"), F.ltrim("up", F.lit("0"))
    names = F.array(
        F.lit("demanda__TOTAL_CAT"),
        F.concat(F.lit("demanda__SERVEI_CODI__"), service),
        F.concat(F.lit("demanda_SERVEI_CODI_"), service, F.lit("_UP_"), place),
        F.concat(F.lit("demanda_SERVEI_CODI_"), service, F.lit("_"), F.lower("rs")),
        F.concat(F.lit("demanda__TOTAL_RS_"), F.lower("rs")),
    )
    older = rows.select("day", "counts", F.explode(names).alias("feature"))
    values = older.groupBy("day", "feature").agg(F.sum("counts").alias("value"))
    return canonicalize_features(values, "DEMAND")


# --- calendar, estimates and fills -----------------------------------------------


@query
def daily_grid(spark, sf):
    totals = features.daily_total(visits(spark, sf)).select("day", "value")
    return calendar.daily_grid(totals, start=date(1995, 2, 1), end=date(2001, 9, 30))


@query
def last_contiguous_day(spark, sf):
    days = visits(spark, sf).select("day")
    return calendar.last_contiguous_day(days)


@query
def last_observed_day(spark, sf):
    """Days after mid 2001 count as estimates."""
    days = visits(spark, sf).select("day")
    flagged = F.when(F.col("day") > date(2001, 6, 30), " Yes").otherwise("no")
    return calendar.last_observed_day(days.withColumn(IS_IMPUTED, flagged))


@query
def gap_days(spark, sf):
    days = visits(spark, sf).select("day").distinct()
    return calendar.missing_days(days, date(1995, 1, 1), date(2001, 12, 31))


def _visit_matrix(spark, sf):
    values = features.visit_features(visits(spark, sf), lookup(spark, sf), levels=(GLOBAL, RS))
    return DailyMatrix.observed(materialize(values, "visits"))


def _coded_matrix(spark, sf):
    values = features.coded_features(
        coded(spark, sf), lookup(spark, sf), chosen_codes(spark), levels=(GLOBAL, RS)
    )
    return DailyMatrix.observed(materialize(values, "coded"))


def _imputed_visits(spark, sf):
    return impute(_visit_matrix(spark, sf), AS_OF, NOW, target_until=TARGET)


def _values(m: DailyMatrix) -> DataFrame:
    return rounded(m.values.select("day", "feature", "value"))


@query
def impute_missing_days(spark, sf):
    return _values(_imputed_visits(spark, sf))


@query
def impute_after_cut(spark, sf):
    """Real days after the given observed day give way to estimates."""
    m = impute(_visit_matrix(spark, sf), AS_OF, NOW, date(2000, 6, 30), date(2001, 3, 31))
    return _values(m)


@query
def imputed_day_table(spark, sf):
    return _imputed_visits(spark, sf).days


@query
def observed_part(spark, sf):
    return _values(drop_imputed(_imputed_visits(spark, sf)))


@query
def drop_imputed_text_flags(spark, sf):
    totals = features.daily_total(visits(spark, sf)).select("day", "value")
    labels = F.array(*[F.lit(t) for t in ("True", "no", " 1", "Y ", "false", "")])
    flag = F.element_at(labels, F.dayofmonth("day") % 6 + 1)
    flagged = totals.withColumn(IS_IMPUTED, F.when(F.col("value") > 1, flag))
    return drop_imputed_rows(flagged)


@query
def imputation_summary(spark, sf):
    summary = quality.imputation_summary(_joined(spark, sf, "ffill").days)
    return summary.withColumn("imputed_dates", F.array_join("imputed_dates", ","))


@query
def imputed_rows(spark, sf):
    return quality.imputed_rows(_joined(spark, sf, "ffill").days)


@query
def quality_report(spark, sf):
    return quality.check_imputation(_joined(spark, sf, "ffill").days, date(2001, 6, 30))


def _joined(spark, sf, method):
    """Estimated visits with observed coded rows: both sides have gaps."""
    return join_matrices(_imputed_visits(spark, sf), _coded_matrix(spark, sf), AS_OF, method)


@query
def join_ffill(spark, sf):
    joined = join_matrices(_visit_matrix(spark, sf), _coded_matrix(spark, sf), AS_OF, "ffill")
    return _values(joined)


@query
def join_bfill(spark, sf):
    joined = join_matrices(_visit_matrix(spark, sf), _coded_matrix(spark, sf), AS_OF, "bfill")
    return _values(joined)


@query
def join_interpolate(spark, sf):
    joined = join_matrices(
        _visit_matrix(spark, sf), _coded_matrix(spark, sf), AS_OF, "interpolate"
    )
    return _values(joined)


@query
def join_without_fill(spark, sf):
    joined = join_matrices(_visit_matrix(spark, sf), _coded_matrix(spark, sf), date(2001, 9, 30), None)
    return _values(joined)


@query
def joined_day_table(spark, sf):
    days = _joined(spark, sf, "ffill").days
    keep = ["day", *[f"{p}_{c}" for p in ("DEMAND", "DIAGNOSIS") for c in CONTROL_COLUMNS]]
    return days.select(*keep).withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keep[1:]}
    )


def _gappy_series(spark, sf):
    """Daily line counts per line number; quiet days have no value."""
    lines = table(spark, sf, "lineitem")
    day = day_of(lines, "l_shipdate").alias("day")
    counts = lines.groupBy("l_linenumber", day).agg(F.count("*").alias("n"))
    return counts.select(
        "l_linenumber", "day", F.when(F.col("n") % 3 != 0, F.col("n").cast("double")).alias("value")
    )


def _filled(method):
    def run(spark, sf):
        series = _gappy_series(spark, sf)
        filled = fill.fill_nulls(series, ["l_linenumber"], "day", ["value"], method)
        return rounded(filled.fillna(-1.0, ["value"]))

    run.__name__ = f"fill_{method}"
    return query(run)


for _method in ("ffill", "bfill", "interpolate"):
    _filled(_method)


# --- keep-last, merges and replacement -------------------------------------------


@query
def keep_last_rows(spark, sf):
    """Latest event per user and type."""
    events = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return dedup.keep_last(events, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "value"
    )


@query
def join_incremental_dedup(spark, sf):
    """Last row per day of each side, joined without filling."""
    orders = table(spark, sf, "orders")
    left = orders.groupBy(day_of(orders, "o_orderdate").alias("timestamp"), "o_orderpriority").agg(
        F.count("*").alias("demanda__TOTAL_CAT"), F.max("o_orderkey").alias("last_key")
    )
    lines = table(spark, sf, "lineitem")
    right = lines.groupBy(day_of(lines, "l_shipdate").alias("timestamp"), "l_linenumber").agg(
        F.count("*").alias("DIAG_TOTAL"), F.max("l_orderkey").alias("last_key")
    )
    left = left.withColumn("_at", F.col("o_orderpriority")).drop("o_orderpriority")
    right = right.withColumn("_at", F.col("l_linenumber").cast("string")).drop("l_linenumber")
    joined = join_incremental(left, right, ["_at"])
    return joined.fillna(-1, [c for c in joined.columns if c != "timestamp"])


@query
def merge_pieces_on_keys(spark, sf):
    """Two pieces per side, last row per (day, nation) wins."""
    orders = raw_visits(spark, sf)
    day = day_of(orders, "DATA_VISITA").alias("timestamp")
    place = F.col("UP").cast("int").alias("place")
    first = orders.groupBy(day, place).agg(F.count("*").alias("n"))
    second = orders.where("VISI_LLOC_VISITA = 'F'").groupBy(day, place).agg(F.count("*").alias("n"))
    lines = raw_coded(spark, sf)
    day = day_of(lines, "data_visita").alias("timestamp")
    place = F.col("up_c").cast("int").alias("place")
    right = lines.groupBy(day, place).agg(F.count("*").alias("n"))
    merged = merge_on_keys(
        [first.withColumn("at", F.lit(1)), second.withColumn("at", F.lit(2))],
        [right.withColumn("at", F.lit(1))],
        date(2001, 6, 30),
        ["timestamp", "place"],
        order=["at"],
    )
    return merged.fillna(-1, ["n", "DIAG_n"])


@query
def replace_recomputed_days(spark, sf):
    """Stored totals; the days of two years are recomputed from urgent rows."""
    rows = visits(spark, sf)
    stored = DailyMatrix.observed(features.daily_total(rows))
    again = rows.where("day >= '1997-01-01' AND day < '1999-01-01' AND SERVEI_CODI = '1-URGENT'")
    return _values(replace_days(stored, DailyMatrix.observed(features.daily_total(again))))


@query
def future_rows_dropped(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    kept = drop_future_rows(orders, "o_orderdate", date(1999, 12, 31))
    return kept.select("o_orderkey", day_of(kept, "o_orderdate").alias("day"))


@query
def date_range_rows(spark, sf):
    orders = table(spark, sf, "orders")
    shown = show_rows(
        orders,
        "o_orderdate",
        date(1996, 2, 1),
        date(1996, 4, 30),
        ["o_orderkey", "o_orderpriority"],
        limit=0,
    )
    rows = shown.rows.withColumns(
        {"matched": F.lit(shown.matched), "total": F.lit(shown.total)}
    )
    return rows.withColumn("o_orderdate", day_of(rows, "o_orderdate"))


@query
def rows_outside_range(spark, sf):
    """Deletion from plain rows; rows without a date stay."""
    events = table(spark, sf, "events")
    dated = events.withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    kept = without_days(dated, date(2024, 1, 5), date(2024, 1, 20), "ts")
    return kept.groupBy("event_type").agg(F.count("*").alias("num_rows"))


# --- stored results ----------------------------------------------------------------


def _store(spark, m, name):
    store = MatrixStore(spark, new_folder(spark, name))
    store.publish(m, AS_OF, NOW)
    return store


@query
def stored_matrix(spark, sf):
    """A matrix written as a version and read back."""
    return _values(_store(spark, _visit_matrix(spark, sf), "store").load())


@query
def delete_range(spark, sf):
    store = _store(spark, _imputed_visits(spark, sf), "delete")
    delete_days(store, date(1997, 3, 1), date(1999, 6, 30), NOW)
    return _values(store.load())


@query
def cursor_after_delete(spark, sf):
    store = _store(spark, _imputed_visits(spark, sf), "cursor")
    staging = StagingArea(spark, new_folder(spark, "staging"))
    delete_days(store, date(1997, 3, 1), date(1999, 6, 30), NOW, staging)
    return _text_update(staging.cursor.read())


def _text_update(cursor):
    return cursor.withColumn("last_update", F.date_format("last_update", "yyyy-MM-dd HH:mm:ss"))


@query
def cursor_of_observed_days(spark, sf):
    return _text_update(cursor_of(_imputed_visits(spark, sf).days, NOW))


@query
def window_after_gap(spark, sf):
    """The next run resumes after the last day before the first gap."""
    days = visits(spark, sf).select("day")
    low, high = days.agg(F.min("day"), F.max("day")).first()
    last = calendar.last_contiguous_day(days).first()[0]
    window = processing_window(low, high, last, end=date(2001, 7, 1), today=AS_OF)
    days_left = days.where(
        (F.col("day") >= window.start) & (F.col("day") < window.end_exclusive)
    ) if window else days.limit(0)
    return days_left.groupBy("day").agg(F.count("*").alias("num_rows"))


@query
def incremental_runs(spark, sf):
    """Two increments and one reprocessed year: equal to counting all at once."""
    source, places = raw_visits(spark, sf), lookup(spark, sf)
    chosen = Selections(regions=chosen_regions(spark, sf), facilities=chosen_facilities(spark, sf))
    store = MatrixStore(spark, new_folder(spark, "runs"))
    staging = StagingArea(spark, new_folder(spark, "runs-staging"))
    steps = [
        {"end": date(1998, 6, 30)},
        {"start": date(1998, 7, 1), "end": TARGET},
        {"start": date(1996, 1, 1), "end": date(1996, 12, 31)},
    ]
    for hour, step in enumerate(steps):
        run = Run(
            store, staging, AS_OF, NOW + timedelta(hours=hour), min_valid=date(1990, 1, 1), **step
        )
        run_visits(source, places, run, chosen)
    return _values(drop_imputed(store.load()))


@query
def staged_rows(spark, sf):
    """Rows staged in two runs; of equal identities the last one stays."""
    rows = coded(spark, sf).withColumnsRenamed({"day": "timestamp", "code": "DIAG_CODE", "up": "UP"})
    named = materialize(identity.with_row_identity(rows), "named")
    staging = StagingArea(spark, new_folder(spark, "rows"))
    staging.append(named, "1", AS_OF, "timestamp", chunk_rows=10_000)
    again = named.where("UP < '00100'").withColumn("n", F.col("n") * 10)
    staging.append(again, "2", AS_OF, "timestamp", chunk_rows=10_000)
    rows = staging.load()
    last = dedup.keep_last(readers.with_file_order(rows.withColumn("last_run", F.col("run"))), ["data_id"], ["run", *readers.FILE_ORDER])
    kept = staging.load_rows(columns=["n"]).withColumnRenamed("n", "kept_n")
    return last.join(kept.select("data_id", "kept_n"), "data_id")


@query
def row_identity(spark, sf):
    rows = coded(spark, sf).withColumnsRenamed({"day": "timestamp", "code": "DIAG_CODE", "up": "UP"})
    return identity.with_row_identity(rows)


def _totals(spark, sf):
    """Daily visit totals as stored values."""
    values = features.daily_total(visits(spark, sf))
    return materialize(values.withColumn("value", F.col("value").cast("double")), "totals")


def _places(spark, name, retention_days=None):
    store = MatrixStore(spark, new_folder(spark, name))
    return store, StagingArea(spark, new_folder(spark, f"{name}-staging"), retention_days)


@query
def publish_range(spark, sf):
    """Two published years; the other staged days wait for the next publication."""
    store, staging = _places(spark, "range")
    staging.append(_totals(spark, sf), "1", AS_OF)
    publish(store, staging, AS_OF, NOW, with_range=(date(1996, 1, 1), date(1997, 12, 31)))
    columns = ["day", "feature", "value"]
    published = store.load().values.select(*columns, F.lit("stored").alias("place"))
    return published.unionByName(staging.load().select(*columns, F.lit("staged").alias("place")))


@query
def retention_after_publish(spark, sf):
    """Rows older than the retention period are published before they expire."""
    store, staging = _places(spark, "retention", retention_days=365)
    staging.append(_totals(spark, sf), "1", AS_OF)
    publish(store, staging, AS_OF, NOW, clear=False)
    return _values(store.load())


@query
def delete_days_keeps_later(spark, sf):
    """A deletion made in the middle of the stored days removes only its range."""
    store = _store(spark, DailyMatrix.observed(_totals(spark, sf)), "later")
    delete_days(store, date(1997, 3, 1), date(1997, 6, 30), datetime(1998, 1, 1))
    return _values(store.load())


@query
def stream_publication(spark, sf):
    """Runs published by a stream: a newer one, an older one that arrives late and
    covers a further year, one with later days; the target lies before stored days."""
    store, staging = _places(spark, "stream")
    totals, checkpoint = _totals(spark, sf), new_folder(spark, "checkpoint")
    again = totals.withColumn("value", F.col("value") * 10)
    arrivals = {
        "2": totals.where("day < '1998-01-01'"),
        "1": again.where("day < '1999-01-01'"),
        "3": totals.where("day >= '2000-01-01'"),
    }
    for run, rows in arrivals.items():
        staging.append(rows, run, AS_OF)
        publish_available(spark, staging, store, checkpoint, AS_OF, NOW, date(1996, 6, 30))
    return _values(drop_imputed(store.load()))


def _coded_run(spark, sf, store, staging, hour, **days):
    chosen = Selections(chosen_regions(spark, sf), chosen_facilities(spark, sf), chosen_codes(spark))
    run = Run(store, staging, AS_OF, NOW + timedelta(hours=hour), min_valid=date(1990, 1, 1), **days)
    return run_coded(raw_coded(spark, sf), lookup(spark, sf), run, chosen)


@query
def incremental_coded_runs(spark, sf):
    """Increments that resume by themselves: equal to counting all at once."""
    store, staging = _places(spark, "coded")
    for hour, end in enumerate([date(1998, 6, 30), date(2000, 3, 31), TARGET]):
        _coded_run(spark, sf, store, staging, hour, end=end)
    return _values(drop_imputed(store.load()))


@query
def resumed_run(spark, sf):
    """A run that stopped after staging is superseded by the next one."""
    store, staging = _places(spark, "resumed")
    staging.append(_totals(spark, sf), "20011231T000000", AS_OF)
    _coded_run(spark, sf, store, staging, 0, end=TARGET)
    return _values(drop_imputed(store.load()))


@query
def refreshed_estimates(spark, sf):
    """Estimates of stored days when the source has nothing new."""
    store = _store(spark, _visit_matrix(spark, sf), "refreshed")
    refresh_imputation(store, AS_OF, NOW, TARGET)
    return _values(store.load())


@query
def staging_after_clear(spark, sf):
    """One of two staged runs is cleared."""
    _, staging = _places(spark, "cleared")
    totals = _totals(spark, sf)
    staging.append(totals.where("day < '1998-01-01'"), "1", AS_OF)
    staging.append(totals.where("day >= '1998-01-01'"), "2", AS_OF)
    staging.clear(["1"])
    return staging.load().select("run", "day", "feature", "value")


@query
def partitioned_rows_deleted(spark, sf):
    """A deletion from a partitioned folder keeps the partitions and stores the cursor."""
    path = new_folder(spark, "partitioned")
    totals = _totals(spark, sf).withColumn("year", F.year("day"))
    totals.write.partitionBy("year").parquet(path)
    cursors = CursorStore(spark, new_folder(spark, "partitioned-cursor"))
    delete_parquet_rows(
        spark, path, date(1997, 3, 1), date(1999, 6, 30), NOW, "day", create_backup=False, cursors=cursors
    )
    year = F.regexp_extract("_metadata.file_path", r"year=(\d+)", 1).alias("folder")
    kept = spark.read.parquet(path).select("day", "value", year)
    return kept.withColumn("resume_after", F.lit(cursors.last_day()))


@query
def stored_estimates(spark, sf):
    """The list of estimated days that lies beside a stored version."""
    store = _store(spark, _imputed_visits(spark, sf), "listed")
    path = f"{store.versions.path(store.versions.latest())}/imputed_rows"
    return readers.read_csv(spark, path)


@query
def matrix_from_wide(spark, sf):
    """A wide frame with names of today read back as a matrix."""
    return _values(matrix.from_wide(matrix.to_wide(_global(spark, sf)), "DEMAND"))


@query
def first_rows_of_range(spark, sf):
    shown = show_rows(_totals(spark, sf), "day", date(1996, 2, 1), date(1997, 4, 30), ["value"], limit=10)
    return shown.rows.withColumn("matched", F.lit(shown.matched))


@query
def row_identity_by_columns(spark, sf):
    """Without identifying columns the names of the others stand in."""
    rows = _totals(spark, sf).select(F.col("day").alias("timestamp"), F.col("value").alias("n"))
    return identity.with_row_identity(rows)


@query
def table_as_csv(spark, sf):
    """A Parquet folder converted to text."""
    parquet, csv = new_folder(spark, "table"), new_folder(spark, "table-csv")
    features.daily_total(visits(spark, sf)).write.parquet(parquet)
    readers.convert_to_csv(spark, parquet, csv)
    return readers.read_csv(spark, csv)


@query
def lookup_last_wins(spark, sf):
    """Customers as lookup rows over several files: the last of a facility counts."""
    customers = table(spark, sf, "customer").repartitionByRange(4, "c_custkey").sortWithinPartitions("c_custkey")
    path = new_folder(spark, "lookup")
    readers.write_csv(
        customers.select(F.col("c_nationkey").alias("Codi UP"), F.col("c_mktsegment").alias("RS")), path
    )
    return facility_lookup(readers.read_csv(spark, path))


@query
def selection_last_wins(spark, sf):
    """Customers as selection rows over several files: the last of a region counts."""
    customers = table(spark, sf, "customer").repartitionByRange(4, "c_custkey").sortWithinPartitions("c_custkey")
    path = new_folder(spark, "selection")
    alias = F.concat(F.lit("c "), "c_custkey").alias("geo_id")
    readers.write_csv(customers.select(alias, F.col("c_mktsegment").alias("RS")), path)
    return selection.region_selection(readers.read_csv(spark, path))


@query
def full_with_empty_selection(spark, sf):
    """Selections without rows select everything."""
    none = Selections(chosen_regions(spark, sf).limit(0), chosen_facilities(spark, sf).limit(0))
    return _values(full_visits(raw_visits(spark, sf), lookup(spark, sf), AS_OF, none))


@query
def canonical_diagnosis_names(spark, sf):
    """Coded counts stored under older names."""
    rows = with_region(coded(spark, sf), lookup(spark, sf), C.UNKNOWN)
    names = F.array(
        F.lit("DIAG_TOTAL"),
        F.concat(F.lit("TOTAL__RS__"), F.lower("rs")),
        F.concat(F.lit("DIAG_TOTAL_UP_"), "up"),
        F.concat(F.lit("ICD10_3__"), "code", F.lit("__RS__"), F.lower("rs")),
        F.concat(F.lit("DIAG_CODE_"), "code"),
    )
    older = rows.select("day", "n", F.explode(names).alias("feature"))
    values = older.groupBy("day", "feature").agg(F.sum("n").alias("value"))
    return canonicalize_features(values, "DIAGNOSIS")


@query
def files_past_retention(spark, sf):
    """Files by year of orders; years before 1999 are past the retention."""
    rows = visits(spark, sf).select("day", F.year("day").alias("year"))
    path = new_folder(spark, "files")
    rows.write.partitionBy("year").parquet(path)
    old = expired_files(spark.read.parquet(path), AS_OF, 1096)
    return old.groupBy(F.year("last_day").alias("year")).agg(F.max("last_day").alias("last_day"))


@query
def matrix_as_csv(spark, sf):
    """A wide matrix saved as CSV and loaded again."""
    path = new_folder(spark, "csv")
    readers.save_matrix_csv(matrix.to_wide(_global(spark, sf)), path)
    return readers.load_matrix_csv(spark, path)


@query
def codes_from_csv(spark, sf):
    """Codes keep their leading zeros through CSV."""
    path = new_folder(spark, "codes")
    customers = table(spark, sf, "customer")
    readers.write_csv(customers.select(C.facility("c_nationkey").alias("UP"), "c_mktsegment"), path)
    read = readers.read_csv(spark, path, ["UP", "c_mktsegment"])
    return read.groupBy("UP", "c_mktsegment").agg(F.count("*").alias("num_rows"))


def _published_years(spark, sf, name):
    """Totals published in two increments, the second of one day with a target behind it."""
    store, staging = _places(spark, name)
    totals = _totals(spark, sf)
    staging.append(totals.where("day < '2000-06-01'"), "1", AS_OF)
    publish(store, staging, AS_OF, NOW, impute_until=date(2000, 5, 31))
    return store, staging, totals


@query
def stored_range(spark, sf):
    """A range of a stored matrix, read from the folders of its years."""
    store = _store(spark, _imputed_visits(spark, sf), "stored-range")
    return _values(store.load(start=date(1996, 11, 15), end=date(1997, 2, 10)))


@query
def increment_rewrites_one_year(spark, sf):
    """The folders that an increment of one month writes, and the days in them."""
    store, staging, totals = _published_years(spark, sf, "increment")
    before = set(store.parts())
    staging.append(totals.where("day >= '2000-06-01' AND day < '2000-07-01'"), "2", AS_OF)
    publish(store, staging, AS_OF, NOW)
    written = [p for p in store.parts() if p not in before]
    folders = spark.createDataFrame([(p.kind, p.key) for p in written], "kind string, folder int")
    ends = store.read_parts(written, "observed").agg(F.struct(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("value").alias("value")))
    return folders.withColumn("ends", ends.scalar()).select("kind", "folder", "ends.*")


@query
def estimates_from_stored_sums(spark, sf):
    """Estimates after a year was recomputed, made of sums that were kept by month and day."""
    store, staging, totals = _published_years(spark, sf, "sums")
    again = totals.where("day >= '1996-01-01' AND day < '1997-01-01'").withColumn("value", F.col("value") * 2)
    staging.append(again, "2", AS_OF)
    publish(store, staging, AS_OF, NOW, impute_until=date(2000, 12, 31))
    return _values(store.load())


@query
def stream_retention(spark, sf):
    """What a stream has published expires from the stage by whole files, not from the store."""
    store, staging = _places(spark, "stream-retention", retention_days=1461)
    years = _totals(spark, sf).withColumn("year", F.year("day"))
    checkpoint = new_folder(spark, "retention-checkpoint")
    for year in range(1995, 2002):
        staging.append(years.where(F.col("year") == year).drop("year"), str(year), AS_OF)
        publish_available(spark, staging, store, checkpoint, AS_OF, NOW)
    staged = staging.load().groupBy(F.year("day").alias("year")).agg(F.sum("value").alias("value"))
    stored = store.load().values.groupBy(F.year("day").alias("year")).agg(F.sum("value").alias("value"))
    return stored.withColumn("place", F.lit("stored")).unionByName(staged.withColumn("place", F.lit("staged")))


@query
def appended_without_time(spark, sf):
    """Rows without a time column, staged under the day of the run."""
    _, staging = _places(spark, "untimed")
    staging.append(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "1", date(1999, 9, 9), "timestamp")
    return staging.load().drop("run")


@query
def estimates_as_json(spark, sf):
    """The summary of estimates that lies beside a stored version, read from its JSON."""
    store = _store(spark, _imputed_visits(spark, sf), "summary")
    path = f"{store.versions.path(store.versions.latest())}/imputation_metadata"
    group = (
        "dataset string, imputed_column string, num_imputed_rows bigint, num_observed_rows bigint, "
        "first_imputed_date string, last_imputed_date string, imputed_dates array<string>"
    )
    schema = f"generated_at string, timestamp_column string, total_rows bigint, total_imputed_rows bigint, groups array<struct<{group.replace(' ', ':').replace(',:', ', ')}>>"
    read = spark.read.text(path).select(F.from_json("value", schema).alias("s")).select("s.*")
    dates = F.array_join("imputed_dates", ",").alias("imputed_dates")
    return read.select("*", F.inline("groups")).drop("groups").select("*", dates.alias("dates")).drop("imputed_dates")


@query
def year_slices_of_source(spark, sf):
    """Rows of the slices that a range of days is read in."""
    lines = table(spark, sf, "lineitem")
    slices = readers.year_slices(date(1995, 6, 15), date(1999, 2, 1))
    out = None
    for year, first, end in slices:
        rows = readers.scan_range(lines, "l_shipdate", first, end, ["l_shipdate"])
        day = day_of(rows, "l_shipdate")
        one = rows.agg(F.lit(year).alias("year"), F.count("*").alias("num_rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))
        out = one if out is None else out.unionByName(one)
    return out


def _spelled_dates(spark, sf):
    """Order dates in four spellings, some of them broken, blank or absent."""
    day = F.col("o_orderdate")
    spellings = ["yyyy-MM-dd", "dd/MM/yyyy", "dd.MM.yyyy HH:mm", "yyyyMMdd"]
    pick = [F.date_format(day, f) for f in spellings] + [F.lit("31/02/1997"), F.lit(" "), F.lit(None).cast("string")]
    text = F.element_at(F.array(*pick), (F.col("o_orderkey") % 7 + 1).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", text.alias("seen"))


DATE_FORMATS = ("dd/MM/yyyy", "dd.MM.yyyy HH:mm", "yyyyMMdd")


@query
def dates_in_several_formats(spark, sf):
    return with_read_days(_spelled_dates(spark, sf), "seen", DATE_FORMATS).where("seen IS NOT NULL")


@query
def rejected_dates(spark, sf):
    """Rows whose date cannot be read, with the reason."""
    return prepare.rejected_dates(_spelled_dates(spark, sf), "seen", DATE_FORMATS).fillna("none", ["seen"])


@query
def column_contract(spark, sf):
    """Required columns of a table, of which two are missing."""
    wanted = ["O_ORDERKEY", "o_orderdate", "o_place", "O_Clerk_Code"]
    orders = table(spark, sf, "orders")
    report = prepare.missing_columns(orders, wanted, "orders").fillna("none", ["stored_as"])
    return report.withColumn("num_rows", orders.agg(F.count("*")).scalar())


# --- reports -------------------------------------------------------------------------


@query
def freshness_audit(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") == "P", F.lit("unknown"))
        .otherwise(F.col("o_orderdate").cast("string"))
        .alias("last_update_text"),
        F.col("o_orderkey").alias("load_id"),
        "o_totalprice",
    )
    audit = quality.freshness_audit(orders, "orders")
    return audit.fillna("none", ["max_upload_candidate"])


@query
def duplicate_days(spark, sf):
    return quality.duplicate_rows(visits(spark, sf), "day")


@query
def narrowed_types(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    narrow = quality.narrow_types(lines)
    kinds = [F.lit(narrow.schema[c].dataType.simpleString()).alias(f"{c}_type") for c in lines.columns]
    return narrow.groupBy("l_linenumber").agg(
        F.count("*").alias("num_rows"),
        F.max("l_orderkey").cast("bigint").alias("max_key"),
        F.sum("l_quantity").alias("quantity"),
    ).select(F.col("l_linenumber").cast("int").alias("l_linenumber"), "num_rows", "max_key", "quantity", *kinds)


# --- both facts ------------------------------------------------------------------------


@query
def full_matrix(spark, sf):
    """Both facts over all levels and selections, completed and joined by day."""
    places = lookup(spark, sf)
    chosen = Selections(
        chosen_regions(spark, sf), chosen_facilities(spark, sf), chosen_codes(spark)
    )
    a = impute(full_visits(raw_visits(spark, sf), places, AS_OF, chosen), AS_OF, NOW, target_until=TARGET)
    b = impute(full_coded(raw_coded(spark, sf), places, AS_OF, chosen), AS_OF, NOW, target_until=TARGET)
    return _values(join_matrices(a, b, AS_OF, "ffill"))
