"""Reports on estimates, freshness and column types."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymatrix.functions import cleaning as C
from daymatrix.model import CREATED_AT, DAY, IS_IMPUTED, METHOD, SOURCE_LAST_DATE
from daymatrix.operators.prepare import day_of

# Words that mark a column as load or audit information.
AUDIT_WORDS = [
    "load",
    "upload",
    "ingest",
    "import",
    "etl",
    "extract",
    "refresh",
    "update",
    "modified",
    "created",
    "audit",
]


def _datasets(df: DataFrame) -> list[tuple[str, str]]:
    """(label, prefix) of every flag column; labels are prefixes without ``_``."""
    prefixes = [c[: -len(IS_IMPUTED)] for c in df.columns if c.endswith(IS_IMPUTED)]
    return [(p.rstrip("_") or "base", p) for p in prefixes]


def _flag(df: DataFrame, prefix: str):
    name = prefix + IS_IMPUTED
    return C.flag(F.col(f"`{name}`"), df.schema[name].dataType)


def _iso(day):
    return F.date_format(day, "yyyy-MM-dd")


def check_imputation(df: DataFrame, as_of: date, day: str = DAY) -> DataFrame:
    """Quality report of a frame with control columns, one row per dataset.

    A dataset is fine when all its control columns exist and every estimate has
    a method, a source day and a creation time; duplicate days and rows after
    ``as_of`` spoil all of them.  One aggregation pass; no flag column at all
    gives an empty report, which counts as a failure (see ``passes``).
    """
    when = day_of(df, day)
    datasets = _datasets(df)
    shared = [
        (F.count(when) - F.count_distinct(when)).alias("duplicate_days"),
        F.count_if(when > F.lit(as_of)).alias("future_rows"),
    ]
    measures, rows = [], []
    for i, (label, prefix) in enumerate(datasets):
        imputed = _flag(df, prefix)
        controls = [prefix + c for c in (METHOD, SOURCE_LAST_DATE, CREATED_AT)]
        missing = [c for c in controls if c not in df.columns]
        measures += [
            F.count_if(~imputed).alias(f"observed_{i}"),
            F.count_if(imputed).alias(f"imputed_{i}"),
            F.max(F.when(~imputed, when)).alias(f"last_observed_{i}"),
            F.min(F.when(imputed, when)).alias(f"first_imputed_{i}"),
            F.max(F.when(imputed, when)).alias(f"last_imputed_{i}"),
        ]
        blanks = []
        for kind, c in zip(("method", "source", "created"), controls):
            blank = F.lit(0).cast("bigint")
            if c in df.columns:
                measures.append(
                    F.count_if(imputed & C.blank_to_null(F.col(f"`{c}`")).isNull()).alias(
                        f"empty_{kind}_{i}"
                    )
                )
                blank = F.col(f"empty_{kind}_{i}")
            blanks.append(blank.alias(f"empty_{kind}"))
        fine = (F.col("duplicate_days") + F.col("future_rows") + sum(blanks, F.lit(0))) == 0
        rows.append(
            F.struct(
                F.lit(label).alias("dataset"),
                F.col(f"observed_{i}").alias("observed_rows"),
                F.col(f"imputed_{i}").alias("imputed_rows"),
                _iso(F.col(f"last_observed_{i}")).alias("last_observed"),
                _iso(F.col(f"first_imputed_{i}")).alias("first_imputed"),
                _iso(F.col(f"last_imputed_{i}")).alias("last_imputed"),
                *blanks,
                F.lit(", ".join(missing)).alias("missing_columns"),
                "duplicate_days",
                "future_rows",
                (fine & F.lit(not missing)).alias("ok"),
            )
        )
    if not rows:
        schema = (
            "dataset string, observed_rows bigint, imputed_rows bigint, last_observed string, "
            "first_imputed string, last_imputed string, empty_method bigint, empty_source bigint, "
            "empty_created bigint, missing_columns string, duplicate_days bigint, "
            "future_rows bigint, ok boolean"
        )
        return df.sparkSession.createDataFrame([], schema)
    return df.agg(*shared, *measures).select(F.inline(F.array(*rows)))


def passes(report: DataFrame) -> bool:
    """True when the report has datasets and all are fine."""
    return bool(report.agg(F.coalesce(F.min("ok"), F.lit(False))).first()[0])


def imputation_summary(df: DataFrame, day: str = DAY) -> DataFrame:
    """Counts and dates of estimates, one row per dataset.  Dates are distinct
    calendar days, so the list stays small."""
    when = day_of(df, day)
    datasets = _datasets(df)
    measures, rows = [F.count("*").alias("total_rows")], []
    for i, (label, prefix) in enumerate(datasets):
        imputed = _flag(df, prefix)
        measures += [
            F.count_if(imputed).alias(f"imputed_{i}"),
            F.sort_array(F.collect_set(F.when(imputed, _iso(when)))).alias(f"dates_{i}"),
        ]
        dates = F.col(f"dates_{i}")
        rows.append(
            F.struct(
                F.lit(label).alias("dataset"),
                F.lit(prefix + IS_IMPUTED).alias("imputed_column"),
                F.col(f"imputed_{i}").alias("num_imputed_rows"),
                (F.col("total_rows") - F.col(f"imputed_{i}")).alias("num_observed_rows"),
                F.get(dates, F.lit(0)).alias("first_imputed_date"),
                F.get(dates, F.size(dates) - 1).alias("last_imputed_date"),
                dates.alias("imputed_dates"),
            )
        )
    if not rows:
        raise ValueError("no imputation flag column found")
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def imputed_rows(df: DataFrame, day: str = DAY) -> DataFrame:
    """One row per estimate and dataset, with its control values as text."""
    when = day_of(df, day)

    def control(name):
        value = F.col(f"`{name}`").cast("string") if name in df.columns else F.lit("")
        return F.coalesce(value, F.lit(""))

    rows = [
        F.struct(
            F.lit(label).alias("dataset"),
            F.coalesce(_iso(when), F.lit("")).alias("timestamp"),
            _flag(df, prefix).alias("is_imputed"),
            control(prefix + METHOD).alias("imputation_method"),
            control(prefix + SOURCE_LAST_DATE).alias("imputation_source_last_date"),
            control(prefix + CREATED_AT).alias("imputation_created_at"),
        )
        for label, prefix in _datasets(df)
    ]
    if not rows:
        raise ValueError("no imputation flag column found")
    return df.select(F.inline(F.array(*rows))).where("is_imputed")


def write_imputation_metadata(
    df: DataFrame, folder: str, source: str, generated_at: datetime, day: str = DAY
) -> None:
    """Write the summary as JSON and the list of estimates as CSV."""
    group = F.struct(
        "dataset",
        "imputed_column",
        "num_imputed_rows",
        "num_observed_rows",
        "first_imputed_date",
        "last_imputed_date",
        "imputed_dates",
    )
    document = imputation_summary(df, day).agg(
        F.struct(
            F.lit(source).alias("source_file"),
            F.lit(generated_at.isoformat()).alias("generated_at"),
            F.lit(day).alias("timestamp_column"),
            F.max(F.col("num_imputed_rows") + F.col("num_observed_rows")).alias("total_rows"),
            F.sum("num_imputed_rows").alias("total_imputed_rows"),
            F.sort_array(F.collect_list(group)).alias("groups"),
        ).alias("summary")
    )
    text = document.select(F.to_json("summary", {"ignoreNullFields": "false"}).alias("value"))
    text.coalesce(1).write.text(f"{folder}/imputation_metadata")
    listed = imputed_rows(df, day).coalesce(1)
    listed.write.option("header", True).option("emptyValue", "").csv(f"{folder}/imputed_rows")


def duplicate_rows(df: DataFrame, column: str) -> DataFrame:
    """One row: how many rows repeat a value that another row already has."""
    extra = F.count(column) - F.count_distinct(column)
    return df.agg(extra.alias("duplicate_rows"))


def audit_columns(df: DataFrame) -> list[str]:
    """Columns whose name contains an audit word."""
    return [c for c in df.columns if any(w in c.lower() for w in AUDIT_WORDS)]


def freshness_audit(df: DataFrame, table: str) -> DataFrame:
    """Latest readable time of every audit column, in one pass.

    ``(table_name, column_name, data_type, max_upload_candidate, status)``
    """
    readable = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
    measures, rows = [F.lit(1).alias("_one")], []
    for i, c in enumerate(audit_columns(df)):
        kind = df.schema[c].dataType
        ok = isinstance(kind, readable)
        column = F.col(f"`{c}`")
        latest = F.max(column.try_cast("timestamp_ntz") if ok else F.lit(None).cast("timestamp_ntz"))
        measures.append(latest.alias(f"latest_{i}"))
        rows.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.lit(kind.simpleString()).alias("data_type"),
                F.date_format(f"latest_{i}", "yyyy-MM-dd HH:mm:ss").alias("max_upload_candidate"),
                F.lit("ok" if ok else "could not cast to datetime").alias("status"),
            )
        )
    if not rows:
        raise ValueError(f"no audit columns in {table}")
    return df.groupBy().agg(*measures).select(F.inline(F.array(*rows)))


def narrow_types(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Smallest column types that hold the data: integers by their range, doubles
    become floats when in range.  One pass over the given columns."""
    wanted = [c for c in df.columns if columns is None or c in columns]
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    numeric = [c for c in wanted if isinstance(df.schema[c].dataType, (*integral, T.DoubleType))]
    if not numeric:
        return df
    ends = df.agg(
        *[F.min(f"`{c}`").alias(f"min_{i}") for i, c in enumerate(numeric)],
        *[F.max(f"`{c}`").alias(f"max_{i}") for i, c in enumerate(numeric)],
    ).first()
    casts = {}
    for i, c in enumerate(numeric):
        low, high = ends[f"min_{i}"], ends[f"max_{i}"]
        if low is None:
            continue
        if isinstance(df.schema[c].dataType, T.DoubleType):
            limit = 3.4028234663852886e38
            if -limit < low and high < limit:
                casts[c] = F.col(f"`{c}`").cast("float")
            continue
        for bits, name in ((8, "tinyint"), (16, "smallint"), (32, "int")):
            if -(2 ** (bits - 1)) <= low and high < 2 ** (bits - 1):
                casts[c] = F.col(f"`{c}`").cast(name)
                break
    return df.withColumns(casts)
