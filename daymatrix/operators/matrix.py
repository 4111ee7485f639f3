"""Long and wide forms of a daily matrix, and assembly from partial results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.functions import cleaning as C
from daymatrix.functions.naming import (
    CODE_VARIABLE,
    DIAGNOSIS,
    RS,
    SEPARATOR,
    UP,
    canonical_columns,
    control_columns,
    feature_name,
)
from daymatrix.model import (
    CONTROL_COLUMNS,
    CREATED_AT,
    DAY,
    FEATURE,
    IS_IMPUTED,
    METHOD,
    SOURCE_LAST_DATE,
    VALUE,
    DailyMatrix,
    broadcast_days,
    observed_days,
)
from daymatrix.operators.prepare import day_of

# Fixed value: most features a wide matrix may have.
MAX_FEATURES = 200_000


def feature_list(
    values: DataFrame, max_features: int = MAX_FEATURES, context: str = "features"
) -> list[str]:
    """Sorted distinct features, refused before an impossibly wide pivot."""
    distinct = values.where(F.col(FEATURE).isNotNull()).select(FEATURE).distinct()
    names = [row[0] for row in distinct.limit(max_features + 1).collect()]
    if len(names) > max_features:
        raise ValueError(
            f"Refusing a wide table of more than {max_features:,} {context}: check that codes "
            "are grouped by a selection, or raise the limit."
        )
    return sorted(names)


def to_wide(values: DataFrame, features: list[str] | None = None) -> DataFrame:
    """One row per day, one column per feature, zero where there is no row."""
    features = feature_list(values) if features is None else features
    wide = values.groupBy(DAY).pivot(FEATURE, features).agg(F.sum(VALUE))
    return wide.fillna(0, subset=features) if features else wide


def matrix_to_wide(
    matrix: DailyMatrix, features: list[str] | None = None, max_features: int = MAX_FEATURES
) -> DataFrame:
    """Wide values plus the control columns of each day, also for empty days."""
    features = feature_list(matrix.values, max_features) if features is None else features
    wide = to_wide(matrix.values, features)
    joined = matrix.days.join(wide, DAY, "left")
    filled = joined.fillna(0, subset=features) if features else joined
    controls = [c for c in matrix.days.columns if c != DAY]
    return filled.select(DAY, *[f"`{f}`" for f in features], *controls)


def to_long(wide: DataFrame, day: str = DAY, keep_zeros: bool = False) -> DataFrame:
    """Long values of a wide frame.  Text values are read as numbers; null and
    (unless asked for) zero cells have no row."""
    columns = [c for c in wide.columns if c != day and c not in control_columns(wide.columns)]
    numbers = wide.select(
        day_of(wide, day).alias(DAY), *[C.number(F.col(f"`{c}`")).alias(c) for c in columns]
    )
    if not columns:
        return numbers.select(DAY, F.lit("").alias(FEATURE), F.lit(0.0).alias(VALUE)).limit(0)
    long = numbers.unpivot(DAY, [F.col(f"`{c}`") for c in columns], FEATURE, VALUE)
    known = long.where(F.col(DAY).isNotNull() & F.col(VALUE).isNotNull())
    return known if keep_zeros else known.where(F.col(VALUE) != 0)


def from_wide(wide: DataFrame, domain: str, day: str = DAY) -> DailyMatrix:
    """Matrix of a stored wide frame: canonical names, same names summed, the
    control columns kept when present.  A day with a real row loses its
    estimated rows."""

    # one row per column of the frame
    columns = wide.sparkSession.createDataFrame(
        list(canonical_columns(wide, domain).items()), f"{FEATURE} string, canonical string"
    )

    def values_of(rows):
        named = to_long(rows, day).join(F.broadcast(columns), FEATURE)
        return sum_features(named.select(DAY, F.col("canonical").alias(FEATURE), VALUE))

    when = day_of(wide, day).alias(DAY)
    if IS_IMPUTED not in wide.columns:
        days = wide.select(when).where(F.col(DAY).isNotNull()).distinct()
        return DailyMatrix(values_of(wide), observed_days(days))
    flag = C.flag(IS_IMPUTED, wide.schema[IS_IMPUTED].dataType)
    texts = [
        (F.max(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in wide.columns else F.lit("")).alias(c)
        for c in (METHOD, SOURCE_LAST_DATE, CREATED_AT)
    ]
    days = wide.groupBy(when).agg(F.min(flag).alias(IS_IMPUTED), *texts)
    days = days.where(F.col(DAY).isNotNull())
    estimated = days.where(IS_IMPUTED).select(F.col(DAY).alias("_day"))
    rows = wide.withColumn("_day", when).join(broadcast_days(estimated), "_day", "left_semi")
    used = wide.where(~flag).unionByName(rows.drop("_day"))
    return DailyMatrix(values_of(used), days)


def sum_features(*pieces: DataFrame) -> DataFrame:
    """Sum long pieces per (day, feature).  Nulls do not count."""
    union = reduce(DataFrame.unionByName, [p.select(DAY, FEATURE, VALUE) for p in pieces])
    return union.groupBy(DAY, FEATURE).agg(F.sum(VALUE).alias(VALUE))


def combine_wide(pieces: list[DataFrame], day: str = DAY) -> DataFrame:
    """Sum wide pieces with differing columns: one row per day, null is zero."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
    columns = [c for c in union.columns if c != day]
    sums = [F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in columns]
    return union.groupBy(day).agg(*sums)


# Columns of mixed partial rows.
MIXED_CODE = "DIAG_DIAG_CODE"
MIXED_CODE_COUNT = "DIAG_COUNT"
MIXED_PLACE_COUNT = "count"
MIXED_PLACES = [("DIAG_RS", RS), ("DIAG_UP", UP), ("DIAG_up_c", UP), ("RS", RS), ("UP", UP)]


def mixed_to_long(mixed: DataFrame, day: str = "timestamp", tasks: int | None = None) -> DataFrame:
    """Long features of a frame that mixes three kinds of partial rows: wide
    columns, (code, count) rows and (place, code, count) rows.

    One pass: every row yields the cells it has, then cells of one name are
    summed per day.  Rows that hardly share cells are better dealt to ``tasks`` before
    they are summed: the engine sizes its own tasks by packed bytes, and each holds its
    cells twice.
    """
    present = set(mixed.columns)
    current = canonical_columns(mixed, DIAGNOSIS)
    domain = DIAGNOSIS + SEPARATOR
    cells = [
        _cell(F.lit(name), C.number(F.col(f"`{c}`")))
        for c, name in current.items()
        if name.startswith(domain)
    ]
    code_columns = domain + CODE_VARIABLE + SEPARATOR
    has_code_columns = any(name.startswith(code_columns) for name in current.values())
    if not has_code_columns and {MIXED_CODE, MIXED_CODE_COUNT} <= present:
        code = F.col(MIXED_CODE)
        name = F.when(code.isNotNull(), feature_name(DIAGNOSIS, CODE_VARIABLE, code))
        cells.append(_cell(name, F.coalesce(C.number(MIXED_CODE_COUNT), F.lit(0.0))))
    for column, level in MIXED_PLACES:
        if {column, MIXED_CODE, MIXED_PLACE_COUNT} <= present:
            code, place = F.col(MIXED_CODE), F.col(column)
            name = feature_name(
                DIAGNOSIS, CODE_VARIABLE, code, level, C.geo_label(place, level)
            )
            name = F.when(code.isNotNull() & place.isNotNull(), name)
            cells.append(_cell(name, F.coalesce(C.number(MIXED_PLACE_COUNT), F.lit(0.0))))
    if not cells:
        raise ValueError("no feature columns, code counts or place counts in the input")
    rows = mixed.select(day_of(mixed, day).alias(DAY), F.inline(F.array(*cells))).dropna()
    return sum_features(rows.repartition(tasks, DAY, FEATURE) if tasks else rows)


def _cell(name, value):
    return F.struct(name.alias(FEATURE), value.cast("double").alias(VALUE))
