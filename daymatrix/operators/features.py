"""Daily counts of facts as long features.

Both facts follow one plan with two shuffles:

1. the only pass over raw rows turns each row into its feature names (total and
   categories) and counts per (day, facility, name).  The map tasks combine, and
   a facility has few names a day, so what is shuffled is a small fraction of
   the rows and neither a busy day nor a busy facility is ever collected whole;
2. on that small result: attach the region and the selected aliases, fan out to
   the global, region and facility levels and sum per (day, feature), again
   combined in the map tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymatrix.functions import cleaning as C
from daymatrix.functions.naming import (
    CODE_VARIABLE,
    DEMAND,
    DIAGNOSIS,
    RS,
    SEPARATOR,
    TOTAL,
    UP,
    VISIT_CATEGORIES,
    feature_name,
    token,
)
from daymatrix.operators.prepare import with_region
from daymatrix.session import is_small

GLOBAL = "GLOBAL"
ALL_LEVELS = (GLOBAL, RS, UP)


def _with_place(df: DataFrame, level: str, selection: DataFrame | None) -> DataFrame:
    """Add the label a place has in feature names, null when it is not selected.

    Aliases are used as given; without a selection the place itself is cleaned.
    """
    column = "rs" if level == RS else "up"
    if selection is None:
        return df.withColumn(f"_{level}", C.geo_label(column, level))
    key = C.region(column) if level == RS else C.facility(column)
    pairs = selection.select(F.col("source").alias("_key"), F.col("alias").alias(f"_{level}"))
    return df.withColumn("_key", key).join(pairs, "_key", "left").drop("_key")


def _level_features(
    counted: DataFrame, name: Column, lookup, regions, facilities, levels, default_region: str
) -> DataFrame:
    """Fan counts ``(day, up, ..., n)`` out to the levels and sum per feature.

    Each level is a column with the end its feature names have, null where the
    place is not selected; unpivoting turns them into rows inside generated code.
    """
    ends = {}
    if GLOBAL in levels:
        ends[GLOBAL] = F.lit("")
    if RS in levels:
        if lookup is None:
            raise ValueError("the region level needs a facility lookup")
        counted = _with_place(with_region(counted, lookup, default_region), RS, regions)
    if UP in levels:
        counted = _with_place(counted, UP, facilities)
    for level in (RS, UP):
        if level in levels:
            place = F.col(f"_{level}")
            end = F.concat(F.lit(SEPARATOR + level + SEPARATOR), token(place))
            ends[level] = F.when(place.isNotNull(), end)
    columns = [e.alias(level) for level, e in ends.items()]
    placed = counted.select("day", "n", name.alias("_name"), *columns)
    by_level = placed.unpivot(["day", "n", "_name"], list(ends), "_level", "_end")
    named = by_level.where("_end IS NOT NULL").select(
        "day", F.concat("_name", "_end").alias("feature"), "n"
    )
    return named.groupBy("day", "feature").agg(F.sum("n").alias("value"))


def _place_keys(levels) -> list[str]:
    return ["up"] if RS in levels or UP in levels else []


def daily_total(df: DataFrame, domain: str = DEMAND, value: str | None = "counts") -> DataFrame:
    """Grand total per day.  Without the value column every row counts one."""
    amount = F.sum(value) if value and value in df.columns else F.count("*")
    return df.groupBy("day").agg(amount.alias("value")).select(
        "day", feature_name(domain, TOTAL).alias("feature"), "value"
    )


def visit_features(
    visits: DataFrame,
    lookup: DataFrame | None = None,
    regions: DataFrame | None = None,
    facilities: DataFrame | None = None,
    levels=ALL_LEVELS,
    domain: str = DEMAND,
    with_total: bool = True,
    default_region: str = C.UNSPECIFIED_REGION,
    value: str = "counts",
) -> DataFrame:
    """Long daily counts ``(day, feature, value)`` of cleaned visits.

    A selection restricts its own level only; the global level counts all rows.
    """
    variables = [c for c in VISIT_CATEGORIES if c in visits.columns]
    amount = F.col(value) if value in visits.columns else F.lit(1).cast("bigint")
    keys = ["day", *_place_keys(levels)]
    rows = visits.select(*keys, *variables, amount.alias("n"))
    if with_total:
        # the total is a variable without a category
        rows = rows.withColumn(TOTAL, F.lit(None).cast("string"))
        variables = [*variables, TOTAL]
    by_variable = rows.unpivot([*keys, "n"], variables, "variable", "category")
    counted = by_variable.groupBy(*keys, "variable", "category").agg(F.sum("n").alias("n"))
    name = feature_name(F.lit(domain), F.col("variable"), F.col("category"))
    return _level_features(
        counted, name, lookup, regions, facilities, levels, default_region
    )


def coded_features(
    counts: DataFrame,
    lookup: DataFrame | None = None,
    codes: DataFrame | None = None,
    regions: DataFrame | None = None,
    facilities: DataFrame | None = None,
    levels=ALL_LEVELS,
    domain: str = DIAGNOSIS,
    with_total: bool = True,
    small_codes: bool | None = None,
) -> DataFrame:
    """Long daily counts of ``(day, up, code, n)`` rows, raw or already counted.

    Totals count every code; the code selection limits the code features only.
    Without a selection there are totals and no code features.  ``small_codes`` says
    whether the selection was found small enough to be broadcast; by default it is counted.
    """
    keys = ["day", *_place_keys(levels)]
    names = {}
    if with_total:
        names["total"] = F.lit(TOTAL)
    if codes is not None:
        # A code in several groups yields several joined rows; the total must
        # count its rows once, so it rides on the first group only.
        first = F.min("alias").over(Window.partitionBy("code"))
        known = codes.select(
            "code",
            F.concat(F.lit(CODE_VARIABLE + SEPARATOR), token("alias")).alias("_group"),
            (F.col("alias") != first).alias("_repeated"),
        )
        small = is_small(codes) if small_codes is None else small_codes
        counts = counts.join(F.broadcast(known) if small else known, "code", "left")
        repeated = F.coalesce("_repeated", F.lit(False))
        names = {k: F.when(~repeated, name) for k, name in names.items()}
        names["group"] = F.col("_group")
    if not names:
        names["none"] = F.lit(None).cast("string")
    columns = [name.alias(k) for k, name in names.items()]
    named = counts.select(*keys, "n", *columns).unpivot(
        [*keys, "n"], list(names), "_kind", "name"
    )
    named = named.where("name IS NOT NULL")
    counted = named.groupBy(*keys, "name").agg(F.sum("n").alias("n"))
    name = F.concat(F.lit(domain + SEPARATOR), "name")
    return _level_features(counted, name, lookup, regions, facilities, levels, C.UNKNOWN)


def code_counts(counts: DataFrame, places: tuple[str, ...] = ()) -> DataFrame:
    """Counts per day, given place columns and code, before they are named."""
    return counts.groupBy("day", *places, "code").agg(F.sum("n").alias("n"))
