"""Selections: which regions, facilities and code groups get columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymatrix.functions import cleaning as C
from daymatrix.functions.codes import code_at, code_bounds, codes_between
from daymatrix.operators.dedup import keep_last, stored_order
from daymatrix.session import held

# Accepted column names of a geographic selection.
_SOURCE_NAMES = ["rs", "up", "value", "source_value"]
_ALIAS_NAMES = ["geo_id", "id", "subset_id"]
# Fixed value: column that names the group of a code selection.
_GROUP_NAME = "feature_name"


def _named(df: DataFrame, names: list[str]) -> str | None:
    by_name = {c.strip().lower(): c for c in df.columns}
    return next((by_name[n] for n in names if n in by_name), None)


def geo_selection(
    selection: DataFrame, normalize: Callable[[Column], Column], order: str | None = None
) -> DataFrame:
    """Clean selection ``(source, alias)``, one row per source value.

    The source column is found by name, else it is the second; the alias column
    is found by name, else it is the first.  Of several rows for one source the
    last in ``order`` wins; without ``order`` the rows count as they are stored, so the
    frame must be a scan or local rows.
    """
    columns = [c for c in selection.columns if c != order]
    source = _named(selection, _SOURCE_NAMES) or columns[min(1, len(columns) - 1)]
    alias = _named(selection, _ALIAS_NAMES) or (columns[0] if len(columns) > 1 else source)
    position = F.col(order) if order else stored_order(selection)
    cleaned = selection.select(
        F.nullif(normalize(F.col(f"`{source}`")), F.lit("")).alias("source"),
        F.col(f"`{alias}`").alias("_alias"),
        position.alias("_order"),
    ).where("source IS NOT NULL")
    named = cleaned.withColumn("alias", C.alias("_alias", "source")).drop("_alias")
    return keep_last(named, ["source"], ["_order"])


def region_selection(selection: DataFrame, order: str | None = None) -> DataFrame:
    return geo_selection(selection, C.region, order)


def facility_selection(selection: DataFrame, order: str | None = None) -> DataFrame:
    return geo_selection(selection, C.facility, order)


def non_empty(selection: DataFrame | None) -> DataFrame | None:
    """A selection without usable rows counts as none: everything is kept.

    The clean rows are computed once, so their true size decides how they join.
    """
    if selection is None:
        return None
    stored = held(selection, "selection")
    return None if stored.isEmpty() else stored


def keep_selected(
    df: DataFrame,
    column: str,
    selection: DataFrame | None,
    normalize: Callable[[Column], Column],
) -> DataFrame:
    """Keep the rows whose value is selected and replace it by its alias.

    Without a selection, or with an empty one, every row is kept as it is.
    """
    if selection is None or selection.isEmpty():
        return df
    keyed = df.withColumn("_source", normalize(F.col(column)))
    joined = keyed.join(selection.withColumnRenamed("source", "_source"), "_source")
    return joined.withColumn(column, F.col("alias")).select(*df.columns)


def code_selection(selection: DataFrame) -> DataFrame:
    """Distinct ``(code, alias)`` pairs of a code selection.

    The first column holds codes or ranges.  The group name comes from
    ``feature_name``; a blank one falls back to the first code of its row, and
    without that column every code stands for itself.
    """
    spec = F.col(f"`{selection.columns[0]}`")
    group = _named(selection, [_GROUP_NAME])
    rows = selection.select(
        code_bounds(spec).alias("codes"),
        (F.col(f"`{group}`") if group else F.lit(None).cast("string")).alias("group"),
    )
    single, first, last = F.col("codes.single"), F.col("codes.first"), F.col("codes.last")
    rows = rows.where(single.isNotNull() | first.isNotNull())
    # one alias per specification, before it becomes many rows
    lowest = F.coalesce(single, code_at(first))
    alias = C.alias("group", lowest) if group else F.lit(None).cast("string")
    named = rows.select(single.alias("code"), first.alias("first"), last.alias("last"), alias.alias("alias"))
    # a range per alias and first code, less what ranges before it hold
    ranges = named.where("code IS NULL").groupBy("alias", "first").agg(F.max("last").alias("last"))
    before = Window.partitionBy("alias").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    start = F.greatest("first", F.max("last").over(before) + 1)
    apart = ranges.withColumn("first", start).where("first <= last")
    codes = apart.select(F.explode(codes_between("first", "last")).alias("code"), "alias")
    singles = named.where("code IS NOT NULL").select("code", "alias")
    found = codes.unionByName(singles).distinct()
    return found if group else found.withColumn("alias", F.col("code"))


def expand_code_aliases(
    df: DataFrame, selection: DataFrame | None, column: str = "code"
) -> DataFrame:
    """One row per input row and group its code belongs to; the group replaces
    the code.  Without a selection there is no code-specific output."""
    if selection is None:
        return df.where(F.lit(False))
    pairs = selection.withColumnRenamed("code", column)
    return df.join(pairs, column).withColumn(column, F.col("alias")).select(*df.columns)
