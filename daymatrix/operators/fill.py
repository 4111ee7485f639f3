"""Filling gaps: forward, backward and linear."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymatrix.model import DAY, FEATURE, VALUE, broadcast_days

# Width of a block of a long series where none is given: days, or units of a number.
DAYS_A_BLOCK = 4096
METHODS = ("ffill", "bfill", "interpolate", None)


def _check(method: str | None) -> None:
    if method not in METHODS:
        raise ValueError(f"fill method must be one of {METHODS}, not {method!r}")


def fill_nulls(
    df: DataFrame, keys: list[str], order: str, columns: list[str], method: str | None, block: int | None = None
) -> DataFrame:
    """Fill null cells of a keyed series in the order of ``order``.

    ``ffill`` repeats the last value, ``bfill`` the next one, ``interpolate``
    draws a line between both by row position (not by date); after the last
    value a line continues flat, before the first one nulls stay.

    A series is filled in blocks of ``block`` days, seconds or units of ``order``: each
    block knows the last value before it and the first one behind it, so one long series
    is many window partitions.  A column of another type gives one block per key.
    """
    _check(method)
    if method is None:
        return df
    inner = Window.partitionBy(*keys, "_block").orderBy(order)
    numbered = df.withColumn("_block", _block(df, order, block)).withColumn("_pos", F.row_number().over(inner))
    around = _around_blocks(numbered, keys, columns)
    same = reduce(
        lambda a, b: a & b, [numbered[k].eqNullSafe(around[f"_key_{i}"]) for i, k in enumerate(keys)],
        numbered["_block"] == around["_at"],
    )
    joined = numbered.join(around, same).withColumn("_pos", F.col("_pos") + F.col("_start"))
    before = inner.rowsBetween(Window.unboundedPreceding, 0)
    after = inner.rowsBetween(0, Window.unboundedFollowing)
    filled = {}
    for i, c in enumerate(columns):
        point = F.when(F.col(c).isNotNull(), F.struct("_pos", F.col(c).alias("v")))
        left = F.coalesce(F.last(point, ignorenulls=True).over(before), F.col(f"_left_{i}"))
        right = F.coalesce(F.first(point, ignorenulls=True).over(after), F.col(f"_right_{i}"))
        if method == "interpolate":
            filled[c] = F.coalesce(F.col(c).cast("double"), _line(left, right, F.col("_pos")))
        else:
            filled[c] = left["v"] if method == "ffill" else right["v"]
    return joined.withColumns(filled).select(*[f"`{c}`" for c in df.columns])


def _block(df: DataFrame, order: str, width: int | None) -> Column:
    """Number of the block a row belongs to, growing with ``order``."""
    kind, column = df.schema[order].dataType, F.col(order)
    if isinstance(kind, T.DateType):
        number = F.floor(F.unix_date(column) / (width or DAYS_A_BLOCK))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        number = F.floor(F.unix_seconds(column.cast("timestamp")) / (width or 86_400 * DAYS_A_BLOCK))
    elif isinstance(kind, T.IntegralType):
        number = F.floor(column / (width or DAYS_A_BLOCK))
    else:
        number = F.lit(0)
    return F.coalesce(number.cast("bigint"), F.lit(-(1 << 62)))  # rows without a place come first


def _around_blocks(numbered: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per key and block: the rows before it, and of every column the last value before it
    and the first one behind it, with their positions in the series."""
    ends = [F.count("*").alias("_rows")]
    for i, c in enumerate(columns):
        point, place = F.struct("_pos", F.col(c).alias("v")), F.when(F.col(c).isNotNull(), F.col("_pos"))
        ends += [F.min_by(point, place).alias(f"_first_{i}"), F.max_by(point, place).alias(f"_last_{i}")]
    named = [F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]
    blocks = numbered.groupBy(*named, F.col("_block").alias("_at")).agg(*ends)
    ordered = Window.partitionBy(*[f"_key_{i}" for i in range(len(keys))]).orderBy("_at")
    earlier, later = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(1, Window.unboundedFollowing)
    blocks = blocks.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))

    def placed(name):
        place = F.struct((F.col(name)["_pos"] + F.col("_start")).alias("_pos"), F.col(name)["v"].alias("v"))
        return F.when(F.col(name).isNotNull(), place)

    found = {}
    for i in range(len(columns)):
        found[f"_left_{i}"] = F.last(placed(f"_last_{i}"), ignorenulls=True).over(earlier)
        found[f"_right_{i}"] = F.first(placed(f"_first_{i}"), ignorenulls=True).over(later)
    return blocks.select(*[c for c in blocks.columns if c.startswith(("_key_", "_at", "_start"))], *[v.alias(k) for k, v in found.items()])


def _line(left: Column, right: Column, pos: Column) -> Column:
    share = (pos - left["_pos"]) / (right["_pos"] - left["_pos"])
    low, high = left["v"].cast("double"), right["v"].cast("double")
    between = low + (high - low) * share
    return F.when(right.isNull(), low).otherwise(between)


def fill_weights(all_days: DataFrame, present: DataFrame, method: str | None) -> DataFrame:
    """How to make up a day from present ones: ``(source, day, weight)``.

    A present day is itself.  An absent one is its predecessor (``ffill``), its
    successor (``bfill``) or a weighted sum of both (``interpolate``), counted
    in positions among ``all_days``.  Days that cannot be filled get no row.

    Filling whole days this way needs a window over the day table only, at most
    one row per calendar day, instead of one over every feature.
    """
    _check(method)
    itself = present.select(
        F.col(DAY).alias("source"), F.col(DAY), F.lit(1.0).alias("weight")
    )
    if method is None:
        return itself
    marked = all_days.select(DAY).join(
        broadcast_days(present.select(DAY, F.lit(True).alias("_present"))), DAY, "left"
    )
    ordered = Window.orderBy(DAY)
    before = ordered.rowsBetween(Window.unboundedPreceding, 0)
    after = ordered.rowsBetween(0, Window.unboundedFollowing)
    placed = marked.withColumn("_pos", F.row_number().over(ordered))
    point = F.when(F.col("_present"), F.struct("_pos", DAY))
    placed = placed.withColumns(
        {
            "_left": F.last(point, ignorenulls=True).over(before),
            "_right": F.first(point, ignorenulls=True).over(after),
        }
    )
    absent = placed.where("_present IS NULL")
    left, right = F.col("_left"), F.col("_right")

    def share(source, weight):
        return F.struct(source.alias("source"), weight.cast("double").alias("weight"))

    if method == "ffill":
        shares = [share(left[DAY], F.lit(1))]
    elif method == "bfill":
        shares = [share(right[DAY], F.lit(1))]
    else:
        span = right["_pos"] - left["_pos"]
        to_right = (F.col("_pos") - left["_pos"]) / span
        flat = right.isNull()
        shares = [
            share(left[DAY], F.when(flat, F.lit(1)).otherwise(1 - to_right)),
            share(F.when(left.isNotNull(), right[DAY]), to_right),
        ]
    filled = absent.select(DAY, F.inline(F.array(*shares)))
    usable = filled.where("source IS NOT NULL AND weight IS NOT NULL")
    return itself.unionByName(usable.select("source", DAY, "weight"))


def apply_weights(values: DataFrame, weights: DataFrame, method: str | None) -> DataFrame:
    """Long values of all days that ``weights`` makes up.

    Present days are taken as they are.  The few days that others are made of, at the end
    of the shorter side a single one, are first dealt by feature: what one task multiplies
    is its share of the features, not a whole day.
    """
    itself = F.col("source") == F.col(DAY)
    present = values.join(broadcast_days(weights.where(itself).select(DAY)), DAY, "left_semi")
    present = present.select(DAY, FEATURE, VALUE)
    if method is None:
        return present
    absent = weights.where(~itself)
    sources = values.withColumnRenamed(DAY, "source").join(
        broadcast_days(absent.select("source").distinct()), "source", "left_semi"
    )
    # A fixed number: partitions small enough to be merged would be multiplied as one.
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = sources.repartition(tasks, FEATURE).join(broadcast_days(absent), "source")
    made = made.select(DAY, FEATURE, (F.col(VALUE) * F.col("weight")).alias(VALUE))
    if method == "interpolate":
        made = made.groupBy(DAY, FEATURE).agg(F.sum(VALUE).alias(VALUE))
    return present.unionByName(made)
