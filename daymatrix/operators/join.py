"""Joins of two matrices or of two wide frames."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.functions.naming import DEMAND, DIAGNOSIS, join_name, rename_columns
from daymatrix.model import DAY, FEATURE, DailyMatrix, broadcast_days
from daymatrix.operators.dedup import keep_last, stored_order
from daymatrix.operators.fill import apply_weights, fill_weights
from daymatrix.operators.prepare import drop_future_rows
from daymatrix.session import held


def join_matrices(
    left: DailyMatrix,
    right: DailyMatrix,
    as_of: date,
    fill: str | None = "ffill",
    domains: tuple[str, str] = (DEMAND, DIAGNOSIS),
    prefixes: tuple[str, str] | None = None,
) -> DailyMatrix:
    """Full outer join by day; days one side lacks are filled.

    Values that cannot be filled are zero.  The control columns of each side
    appear as ``PREFIX_<control>`` and are filled along with the values by
    ``ffill`` and ``bfill``; a line cannot be drawn through them.
    """
    prefixes = prefixes or domains
    left, right = (DailyMatrix(m.values, held(m.days, "days")) for m in (left, right))
    if left.days.isEmpty() or right.days.isEmpty():
        raise ValueError("both matrices need at least one day")
    all_days = held(left.days.select(DAY).union(right.days.select(DAY)).distinct(), "all-days")
    values, joined_days = [], all_days
    for side, domain, prefix in zip((left, right), domains, prefixes):
        weights = held(fill_weights(all_days, side.days.select(DAY), fill), "weights")
        filled = apply_weights(side.values, weights, fill)
        values.append(filled.withColumn(FEATURE, join_name(domain, prefix)))
        source = weights.where(F.col("source") == F.col(DAY)) if fill == "interpolate" else weights
        controls = side.days.withColumnsRenamed(
            {c: f"{prefix}_{c}" for c in side.days.columns if c != DAY}
        ).withColumnRenamed(DAY, "source")
        controls = source.join(broadcast_days(controls), "source").drop("source", "weight")
        joined_days = joined_days.join(broadcast_days(controls), DAY, "left")
    joined = DailyMatrix(values[0].unionByName(values[1]), joined_days)
    return joined.select_days(F.col(DAY) <= F.lit(as_of))


def _outer(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join in which null keys match."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    )
    joined = left.join(renamed, condition, "full_outer")
    return joined.select(
        *[F.coalesce(left[k], renamed[f"_right_{k}"]).alias(k) for k in keys],
        *[left[f"`{c}`"] for c in left.columns if c not in keys],
        *[renamed[f"`{c}`"] for c in right.columns if c not in keys],
    )


def join_incremental(
    left: DataFrame,
    right: DataFrame,
    order: list[str],
    key: str = "timestamp",
    domains: tuple[str, str] = (DEMAND, DIAGNOSIS),
    prefixes: tuple[str, str] | None = None,
) -> DataFrame:
    """Join staged wide rows by their key: the last row per key of each side, no
    filling, no future filter."""
    prefixes = prefixes or domains
    sides = [
        rename_columns(keep_last(side, [key], order), domain, prefix, (key,))
        for side, domain, prefix in zip((left, right), domains, prefixes)
    ]
    return _outer(*sides, [key])


def union_in_order(pieces: list[DataFrame], order: list[str] | None = None):
    """Union by name of pieces in the given order.

    Returns the union and the columns that give the order of its rows: piece
    number first, then ``order`` or else the row position within the piece.
    """
    inner = order or ["_row"]
    numbered = []
    for number, piece in enumerate(pieces):
        if order is None:
            piece = piece.withColumn("_row", stored_order(piece))
        numbered.append(piece.withColumn("_piece", F.lit(number)))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    return union, ["_piece", *inner]


def merge_on_keys(
    left: list[DataFrame],
    right: list[DataFrame],
    as_of: date,
    keys: list[str] | None = None,
    timestamp: str = "timestamp",
    order: list[str] | None = None,
    right_prefix: str = "DIAG_",
) -> DataFrame:
    """Merge pieces of two sides on arbitrary keys.

    Each side is the union of its pieces, the last row per key wins; the other
    columns of the right side get a prefix, rows after ``as_of`` are dropped.
    """
    keys = keys or [timestamp]
    if not left or not right:
        raise ValueError("both sides need at least one piece")
    sides = [keep_last(union, keys, by) for union, by in (union_in_order(s, order) for s in (left, right))]
    first = sides[0]
    second = sides[1].withColumnsRenamed(
        {c: f"{right_prefix}{c}" for c in sides[1].columns if c not in keys}
    )
    both = (set(first.columns) & set(second.columns)) - set(keys)
    first = first.withColumnsRenamed({c: f"{c}_demand" for c in both})
    second = second.withColumnsRenamed({c: f"{c}_diagnosis" for c in both})
    merged = _outer(first, second, keys)
    return drop_future_rows(merged, timestamp, as_of) if timestamp in merged.columns else merged
