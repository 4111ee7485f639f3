"""Keep-last deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last one in ``order``.  ``order`` columns are dropped
    unless they are keys.

    An aggregate rather than a ranking window: each map task keeps one row per
    key before the shuffle, so a key that owns a third of all rows costs no more
    than any other.  Null keys form one group.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    last = F.max_by(F.struct(*rest) if rest else F.lit(0), F.struct(*order))
    out = df.groupBy(*keys).agg(last.alias("_last"))
    return out.select(*keys, *[F.col("_last")[c].alias(c) for c in rest])


def stored_order(df: DataFrame) -> Column:
    """The order in which rows are stored: file, part of the file, row.

    ``df`` must be a scan or rows made from local data, filtered, projected or coalesced at most.
    Other frames have no order of their own: which row comes last would depend on the
    plan, so they are refused.
    """
    plan = df._jdf.queryExecution().analyzed()
    row = F.monotonically_increasing_id()
    metadata = plan.metadataOutput()
    if any(metadata.apply(i).name() == "_metadata" for i in range(metadata.size())):
        meta = F.col("_metadata")
        return F.struct(meta["file_name"].alias("file"), meta["file_block_start"].alias("part"), row.alias("row"))
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias") or plan.nodeName() == "Repartition" and not plan.shuffle():
        plan = plan.children().head()
    if plan.nodeName() not in ("LocalRelation", "LogicalRDD"):
        raise ValueError("rows of a derived frame have no order: name a column that gives it")
    return F.struct(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("part"), row.alias("row"))
