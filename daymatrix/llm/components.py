"""Connected components of a link table, by alternating star contraction.

Every round joins the links with the smallest neighbour of each node; nothing but
two numbers per round reaches the driver.  Each round is written to the shared
folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.session import materialize


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
    ).first()
    return row.n, row.x


def _to_smallest(links: DataFrame, both_ways: bool) -> DataFrame:
    """Links of each node's neighbours to the smallest of the node and them.

    ``both_ways``: larger neighbours of every node are relinked; otherwise every node
    and its smaller neighbours are.
    """
    around = links.select("u", "v")
    if both_ways:
        around = around.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = around.join(least, "u")
    if both_ways:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) of every linked node, root being the smallest node reachable.

    Links with a null end are ignored; repeated links and self-links do not count; no
    links give no rows.
    """
    pairs = links.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v"),
        (F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right))).alias("ok"),
    ).where("ok").select("u", "v").distinct()
    pairs = materialize(pairs, "links")
    state = _state(pairs)
    while state[0]:
        pairs = materialize(_to_smallest(_to_smallest(pairs, True), False), "links")
        before, state = state, _state(pairs)
        if before == state:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
