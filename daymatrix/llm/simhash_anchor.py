"""Near-duplicates by 64-bit SimHash, found with anchor points of a covering code.

Two fingerprints that differ in at most three bits differ in at most one bit of one
of their 32-bit halves.  The anchors of a half are the words of a perfect Hamming
code over 31 bits, times the last bit as it is: every half is within one bit (the
covering radius) of exactly one anchor, its home.  A half within one bit of another
is within 1 + 1 bits of that other's home.  So every fingerprint is listed at the
home of each half, replicated to all anchors within radius plus threshold (17 of the
2^27 of a half), and compared per anchor, homes with replicas.  No link is missed.

Equal fingerprints are one class before anything is replicated, so a group of copies
of any size costs one row here.  Comparing is a join condition: only links leave it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from daymatrix.llm.components import components
from daymatrix.llm.text import fresh, words
from daymatrix.session import is_small, materialize

SHINGLE = 3
SEED = 42
MAX_BITS = 3
SALTS = 16
_SLICE = 1 << 16  # shingles counted at once


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles, unsigned; 0 without words.
    A bit that half of the shingles set is 0."""
    w = words(text)
    if not w:
        return 0
    if len(w) < width:
        shingles = [b" ".join(w)]
    else:
        shingles = list(map(b" ".join, zip(*(w[i:] for i in range(width)))))
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(shingles), _SLICE):
        h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles[i : i + _SLICE]], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(shingles)).tobytes(), "big")


def fingerprint_column(text: Column, width: int = SHINGLE) -> Column:
    """The fingerprint as a (signed) bigint column."""

    @pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64))

    return of(text)


def _syndrome(half: Column) -> Column:
    """Position (1 to 31) of the bit that leads to the nearest code word, or 0."""
    parity = lambda j: F.bit_count(half.bitwiseAND(F.lit(_CHECK[j]))) % 2 * (1 << j)
    return reduce(lambda a, b: a + b, [parity(j) for j in range(5)])


#: Bits whose position (from 1) has bit j set.
_CHECK = [sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1) for j in range(5)]
_LAST = 1 << 31


def anchors(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Homes and replicas, both (half, anchor, fp), of a table of fingerprints ``fp``."""
    halves = prints.select(
        "fp",
        F.posexplode(F.array(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32))).alias("half", "x"),
    )
    halves = halves.withColumn("s", _syndrome(F.col("x")))
    flip = lambda x, p: x.bitwiseXOR(F.when(p > 0, F.call_function("shiftleft", F.lit(1).cast("long"), (p - 1).cast("int"))).otherwise(F.lit(0).cast("long")))
    halves = halves.withColumn("home", flip(F.col("x"), F.col("s")))
    x, s, home = F.col("x"), F.col("s"), F.col("home")
    pairs = F.filter(
        F.transform(F.sequence(F.lit(1), F.lit(31)), lambda i: F.struct(i.alias("i"), i.bitwiseXOR(s.cast("int")).alias("j"))),
        lambda p: (s > 0) & (p["i"] < p["j"]),
    )
    two = F.transform(pairs, lambda p: flip(flip(x, p["i"]), p["j"]))
    near = F.concat(F.array(home, home.bitwiseXOR(F.lit(_LAST))), two)
    return (
        halves.select("half", home.alias("anchor"), "fp"),
        halves.select("half", F.explode(near).alias("anchor"), "fp"),
    )


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in at most ``max_bits`` bits,
    each once; ``prints`` has distinct values ``fp``."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the anchors cover up to {MAX_BITS} differing bits")
    homes, replicas = anchors(prints)
    a, b = homes.withColumnRenamed("fp", "a"), replicas.withColumnRenamed("fp", "b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    # A pair may meet in both halves; it counts in the first that it is close in.
    close = F.bit_count(differ.bitwiseAND(F.lit(0xFFFFFFFF))) <= 1
    first = close == (F.col("half") == 0)
    return (
        a.join(b, ["half", "anchor"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(differ) <= max_bits) & first)
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, width: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits),
    component_id (smallest doc_id reachable over links).

    Texts without words, null ones included, have fingerprint zero and are linked as
    any other.  Repeated documents are reported each.  A document without an id gets
    the smallest id of its component, null if there is none.
    """
    prints = materialize(docs.select("doc_id", fingerprint_column(F.col("text"), width).alias("fp")), "prints")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "classes")
    roots = components(links(classes.select("fp"), max_bits), "a", "b")
    linked = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first", "n", "root"
    )
    # Of a class of its own with one document nothing has to be looked up.
    linked = linked.where("root IS NOT NULL OR n > 1").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    found = linked.join(least, "root").select(
        "fp", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salted = prints.withColumn("salt", F.coalesce(F.pmod("doc_id", F.lit(SALTS)), F.lit(0)).cast("int"))
    return salted.join(found, ["fp", "salt"], "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def first_of_groups(docs: DataFrame, max_bits: int = MAX_BITS, width: int = SHINGLE) -> DataFrame:
    """One row of every group of near-duplicates, columns unchanged: the one with the
    smallest id, rows without an id last.

    Rows are told apart even if they repeat an id or have none; of equal ids the first
    stored row stays.  Texts without words, null ones included, are one group.  An empty
    table stays empty.
    """
    columns = docs.columns
    row, fp = fresh(docs, "row"), fresh(docs, "fp")
    held = docs.withColumn(row, F.monotonically_increasing_id()).withColumn(fp, fingerprint_column(F.col("text"), width))
    held = materialize(held, "prints")
    rows = held.select(F.col(row).alias("row"), F.col("doc_id").alias("id"), F.col(fp).alias("fp"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("first")
    classes = materialize(rows.groupBy("fp").agg(first, F.count("*").alias("n")), "classes")
    roots = components(links(classes.select("fp"), max_bits), "a", "b")
    linked = classes.join(roots, classes.fp == roots.node, "left").where("root IS NOT NULL OR n > 1")
    linked = linked.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    best = linked.groupBy("root").agg(F.min("first").alias("best"))
    kept = linked.join(best, "root").select(
        "fp", F.col("best.row").alias("kept"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salted = rows.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
    gone = materialize(salted.join(kept, ["fp", "salt"]).where("row <> kept").select(F.col("row").alias(row)), "gone")
    gone = F.broadcast(gone) if is_small(gone) else gone
    return held.join(gone, row, "left_anti").select(columns)
