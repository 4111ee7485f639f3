"""The driver's tables in the roles of the facts, the lookup and the selections."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymatrix.operators.prepare import (
    clean_visits,
    day_code_counts,
    facility_lookup,
)
from daymatrix.operators.selection import code_selection, facility_selection, region_selection

AS_OF = date(2002, 1, 1)
NOW = datetime(2002, 1, 1, 6, 0, 0)
TARGET = date(2001, 12, 31)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text_days(df: DataFrame) -> DataFrame:
    """Days as ISO text, so that results compare the same everywhere."""
    days = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in days})


def rounded(df: DataFrame, column: str = "value") -> DataFrame:
    return df.withColumn(column, F.round(F.col(column).cast("double"), 6))


def unlisted(nation: str, balance: str) -> Column:
    """Facility code; places with a negative balance are not in the lookup."""
    return F.when(F.col(balance) < 0, F.col(nation) + 100).otherwise(F.col(nation)).cast("string")


def raw_visits(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as visits."""
    # Visit classes, some untidy, blank or absent.
    classes = ["C9C", " c9r", "CALTRE", "D9D", "dalTre ", "9T", "", None]
    pick = F.element_at(F.array(*map(F.lit, classes)), (F.col("o_custkey") % 8 + 1).cast("int"))
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    customers = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return joined.select(
        F.col("o_orderdate").alias("DATA_VISITA"),
        unlisted("c_nationkey", "c_acctbal").alias("UP"),
        F.col("o_orderstatus").alias("VISI_LLOC_VISITA"),
        F.col("c_mktsegment").alias("VISI_SITUACIO_VISITA"),
        F.col("o_orderpriority").alias("SERVEI_CODI"),
        pick.alias("TIPUS_CLASS"),
        F.lit("X").alias("VISI_TIPUS_VISITA"),
    )


def visits(spark: SparkSession, sf: str) -> DataFrame:
    return clean_visits(raw_visits(spark, sf))


def part_code(part: str, line: str) -> Column:
    """Invented code ``A00.1``."""
    number = F.lpad((F.col(part) % 100).cast("string"), 2, "0")
    letter = F.char(F.lit(65) + F.col(part) % 26)
    return F.concat(letter, number, F.lit("."), F.col(line).cast("string"))


def raw_coded(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as coded rows."""
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_partkey", "l_linenumber"
    )
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    joined = lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
    return joined.select(
        F.col("l_shipdate").alias("data_visita"),
        unlisted("s_nationkey", "s_acctbal").alias("up_c"),
        part_code("l_partkey", "l_linenumber").alias("problema_salut_c"),
    )


def coded(spark: SparkSession, sf: str) -> DataFrame:
    return day_code_counts(raw_coded(spark, sf))


def lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as facilities of regions."""
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    joined = nations.join(regions, nations.n_regionkey == regions.r_regionkey)
    raw = joined.select(
        F.col("n_nationkey").cast("string").alias("Codi UP"), F.lower("r_name").alias("RS"), "n_nationkey"
    )
    return facility_lookup(raw, order="n_nationkey")


def chosen_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Regions whose name starts with A, under an untidy alias."""
    regions = table(spark, sf, "region").where(F.col("r_name").startswith("A"))
    raw = regions.select(
        F.concat(F.lit("rs-"), "r_regionkey", F.lit(" ")).alias("geo_id"),
        F.lower("r_name").alias("RS"),
    )
    return region_selection(raw, "geo_id")


def chosen_facilities(spark: SparkSession, sf: str) -> DataFrame:
    """Nations of the first region, under an alias."""
    nations = table(spark, sf, "nation").where("n_regionkey = 0")
    raw = nations.select(
        F.concat(F.lit("micro "), "n_nationkey").alias("geo_id"),
        F.col("n_nationkey").cast("string").alias("UP"),
        F.col("n_name").alias("name"),
    )
    return facility_selection(raw, "name")


# Code groups; one code may be in several.
CODE_GROUPS = [
    ("J00-J06", "G01"),
    ("J09-J18", "g 01"),
    ("A00-A09", "G03"),
    ("F30-F4", "G04"),
    ("M00-N99", "G05"),
    ("J00", "D01"),
    ("A09", "D04"),
    ("U07.1", None),
]


def chosen_codes(spark: SparkSession) -> DataFrame:
    rows = [
        F.struct(F.lit(spec).alias("ICD10_3"), F.lit(group).alias("feature_name"))
        for spec, group in CODE_GROUPS
    ]
    return code_selection(spark.range(1).select(F.inline(F.array(*rows))))
