"""Feature names: ``DOMAIN__VARIABLE[__CATEGORY][__RS|UP__GEO]``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymatrix.functions.cleaning import UNKNOWN, blank_to_null, geo_label
from daymatrix.model import CONTROL_COLUMNS, DAY, FEATURE, VALUE

# Parts of the naming grammar.
SEPARATOR = "__"
DEMAND = "DEMAND"
DIAGNOSIS = "DIAGNOSIS"
TOTAL = "TOTAL"
CODE_VARIABLE = "ICD10_3"
RS = "RS"
UP = "UP"
VISIT_CATEGORIES = [
    "VISI_LLOC_VISITA",
    "VISI_SITUACIO_VISITA",
    "SERVEI_CODI",
    "TIPUS_CLASS",
    "TIPUS_VISITA_AGRUPAT",
]


def token(c: Column | str) -> Column:
    """One part of a name: blank becomes ``UNKNOWN``, no inner separator."""
    cleaned = F.replace(blank_to_null(c), F.lit(SEPARATOR), F.lit("_"))
    return F.coalesce(cleaned, F.lit(UNKNOWN))


def feature_name(
    domain: Column | str,
    variable: Column | str,
    category: Column | None = None,
    level: Column | str | None = None,
    geo: Column | None = None,
) -> Column:
    """Join the parts.  Text arguments are literals, columns may be null: a null
    category or level leaves that part out."""

    def part(p):
        return F.lit(p) if isinstance(p, str) else p

    parts = [token(part(domain)), token(part(variable))]
    if category is not None:
        parts.append(F.when(category.isNotNull(), token(category)))
    if level is not None:
        level = part(level)
        parts.append(F.when(level.isNotNull(), token(level)))
        parts.append(F.when(level.isNotNull(), token(geo)))
    return F.concat_ws(SEPARATOR, *parts)


def _rule(name: Column, pattern: str, variable, category=None, level=None, geo=None) -> Column:
    """Parts of a name that matches ``pattern``, else null.  A part is a captured
    group number, a literal or absent."""

    def part(p):
        if isinstance(p, int):
            return F.regexp_extract(name, pattern, p)
        return F.lit(p).cast("string")

    parts = {"variable": variable, "category": category, "level": level, "geo": geo}
    return F.when(name.rlike(pattern), F.struct(*[part(p).alias(k) for k, p in parts.items()]))


def _older_names(name: Column, domain: str) -> list[Column]:
    """The older naming schemes, first match wins."""
    if domain == DEMAND:
        variables = "|".join(VISIT_CATEGORIES)
        return [
            _rule(name, r"^(DEMANDA_TOTAL|demanda__TOTAL_CAT)$", TOTAL),
            _rule(name, r"(?i)^demanda__TOTAL_(RS|UP)_(.+)$", TOTAL, None, 1, 2),
            _rule(name, r"(?i)^demanda__(.+?)__(.+)$", 1, 2),
            # facility: the last _UP_ separates category and place
            _rule(name, rf"^demanda_({variables})_(.*)_UP_(.*)$", 1, 2, UP, 3),
            # region: the first _RS_ separates them, RS_ stays in the place
            _rule(name, rf"^demanda_({variables})_(.*?)_(RS_.*)$", 1, 2, RS, 3),
            # any other region: the last underscore separates them
            _rule(name, rf"^demanda_({variables})_(.*)_(.*)$", 1, 2, RS, 3),
        ]
    if domain == DIAGNOSIS:
        return [
            _rule(name, r"^(DIAG_TOTAL|TOTAL)$", TOTAL),
            _rule(name, r"(?i)^(?:DIAG_)?TOTAL__(RS|UP)__(.+)$", TOTAL, None, 1, 2),
            _rule(name, r"(?i)^DIAG_TOTAL_(RS|UP)_(.+)$", TOTAL, None, 1, 2),
            # before the plain code form, which would also match it
            _rule(name, r"^ICD10_3__(.+)__(RS|UP)__(.+)$", CODE_VARIABLE, 1, 2, 3),
            _rule(name, r"^(?:DIAG_CODE|ICD10_3)_(.+)$", CODE_VARIABLE, 1),
        ]
    return []


def with_canonical_name(names: DataFrame, domain: str, column: str = "name") -> DataFrame:
    """Add ``canonical``: the current name of features stored under an older
    naming scheme.  Current names, ``timestamp`` and unknown names stay as they
    are.  Meant for a table of distinct names."""
    name = F.col(column)
    keep = (name == "timestamp") | name.startswith(domain + SEPARATOR)
    rules = _older_names(name, domain)
    if not rules:
        return names.withColumn("canonical", name)
    parts = names.withColumn("_parts", F.when(~keep, F.coalesce(*rules)))
    level, geo = F.upper("_parts.level"), F.col("_parts.geo")
    place = F.when(level == UP, geo_label(geo, UP)).otherwise(geo_label(geo, RS))
    current = feature_name(
        domain, F.col("_parts.variable"), F.col("_parts.category"), level, place
    )
    found = F.col("_parts").isNotNull()
    return parts.withColumn("canonical", F.when(found, current).otherwise(name)).drop("_parts")


def canonicalize_features(values: DataFrame, domain: str) -> DataFrame:
    """Current names for the features of a long table; equal names are summed.

    Names are parsed once per distinct feature and joined back.
    """
    names = with_canonical_name(values.select(FEATURE).distinct(), domain, FEATURE)
    renamed = values.join(names, FEATURE).drop(FEATURE).withColumnRenamed("canonical", FEATURE)
    return renamed.groupBy(DAY, FEATURE).agg(F.sum(VALUE).alias(VALUE))


def canonical_columns(df: DataFrame, domain: str) -> dict[str, str]:
    """Current name of every column.  Concerns the schema only: one row each."""
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "name string")
    return dict(with_canonical_name(names, domain).collect())


def join_name(domain: str, prefix: str | None = None) -> Column:
    """Feature name in a join: names of the domain stay, others get a prefix."""
    name = F.col(FEATURE)
    known = name.startswith(domain + SEPARATOR)
    return F.when(known, name).otherwise(F.concat(F.lit(f"{prefix or domain}_"), name))


def rename_columns(
    df: DataFrame, domain: str, prefix: str | None = None, keys: tuple[str, ...] = ("timestamp",)
) -> DataFrame:
    """Rename the columns of a wide frame for a join: the current name, else
    ``PREFIX_column``."""
    renamed = {}
    for column, name in canonical_columns(df, domain).items():
        if column not in keys:
            known = name.startswith(domain + SEPARATOR)
            renamed[column] = name if known else f"{prefix or domain}_{column}"
    return df.withColumnsRenamed(renamed)


def control_columns(columns: list[str]) -> list[str]:
    """Columns of a wide frame that carry imputation control values."""
    return [c for c in columns if any(c.endswith(s) for s in CONTROL_COLUMNS)]
