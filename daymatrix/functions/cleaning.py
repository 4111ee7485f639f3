"""Column expressions that clean raw facts.  All of them stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "UNKNOWN"
NOT_AVAILABLE = "NA"

# The label of visits without a region, and the raw spelling of it.
UNSPECIFIED_REGION_RAW = "SENSEESPECIFICAR_SE"
UNSPECIFIED_REGION = "RS:SENSEESPECIFICAR_SE"

# Visit class to grouped visit type.
CLASS_GROUPS = {
    "PRESENCIAL": ["C9C", "C9R", "CALTRE"],
    "DOMICILIARIA": ["D9D", "DALTRE"],
    "TELEFONICA": ["9T"],
}

FACILITY_WIDTH = 5
WHITESPACE = " \t\r\n"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """Text without surrounding white space."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def stored_text(c: Column | str) -> Column:
    """The same as ``text`` for stored columns of raw facts.

    Trimming a set of characters costs many times a plain trim, so it is kept
    for the rare texts that hold a tab or a line break.  The column is named
    several times, hence only for stored columns, not for nested expressions.
    """
    raw = _col(c).cast("string")
    unusual = raw.contains("\t") | raw.contains("\n") | raw.contains("\r")
    return F.when(unusual, F.btrim(raw, F.lit(WHITESPACE))).otherwise(F.trim(raw))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(text(c), F.lit(""))


# Parts of a date format, and what stands for them in ISO.
_DATE_PARTS = {"yyyy": r"(\d{4})", "MM": r"(\d{1,2})", "dd": r"(\d{1,2})", "HH": r"(\d{1,2})", "mm": r"(\d{1,2})", "ss": r"(\d{1,2})"}


def _iso_rule(date_format: str) -> tuple[str, str]:
    """Pattern of a format like ``dd/MM/yyyy HH:mm``, and the ISO text made of its parts."""
    parts = re.split("(" + "|".join(_DATE_PARTS) + ")", date_format)
    order = [p for p in parts if p in _DATE_PARTS]
    if sorted(order) != sorted(set(order)) or not {"yyyy", "MM", "dd"} <= set(order):
        raise ValueError(f"a date format names yyyy, MM and dd once each, not {date_format!r}")
    pattern = "".join(_DATE_PARTS.get(p) or re.escape(p) for p in parts)
    group = {p: f"${order.index(p) + 1}" for p in order}
    clock = ":".join(group.get(p, "00") for p in ("HH", "mm", "ss"))
    return rf"^\s*{pattern}\s*$", f"{group['yyyy']}-{group['MM']}-{group['dd']} {clock}"


def to_day(c: Column | str, data_type: T.DataType | None = None, formats: Sequence[str] = ()) -> Column:
    """Calendar day of a date, timestamp or text; unreadable text becomes null.

    Text is read as ISO first and then by the given formats, in order: ``yyyy``, ``MM``,
    ``dd``, ``HH``, ``mm``, ``ss`` and what stands between them.
    """
    if not isinstance(data_type, T.StringType) and data_type is not None:
        return F.to_date(_col(c))
    raw = _col(c).cast("string")
    readings = [raw.try_cast("timestamp_ntz")]
    for pattern, iso in map(_iso_rule, formats):
        readings.append(F.when(raw.rlike(pattern), F.regexp_replace(raw, pattern, iso).try_cast("timestamp_ntz")))
    return F.to_date(F.coalesce(*readings))


def number(c: Column | str) -> Column:
    """Number of a value; unreadable text becomes null."""
    return _col(c).try_cast("double")


def facility(c: Column | str) -> Column:
    """Facility code: trimmed and zero-padded to five characters.

    A fixed length would cut longer codes.
    """
    return _padded(stored_text(c))


def _padded(code: Column) -> Column:
    return F.lpad(code, F.greatest(F.length(code), F.lit(FACILITY_WIDTH)), "0")


def region(c: Column | str) -> Column:
    return F.upper(text(c))


def category(c: Column | str) -> Column:
    """Category label: trimmed, null and blank become ``NA``."""
    return F.coalesce(F.nullif(stored_text(c), F.lit("")), F.lit(NOT_AVAILABLE))


def visit_class(c: Column | str) -> Column:
    return F.upper(category(c))


def visit_class_group(c: Column | str) -> Column:
    """Grouped visit type of a cleaned visit class."""
    label = _col(c)
    group = F.lit(NOT_AVAILABLE)
    for name, classes in CLASS_GROUPS.items():
        group = F.when(label.isin(classes), F.lit(name)).otherwise(group)
    return group


def region_or_default(c: Column | str, default: str) -> Column:
    """Fill an unknown region; the raw "unspecified" label gets its full form."""
    raw = _col(c)
    return (
        F.when(raw.isNull(), F.lit(default))
        .when(raw == UNSPECIFIED_REGION_RAW, F.lit(UNSPECIFIED_REGION))
        .otherwise(raw)
    )


def code3(c: Column | str) -> Column:
    """First three characters of a trimmed, upper-cased code; blank is null."""
    return F.nullif(F.upper(F.substring(stored_text(c), 1, 3)), F.lit(""))


def geo_label(c: Column | str, level: str) -> Column:
    """Geographic label for feature names: RS upper-cased, UP zero-padded."""
    label = F.coalesce(blank_to_null(c), F.lit(UNKNOWN))
    if level == "RS":
        return F.upper(label)
    if level == "UP":
        return _padded(label)
    return label


def alias(c: Column | str, fallback: Column | str) -> Column:
    """Stable name token: runs of other characters become one ``_``, upper case."""
    token = F.regexp_replace(text(c), "[^0-9A-Za-z]+", "_")
    token = F.upper(F.btrim(token, F.lit("_")))
    return F.coalesce(F.nullif(token, F.lit("")), _col(fallback))


def flag(c: Column | str, data_type: T.DataType | None = None) -> Column:
    """Boolean of a flag column stored as boolean or as text."""
    if isinstance(data_type, T.BooleanType):
        return F.coalesce(_col(c), F.lit(False))
    # Texts that mean true.
    truthy = F.lower(text(c)).isin("true", "1", "yes", "y")
    return F.coalesce(truthy, F.lit(False))
