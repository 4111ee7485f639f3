"""Row identities of staged rows."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that identify a row besides its time, after the code column.
_IDENTITY_COLUMNS = [
    "DIAG_DIAG_CODE",
    "UP",
    "RS",
    "DIAG_UP",
    "DIAG_up_c",
    "DIAG_RS",
]


def with_row_identity(
    df: DataFrame, timestamp: str = "timestamp", code: str = "DIAG_CODE"
) -> DataFrame:
    """Add ``data_id``: the day and the identifying columns that exist, joined by
    ``_``; without any, a short hash of the other column names takes their place."""
    names = list(dict.fromkeys([code, f"DIAG_{code}", *_IDENTITY_COLUMNS]))
    parts = [c for c in names if c in df.columns]
    day = F.date_format(timestamp, "yyyy-MM-dd")
    if parts:
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in parts]
        return df.withColumn("data_id", F.concat_ws("_", day, *texts))
    others = sorted(c for c in df.columns if c not in (timestamp, "data_id"))
    signature = hashlib.md5("|".join(others).encode()).hexdigest()[:8]
    return df.withColumn("data_id", F.concat_ws("_", day, F.lit(signature)))
