"""Helpers of the tests."""


def wide_rows(df, key="day"):
    """{key as text: {column: value}} of a frame."""
    return {str(r[key]): {k: v for k, v in r.asDict().items() if k != key} for r in df.collect()}
