"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words where a contract says so: ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    An expression inside a lambda would be computed again for every element, and one
    that several others refer to may be copied into each of them.
    """
    return F.transform(F.array(value), use)[0]


def fresh(df: DataFrame, name: str) -> str:
    """A column name the frame does not have, in either case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(modulus: int, remainder: int, column: str = "doc_id") -> Column:
    """Whether a row belongs to the held-out fold; rows without an id do not."""
    fold = F.crc32(F.col(column).cast("string").cast("binary")) % modulus
    return F.coalesce(fold == remainder, F.lit(False))


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased: for bytes, Python lower-cases and splits
    exactly the ASCII letters and ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_KEPT: dict[str, object] = {}


def kept(key: str, make: Callable[[], object]) -> object:
    """What a worker keeps between tasks, such as a tokenizer with its cache; one at a time."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def keep_nothing() -> None:
    """Give back the memory of what tasks of other operators left in this worker."""
    _KEPT.clear()


def record_batch(rows: Iterable[tuple], fields: dict[str, pa.DataType]) -> pa.RecordBatch:
    """Rows as an Arrow batch, of the right types also when there are none."""
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, fields.values())]
    return pa.RecordBatch.from_arrays(arrays, names=list(fields))


def crc_sql(value: str) -> str:
    """CRC-32 of a text's UTF-8, unsigned, in DuckDB's SQL, which lacks the function: bit
    by bit, each byte being taken in before its first bit."""
    digit = f"(strpos('0123456789ABCDEF', substr(hex(encode({value})), i // 4 + {{}}, 1)) - 1)"
    byte = f"CASE WHEN i % 8 = 0 THEN {digit.format(1)} * 16 + {digit.format(2)} ELSE 0 END"
    steps = f"list_transform(range(8 * octet_length(encode({value}))), lambda i: {byte})"
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}),
        lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295)"""
