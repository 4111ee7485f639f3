"""Code and code-range specifications such as ``J00-J06``, ``F40-F4``, ``U07.1``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymatrix.functions.cleaning import _col, code3, text

# Fixed value: a range bound is an optional letter and one or two digits.
_BOUND = r"^([A-Z]?)(\d{1,2})"


def _spec_token(spec: Column) -> Column:
    token = F.upper(text(spec))
    token = F.translate(token, "–—", "--")
    return F.replace(token, F.lit(" "), F.lit(""))


def _position(bound: Column, letter: Column) -> Column:
    """Place of a bound in the order A00, A01, ..., A99, B00, ...

    A single digit stands for the end of its ten: ``F4`` is ``F49``.
    """
    digits = F.regexp_extract(bound, _BOUND, 2)
    number = digits.try_cast("int")
    number = F.when(F.length(digits) == 1, number * 10 + 9).otherwise(number)
    return F.when(
        bound.rlike(_BOUND) & (letter != ""), F.ascii(letter) * 100 + number
    )


# The places of all codes that a range may hold, and the codes in that order.
_FIRST, _LAST = 100 * ord("A"), 100 * ord("Z") + 99
_CODES = ",".join(f"{chr(p // 100)}{p % 100:02d}" for p in range(_FIRST, _LAST + 1))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value being computed once; named several times it would be
    copied into each place, which for a specification makes more code than Java takes."""
    return F.transform(F.array(value), use)[0]


def code_bounds(spec: Column | str) -> Column:
    """What a specification stands for: ``(single, first, last)``.

    Either ``single`` is its only code, or the places ``first`` to ``last`` in the
    order of codes are those of its range.  All are null for an inverted range and for
    a blank specification.
    """

    def places(token: Column) -> Column:
        low = F.substring_index(token, "-", 1)
        high = F.substr(token, F.instr(token, "-") + 1)
        low_letter = F.regexp_extract(low, _BOUND, 1)
        high_letter = F.regexp_extract(high, _BOUND, 1)
        high_letter = F.when(high_letter == "", low_letter).otherwise(high_letter)
        is_range = F.contains(token, F.lit("-"))
        return F.struct(
            code3(token).alias("single"),
            F.when(is_range, _position(low, low_letter)).alias("first"),
            F.when(is_range, _position(high, high_letter)).alias("last"),
        )

    def told_apart(p: Column) -> Column:
        readable = p["single"].isNotNull() & p["first"].isNotNull() & p["last"].isNotNull()
        in_order = readable & (p["first"] <= p["last"])
        return F.struct(
            F.when(~readable, p["single"]).alias("single"),
            F.when(in_order, p["first"]).alias("first"),
            F.when(in_order, p["last"]).alias("last"),
        )

    return _once(_once(_spec_token(_col(spec)), places), told_apart)


def code_at(place: Column) -> Column:
    return F.element_at(F.split(F.lit(_CODES), ","), place - (_FIRST - 1))


def codes_between(first: Column | str, last: Column | str) -> Column:
    """Array of the codes at the places ``first`` to ``last``; null without them."""
    return F.transform(F.sequence(_col(first), _col(last)), code_at)


def expand_code_spec(spec: Column | str) -> Column:
    """Array of three-character codes that a specification stands for.

    A range whose bounds cannot be read counts as one code; an inverted range
    and a blank specification give an empty array.
    """
    return _once(
        code_bounds(spec),
        lambda b: F.coalesce(
            codes_between(b["first"], b["last"]),
            F.when(b["single"].isNotNull(), F.array(b["single"])),
            F.array().cast("array<string>"),
        ),
    )
