"""Column expressions that turn file text into typed values. All JVM-side, no UDFs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
)

from ..schemas import NULL_TOKENS

# Letters of number literals that no decimal number in a file has: types and hexadecimal marks.
TYPE_LETTERS = "dDfFxX"
SMALL_INTEGERS = (ByteType, ShortType, IntegerType)


def is_token(col: Column, tokens: Sequence[str]) -> Column:
    return col.isin(*tokens)


def blank_tokens(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """The text itself, or null where it is one of the tokens that mean "no value"."""
    return F.when(~is_token(col, tokens), col) if tokens else col


def _number(text: Column) -> Column:
    """Text to double. Spark would also take a type letter at the end ("5f", "12.5d") or hexadecimal digits with a
    binary exponent ("0x1p3"); file text like that is no number. Such text has a letter other than e. Searches for
    single letters cost less than a regular expression."""
    lettered = reduce(lambda a, b: a | b, [text.contains(letter) for letter in TYPE_LETTERS])
    return F.when(~lettered, text).try_cast("double")


def _infinity(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin("inf", "+inf", "infinity", "+infinity"), float("inf")).when(
        word.isin("-inf", "-infinity"), float("-inf")
    )


def clean_cast(col: Column, dtype: DataType, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Text to ``dtype``: tokens and unparsable text become null, fractions round half away from zero.

    Small integers go through a double, which holds every 32-bit integer exactly: a failed cast of text to integer
    raises inside Spark and costs far more than a parse, and text such as ``12.0`` would fail every time. 64-bit
    targets take the direct cast first and a decimal for the rest.
    """
    text = blank_tokens(col, tokens)
    if isinstance(dtype, StringType):
        return text
    if isinstance(dtype, DoubleType):
        return F.coalesce(_number(text), _infinity(col))
    if isinstance(dtype, SMALL_INTEGERS):
        return F.round(_number(text)).try_cast(dtype)
    if isinstance(dtype, LongType):
        return F.coalesce(
            text.try_cast(dtype), F.round(text.try_cast(DecimalType(38, 10))).try_cast(dtype)
        )
    raise ValueError(f"no clean cast to {dtype.simpleString()}")


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; a zero or missing denominator gives null instead of an error."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def round_places(col: Column, places: int) -> Column:
    """Round the binary value half away from zero (``round(0.285, 2) = 0.28``).

    ``F.round`` on a double rounds its shortest decimal text instead and would give 0.29.
    """
    scale = float(10**places)
    return F.round(col * F.lit(scale)) / F.lit(scale)
