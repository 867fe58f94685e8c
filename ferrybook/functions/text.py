"""Text building blocks. All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0 "
    "           "
    "    　"
)

# Of a text of one byte per character. Matching it costs a small part of counting or walking the characters.
NARROW = r"\\A[\\x00-\\x7F]*\\z"

# Last-digit letters of signed overpunch numbers, digits 0 to 9.
POSITIVE_PUNCH = "{ABCDEFGHI"
NEGATIVE_PUNCH = "}JKLMNOPQR"

# Largest amount that fits one seven-character overpunch field.
AMOUNT_LIMIT = 9_999_999


def slice_of(text: Column, start: int, end: int) -> Column:
    """Characters ``start`` to ``end`` (0-based, end excluded); '' past the end of the line."""
    return F.substring(text, start + 1, end - start)


def length_sql(value: str) -> str:
    """SQL text of the number of characters."""
    return f"case when {value} rlike '{NARROW}' then octet_length({value}) else length({value}) end"


def strip(value: Column) -> Column:
    return F.trim(value, F.lit(WHITESPACE))


def strip_sql(value: str) -> str:
    """The same for an SQL text."""
    return f"trim(both '{WHITESPACE}' from {value})"


def is_digits(value: Column) -> Column:
    return value.rlike(r"\A[0-9]+\z")


def to_date(value: Column, fmt: str = "yyyyMMdd") -> Column:
    """Strict date; NULL when the text does not parse."""
    return F.try_to_timestamp(value, F.lit(fmt)).cast("date")


def pad_only(value: Column, width: int, fill: str = " ") -> Column:
    """Left-justify to ``width`` without cutting longer text."""
    return F.when(F.length(value) < width, F.rpad(value, width, fill)).otherwise(value)


def zero_left(value: Column, width: int) -> Column:
    """Zero-fill on the left without cutting longer text."""
    return F.when(F.length(value) < width, F.lpad(value, width, "0")).otherwise(value)


def default_if_blank(value: Column, default: Column) -> Column:
    """The value as it is when it holds a non-blank, else the default."""
    return F.when(F.length(F.trim(value)) > 0, value).otherwise(default)


def clean_utf8(value: Column) -> Column:
    """Drop bytes that are not valid UTF-8."""
    return F.replace(F.make_valid_utf8(value), F.lit("\ufffd"), F.lit(""))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def name_prefix(name: Column) -> Column:
    """Text before the third underscore; NULL when there are fewer than three."""
    return F.when(F.size(F.split(name, "_")) > 3, F.substring_index(name, "_", 3))


def overpunch_decode(text: Column) -> Column:
    """Signed amount of an overpunch field: leading digits, then one letter for digit and sign."""
    last = F.right(text, F.lit(1))
    digit = F.translate(last, POSITIVE_PUNCH + NEGATIVE_PUNCH, "0123456789" * 2)
    amount = F.concat(F.substring(text, 1, 11), digit).try_cast("bigint")
    return F.when(F.instr(F.lit(POSITIVE_PUNCH), last) > 0, amount).otherwise(-amount)


def overpunch_encode(amount: Column) -> Column:
    """Seven characters: six zero-filled digits and the letter of the last digit."""
    digits = F.lpad(F.abs(amount).cast("string"), 7, "0")
    last = F.right(digits, F.lit(1))
    letter = F.when(amount >= 0, F.translate(last, "0123456789", POSITIVE_PUNCH)).otherwise(
        F.translate(last, "0123456789", NEGATIVE_PUNCH)
    )
    return F.concat(F.substring(digits, 1, 6), letter)
