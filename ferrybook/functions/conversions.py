"""Registry of CUSTOM conversions: named functions over a custom row; formula text is never executed.

Each function takes a ``Row`` and its arguments and returns a Column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrybook.functions.text import is_digits, slice_of, strip, to_date, zero_left

FORMULAS: dict[str, Callable[..., Column]] = {}


@dataclass(frozen=True)
class Row:
    """What a conversion may look at. ``header`` is the standard header built before, if any."""

    text: Column
    value: Column
    header: Column
    line_number: Column
    batch: Column
    as_of: datetime

    def at(self, start: int, end: int) -> Column:
        """Source characters, 1-based with both ends included, as mapping tables count."""
        return slice_of(self.text, start - 1, end)

    def now(self, zone: str) -> Column:
        return F.from_utc_timestamp(F.lit(self.as_of.isoformat(sep=" ")).cast("timestamp"), zone)


def formula(name: str):
    def register(fn):
        FORMULAS[name] = fn
        return fn

    return register


@formula("lookup")
def lookup(row: Row, pairs: dict[str, str], default: str) -> Column:
    out = None
    for key, value in pairs.items():
        out = F.when(row.value == key, value) if out is None else out.when(row.value == key, value)
    return F.lit(default) if out is None else out.otherwise(default)


@formula("cap_amount")
def cap_amount(row: Row, limit: int, default: int, width: int) -> Column:
    """The amount, or the default above the limit, zero-filled on the left."""
    amount = F.when(is_digits(strip(row.value)), strip(row.value).try_cast("decimal(38,0)"))
    kept = F.when(amount > limit, F.lit(str(default))).otherwise(amount.cast("string"))
    return zero_left(kept, width)


@formula("id_limit")
def id_limit(row: Row, longest: int, fill: str) -> Column:
    """The stripped id, or the fill character all along when it is too long."""
    return F.when(F.length(strip(row.value)) > longest, F.repeat(F.lit(fill), longest)).otherwise(strip(row.value))


@formula("earlier_date")
def earlier_date(row: Row, zone: str, fmt: str = "yyyyMMdd") -> Column:
    """The date of the row or the run's date in a zone, whichever is earlier."""
    today = F.date_format(row.now(zone), fmt)
    return F.when(to_date(row.value, fmt) >= to_date(today, fmt), today).otherwise(row.value)


@formula("date_format")
def reformat_date(row: Row, source: str, target: str) -> Column:
    return F.date_format(F.try_to_timestamp(row.value, F.lit(source)), target)


@formula("combine")
def combine(row: Row, *spans: tuple[int, int]) -> Column:
    return F.concat(*[strip(row.at(*span)) for span in spans])


@formula("run_stamp")
def run_stamp(row: Row, fmt: str, zone: str) -> Column:
    return F.date_format(row.now(zone), fmt)


@formula("header_slice")
def header_slice(row: Row, start: int, end: int) -> Column:
    """Characters of the standard header, 0-based with the end excluded."""
    return slice_of(row.header, start, end)


@formula("line_number")
def line_number(row: Row, width: int) -> Column:
    return zero_left(row.line_number.cast("string"), width)


@formula("batch_number")
def batch_number(row: Row, width: int) -> Column:
    return zero_left(row.batch.cast("string"), width)


@formula("count_minus")
def count_minus(row: Row, less: int) -> Column:
    number = F.when(is_digits(strip(row.value)), strip(row.value).try_cast("bigint"))
    return (number - less).cast("string")
