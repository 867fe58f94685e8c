"""Layouts: named slices of a line, parsed to columns and encoded back."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrybook.functions.text import NARROW, slice_of


@dataclass(frozen=True)
class Field:
    name: str
    start: int
    end: int

    @property
    def width(self) -> int:
        return self.end - self.start


@dataclass(frozen=True)
class Layout:
    name: str
    fields: tuple[Field, ...]

    @classmethod
    def of(cls, name: str, *fields: tuple[str, int, int]) -> Layout:
        return cls(name, tuple(Field(*f) for f in fields))

    @classmethod
    def from_spec(cls, name: str, spec: str, names: Sequence[str]) -> Layout:
        """From position text such as ``0:200,200:202``."""
        spans = [tuple(int(n) for n in part.split(":")) for part in spec.split(",")]
        return cls(name, tuple(Field(n, s, e) for n, (s, e) in zip(names, spans, strict=True)))

    @classmethod
    def from_widths(cls, name: str, widths: str, names: Sequence[str]) -> Layout:
        """From width text such as ``0:200,1:2``, where the left number only counts columns."""
        fields, at = [], 0
        for n, part in zip(names, widths.split(","), strict=True):
            width = int(part.split(":")[1])
            fields.append(Field(n, at, at + width))
            at += width
        return cls(name, tuple(fields))

    def __getitem__(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    @property
    def length(self) -> int:
        return max(f.end for f in self.fields)

    def columns(self, text: Column) -> list[Column]:
        return [slice_of(text, f.start, f.end).alias(f.name) for f in self.fields]

    def value(self, text: Column, name: str) -> Column:
        f = self[name]
        return slice_of(text, f.start, f.end)


PRINTABLE = r"\\A[ -~]*\\z"

# Characters of one block a line is cut into before its fields are cut from the blocks.
BLOCK = 64


class Cutter:
    """Slices in two steps: the line into blocks, the blocks into fields.

    A substring walks the text up to its position, so cutting every field from the whole line costs
    fields times length; from blocks it costs the length once and a short walk per field.
    """

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.blocks: list[tuple[int, int]] = []
        self.home: dict[tuple[int, int], int] = {}
        for start, end in sorted(set(spans)):
            if not self.blocks or end - self.blocks[-1][0] > BLOCK:
                self.blocks.append((start, end))
            first, last = self.blocks[-1]
            self.blocks[-1] = (first, max(last, end))
            self.home[start, end] = len(self.blocks) - 1

    def block_columns(self) -> list[str]:
        return [f"substring(value, {s + 1}, {e - s}) as _b{i}" for i, (s, e) in enumerate(self.blocks)]

    def block_columns_kept(self) -> list[str]:
        return [f"_b{i}" for i in range(len(self.blocks))]

    def field(self, start: int, end: int) -> str:
        i = self.home[start, end]
        return f"substring(_b{i}, {start - self.blocks[i][0] + 1}, {end - start})"


class ByteCutter(Cutter):
    """Cuts a line of one byte per character by its bytes, without any walk; other lines by characters.

    For projections that no filter is pushed through, as a pushed filter would measure the line per field.
    """

    def measured(self, lines: DataFrame, *keep: str) -> DataFrame:
        """Lines with what the blocks are cut from, and whether they hold printable characters of ASCII alone."""
        told = lines.selectExpr(*keep, "value", "cast(value as binary) as _bytes", f"value rlike '{PRINTABLE}' as _printable")
        return told.selectExpr("*", f"_printable or value rlike '{NARROW}' as _narrow")

    def block_columns(self) -> list[str]:
        cut = "case when _narrow then substring(_bytes, {0}, {1}) else cast(substring(value, {0}, {1}) as binary) end".format
        return ["_narrow", *[f"{cut(s + 1, e - s)} as _b{i}" for i, (s, e) in enumerate(self.blocks)]]

    def block_columns_kept(self) -> list[str]:
        return ["_narrow", *super().block_columns_kept()]

    def field(self, start: int, end: int) -> str:
        i = self.home[start, end]
        at = f"{start - self.blocks[i][0] + 1}, {end - start}"
        return f"case when _narrow then cast(substring(_b{i}, {at}) as string) else substring(cast(_b{i} as string), {at}) end"


def parse(lines: DataFrame, layout: Layout, keep: Iterable[str] = ("job_key", "line_number")) -> DataFrame:
    """One string column per field, unstripped, after the kept key columns. Narrow."""
    cutter = Cutter((f.start, f.end) for f in layout.fields)
    return lines.selectExpr(*keep, *cutter.block_columns()).selectExpr(
        *keep, *[f"{cutter.field(f.start, f.end)} as {f.name}" for f in layout.fields]
    )


def encode(values: Sequence[tuple[Column, int]]) -> Column:
    """Fixed-width line: every value padded or cut to its width, NULL as blanks."""
    return F.concat(*[F.rpad(F.coalesce(c.cast("string"), F.lit("")), w, " ") for c, w in values])


def encode_record(layout: Layout) -> Column:
    """The line a parsed record came from."""
    return encode([(F.col(f.name), f.width) for f in layout.fields])
