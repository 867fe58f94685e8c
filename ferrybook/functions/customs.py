"""Registry of CUSTOM rules: named functions over the line; rule text from a table is never executed.

Each function takes a ``Line`` and the value's SQL text and returns ``(failed, skip)`` as SQL
conditions: ``skip`` ends the evaluation of the line after this column, or is None.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from ferrybook.functions.kinds import DIGITS, parsed_day
from ferrybook.functions.text import strip_sql
from ferrybook.operators.layout import Cutter, Layout

CUSTOM: dict[str, Callable[["Line", str], tuple[str, str | None]]] = {}


@dataclass(frozen=True)
class Line:
    """What a custom rule may look at: other fields of the line, and the run's settings."""

    layout: Layout
    cutter: Cutter
    as_of: date
    settings: Mapping[str, object]

    def field(self, name: str) -> str:
        f = self.layout[name]
        return self.cutter.field(f.start, f.end)


def custom(name: str):
    def register(fn):
        CUSTOM[name] = fn
        return fn

    return register


@custom("response_by_file_type")
def response_by_file_type(line: Line, value: str):
    """A request carries no response, an answer carries A or R, other types always fail."""
    kind = line.field("file_type")
    return f"case {kind} when 'DR' then {value} not in ('A', 'R') when 'DQ' then {strip_sql(value)} <> '' else true end", None


@custom("response_presence")
def response_presence(line: Line, value: str):
    """Blank for a request, filled for everything else."""
    return f"({line.field('file_type')} = 'DQ') = ({strip_sql(value)} <> '')", None


@custom("reject_code_by_response")
def reject_code_by_response(line: Line, value: str):
    """Filled exactly when an answer is a rejection."""
    rejected = f"{line.field('file_type')} = 'DR' and {line.field('response')} = 'R'"
    return f"({rejected}) = ({strip_sql(value)} = '')", None


@custom("skip_answered")
def skip_answered(line: Line, value: str):
    """Never fails; answers with A or R are not checked any further."""
    return "false", f"{line.field('file_type')} = 'DR' and {value} in ('A', 'R')"


@custom("date_window")
def date_window(line: Line, value: str):
    """A date of the last N days, today included."""
    today = f"date'{line.as_of.isoformat()}'"
    inside = f"({parsed_day(value)}) between date_sub({today}, {int(line.settings['date_window_days'])}) and {today}"
    return f"not coalesce({inside}, false)", None


@custom("filled_slot_count")
def filled_slot_count(line: Line, value: str):
    """The count field equals the number of filled slot qualifiers."""
    filled = " + ".join(f"int({strip_sql(line.field(s))} <> '')" for s in line.settings["slot_qualifiers"])
    return f"case when {value} rlike '{DIGITS}' then coalesce({filled} <> try_cast({value} as int), true) else true end", None
