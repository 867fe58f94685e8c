"""Rule kinds. Each gives the SQL text of the error of a value: NULL when the value passes.

``v`` is the slice as it stands in the line, ``s`` the stripped slice.
"""

from __future__ import annotations

from collections.abc import Callable

from ferrybook.functions import messages as M
from ferrybook.functions.messages import message, quote

PASSED = "cast(null as string)"

DIGITS = r"\\A[0-9]+\\z"
ZEROS = r"\\A0+\\z"
# hours, minutes, seconds and one or two digits of hundredths
CLOCK = r"\\A([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9][0-9]{1,2}\\z"
# only the day of a short month is left to the parser
DAY = r"\\A[0-9]{4}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])\\z"

Kind = Callable[[str, str, "object", "object"], str]


def text(template: str, column, rule, **values: str) -> str:
    return message(
        template,
        values,
        name=column.name,
        pos=column.report_position,
        code=rule.error_code,
        level=rule.error_level,
        expected=rule.equal_to,
        allowed=str(list(rule.values)),
    )


def _if(condition: str, error: str) -> str:
    return f"case when {condition} then {error} end"


def any_of(values) -> str:
    return ", ".join(quote(x) for x in values)


def parsed_day(v: str) -> str:
    """SQL text of a strict yyyyMMdd date, NULL when the text is none."""
    return f"case when {v} rlike '{DAY}' then cast(try_to_timestamp({v}, 'yyyyMMdd') as date) end"


def required(v, s, column, rule):
    return _if(f"{s} = ''", text(M.REQUIRED, column, rule))


def equal_to(v, s, column, rule):
    if not rule.equal_to:
        return PASSED
    return _if(f"{s} <> {quote(rule.equal_to)}", text(M.EQUAL_TO, column, rule, value=s))


def not_equal_to(v, s, column, rule):
    if not rule.equal_to:
        return PASSED
    return _if(f"{s} = {quote(rule.equal_to)}", text(M.NOT_EQUAL_TO, column, rule, value=s))


def in_range(v, s, column, rule):
    return _if(f"{s} not in ({any_of(rule.values)})", text(M.RANGE, column, rule, value=v))


def blank_or_range(v, s, column, rule):
    return _if(f"{s} not in ({any_of(('', *rule.values))})", text(M.RANGE, column, rule, value=v))


def required_and_range(v, s, column, rule):
    return (
        f"case when {s} = '' then {text(M.REQUIRED, column, rule)}"
        f" when {s} not in ({any_of(rule.values)}) then {text(M.RANGE, column, rule, value=v)} end"
    )


def number(v, s, column, rule):
    return _if(f"not {v} rlike '{DIGITS}'", text(M.NUMBER, column, rule, value=v))


def blank(v, s, column, rule):
    return _if(f"{s} <> ''", text(M.BLANK, column, rule, value=v))


def zeros(v, s, column, rule):
    return _if(f"not {v} rlike '{ZEROS}'", text(M.ZEROS, column, rule, value=v))


def date(v, s, column, rule):
    return _if(f"({parsed_day(v)}) is null", text(M.DATE, column, rule, value=v))


def time(v, s, column, rule):
    return _if(f"not {v} rlike '{CLOCK}'", text(M.TIME, column, rule, value=v))


def custom_error(v, column, rule, failed: str) -> str:
    return _if(failed, text(M.CUSTOM, column, rule, value=v))


# Rule kind names as they stand in a catalogue.
KINDS: dict[str, Kind] = {
    "REQUIRED": required,
    "EQUALTO": equal_to,
    "MUST_NOT_EQUAL_TO": not_equal_to,
    "RANGE": in_range,
    "BLANK_OR_RANGE": blank_or_range,
    "REQUIRED_AND_RANGE": required_and_range,
    "NUMBER": number,
    "BLANK": blank,
    "ALL_ZEROS": zeros,
    "DATE": date,
    "TIME": time,
}

# Kinds a slot column applies while its slot is in use.
SLOT_KINDS = ("REQUIRED", "REQUIRED_AND_RANGE", "RANGE", "NUMBER", "EQUALTO", "MUST_NOT_EQUAL_TO")
