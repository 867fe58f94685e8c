"""Message texts. ``message`` fills constants on the driver and values as row expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

# The texts partners receive. {name} {pos} {code} {level} {expected}
# {allowed} are constants of a rule, the other places are values of a row.
REQUIRED = "Column : {name}  at position {pos} can not be empty. Error Code : {code} , Error Level : {level}"
EQUAL_TO = (
    "Column : {name}  at position {pos} has the value {value}, expected value is {expected}"
    " Error Code : {code}, Error Level : {level}"
)
NOT_EQUAL_TO = (
    "Column : {name}  at position {pos} has the value {value},"
    " System does not expect this value {expected} here."
    " Error Code : {code}, Error Level : {level}"
)
RANGE = (
    "Column : {name}  at position {pos} has the value {value}, and it does not belong to the list {allowed}."
    " Error Code : {code}, Error Level : {level}"
)
NUMBER = (
    "Column : {name}  at position {pos} has the value {value} and it is not a number."
    " Field can only contain digits and no other characters."
    " Error Code : {code}, Error Level : {level}"
)
BLANK = (
    "Column : {name}  at position {pos} has the value {value}, but blank/empty space(s) is expected here."
    " Error Code : {code}, Error Level : {level}"
)
ZEROS = (
    "Column : {name}  at position {pos} has the value {value}  Value filled with 0 (zero) is expected here."
    " Error Code : {code}, Error Level : {level}"
)
DATE = (
    "Column : {name}  at position {pos} has the value {value}, it is not a valid date format."
    " Error Code : {code}, Error Level : {level}"
)
TIME = (
    "Column : {name}  at position {pos} has the value {value}, it is not a valid time format."
    " Error Code : {code}, Error Level : {level}"
)
CUSTOM = (
    "Column : {name}  at position {pos} has the value {value}, and it does not pass the require validations."
    " Error Code : {code} , Error Level : {level}"
)
SLOT_COUNT = (
    "Column : {name}  at position {pos} is {value}."
    " This value does not match the total number of non-empty and valid Accumulator Balance Qualifiers"
    " in Accumulator Section ( from 1 up to 12)."
    " Error Code : {code}, Error Level : {level}"
)
FIRST_VALUE = (
    "Column : {name}  at position {pos} is {value} and it does not  match the first submission value {first}."
    " Error Code : {code}, Error Level : {level}"
)
DUPLICATE_ID = (
    "Column : {name}  at position {pos} is duplicate.  Duplicate Value is {value}"
    " Error Code : {code}, Error Level : {level} "
)
LINE_LENGTH = (
    "Line Number : {line} , Expecting line of a  {expected} character long."
    " However, it is only {length} character long "
)
SENDER = "Line Number : {line},  Sender ID {value} does not match with system expected value of {expected} "
RECEIVER = "Line Number : {line},  Receiver ID {value} does not match with system expected value of {expected}"
NO_HEADER = "Line Number : {line} , Header identifier is missing "
SECOND_HEADER = "Line Number : {line} , Header found in the detail records "
TRAILER_COUNT = (
    "Line Number : {line} (Trailer), Trailer Record Count Value is :{value} and it is not a valid number"
)
SECOND_TRAILER = "Line Number : {line}  ( Trailer),  Another trailer found "
DETAIL_AFTER = "Line Number : {line} , a detail record was found after a trailer"
DETAIL_REQUIRED = (
    "Line Number : {line} , Column : {name}  at position {pos} can not be empty. Expected Value must be  {expected}."
    " Error Code : {code}, Error Level : {level}"
)
DETAIL_EQUAL_TO = (
    " Line Number : {line} , Column : {name}  at position {pos} has the value {value},"
    " expected value must be {expected} Error Code : {code}, Error Level : {level}"
)
COUNT_MISMATCH = (
    "Line Number :{lines}  ( Trailer),  Total {found} records found,"
    " which does not match with Total : {stated}  specified in the trailer"
)
BATCH_MISMATCH = (
    "Line Number : {line}  ( Trailer),  Batch Identifier does not match,"
    "  Header Value : {header} , Trailer Value : {trailer}"
)
NO_TRAILER = " No trailer was found"

_PLACE = re.compile(r"\{(\w+)\}")


def quote(text: object) -> str:
    """A SQL string literal."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def message(template: str, values: Mapping[str, str] | None = None, **constants: object) -> str:
    """SQL text of a message: constants are folded in, ``values`` are SQL expressions of the row."""
    values = values or {}
    pieces: list[str] = []
    text, at = "", 0
    for m in _PLACE.finditer(template):
        text += template[at : m.start()]
        at = m.end()
        name = m.group(1)
        if name in values:
            pieces += [quote(text), f"cast({values[name]} as string)"]
            text = ""
        else:
            text += str(constants[name])
    text += template[at:]
    if text or not pieces:
        pieces.append(quote(text))
    return pieces[0] if len(pieces) == 1 else f"concat({', '.join(pieces)})"
