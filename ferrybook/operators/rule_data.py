"""Rules as data: plain rules of many catalogues evaluated from an array that each line carries.

A compiled projection is the fastest form of a catalogue, but a plan with hundreds of them is not. Here one
projection serves any number of catalogues: a line meets the rules of its own, a broadcast row, and a
higher-order function evaluates them. Custom rules and columns with a role need the compiled form.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrybook.functions import kinds as K
from ferrybook.functions import messages as M
from ferrybook.functions.messages import message, quote
from ferrybook.functions.text import strip_sql
from ferrybook.operators.rules import RuleSet
from ferrybook.session import broadcast_if_small

RULE = (
    "struct<rule_id:int,start:int,width:int,kind:string,equal_to:string,allowed:array<string>,allowed_text:string,"
    "name:string,pos:string,code:int,level:int>"
)

# Per kind the conditions of failure, in order, with the text of each and the value it shows. ``x.r`` is the
# rule, ``x.v`` the slice as it stands in the line, ``x.s`` the stripped slice.
_EMPTY = ("x.s = ''", M.REQUIRED, None)
_OUTSIDE = ("not array_contains(x.r.allowed, x.s)", M.RANGE, "x.v")
FAILURES: Mapping[str, list[tuple[str, str, str | None]]] = {
    "REQUIRED": [_EMPTY],
    "EQUALTO": [("x.r.equal_to <> '' and x.s <> x.r.equal_to", M.EQUAL_TO, "x.s")],
    "MUST_NOT_EQUAL_TO": [("x.r.equal_to <> '' and x.s = x.r.equal_to", M.NOT_EQUAL_TO, "x.s")],
    "RANGE": [_OUTSIDE],
    "BLANK_OR_RANGE": [(f"x.s <> '' and {_OUTSIDE[0]}", *_OUTSIDE[1:])],
    "REQUIRED_AND_RANGE": [_EMPTY, _OUTSIDE],
    "NUMBER": [(f"not x.v rlike '{K.DIGITS}'", M.NUMBER, "x.v")],
    "BLANK": [("x.s <> ''", M.BLANK, "x.v")],
    "ALL_ZEROS": [(f"not x.v rlike '{K.ZEROS}'", M.ZEROS, "x.v")],
    "DATE": [(f"({K.parsed_day('x.v')}) is null", M.DATE, "x.v")],
    "TIME": [(f"not x.v rlike '{K.CLOCK}'", M.TIME, "x.v")],
}


def _told(template: str, value: str | None) -> str:
    places = {"name": "name", "pos": "pos", "code": "code", "level": "level", "expected": "equal_to", "allowed": "allowed_text"}
    return message(template, {**{k: f"x.r.{v}" for k, v in places.items()}, "value": value or "''"})


def _error() -> str:
    kinds = [
        f"when {quote(kind)} then case {' '.join(f'when {c} then {_told(t, v)}' for c, t, v in failures)} end"
        for kind, failures in FAILURES.items()
    ]
    return f"case x.r.kind {' '.join(kinds)} end"


def is_plain(rules: RuleSet) -> bool:
    """Can the catalogue be evaluated from data?"""
    return all(c.role == "plain" and all(r.kind in FAILURES for r in c.rules) for c in rules.columns)


def rule_table(spark: SparkSession, catalogues: Mapping[int, RuleSet]) -> DataFrame:
    """``catalogue, _rules``: a row per catalogue with its rules in the order of evaluation."""
    rows = [
        (
            number,
            [
                (r.rule_id, c.start, c.end - c.start, r.kind, r.equal_to, list(r.values), str(list(r.values)), c.name, c.report_position, r.error_code, r.error_level)
                for c in rules.columns
                for r in c.rules
            ],
        )
        for number, rules in sorted(catalogues.items())
    ]
    return spark.createDataFrame(rows, f"catalogue int, _rules array<{RULE}>")


def evaluate_from_data(lines: DataFrame, rules: DataFrame, keep: Iterable[str] = ("job_key", "line_number")) -> DataFrame:
    """One row per rule and line, as the compiled engine gives them. ``lines`` name their ``catalogue``.

    No shuffle where the rules are small, no Python on the rows.
    """
    keep = list(keep)
    cut = "transform(_rules, r -> named_struct('r', r, 'v', substring(value, r.start + 1, r.width)))"
    stripped = f"transform({cut}, y -> named_struct('r', y.r, 'v', y.v, 's', {strip_sql('y.v')}))"
    outcomes = f"transform({stripped}, x -> named_struct('rule_id', x.r.rule_id, 'error', {_error()}))"
    met = lines.join(broadcast_if_small(rules), "catalogue")
    return (
        met.selectExpr(*keep, f"{outcomes} as outcomes")
        .select(*keep, F.inline("outcomes"))
        .select(
            *keep,
            "rule_id",
            F.when(F.col("error").isNull(), "Y").otherwise("N").alias("validation_result"),
            F.coalesce("error", F.lit(" ")).alias("error_message"),
        )
    )
