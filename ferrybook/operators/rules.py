"""The field rule engine: a catalogue compiled to one narrow projection over the lines."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.functions import kinds as K
from ferrybook.functions import messages as M
from ferrybook.functions.customs import CUSTOM, Line
from ferrybook.functions.messages import quote
from ferrybook.functions.text import WHITESPACE, slice_of
from ferrybook.operators.catalogue import AMOUNT_NAME, RuledColumn, evaluated
from ferrybook.operators.layout import ByteCutter, Layout
from ferrybook.session import broadcast_if_small, shuffled

# Slot qualifiers that count as valid, and the one that asks for a category.
VALID_QUALIFIERS = (2, 4, 5, 6, 7, 8, 14, 15)
CATEGORY_QUALIFIER = "08"

@dataclass(frozen=True)
class RuleSet:
    """A catalogue with everything a rule may refer to."""

    layout: Layout
    columns: tuple[RuledColumn, ...]
    slots: tuple[str, ...] = ()
    as_of: date = date(2020, 1, 1)
    settings: Mapping[str, object] = field(default_factory=dict)

    @classmethod
    def of(cls, layout: Layout, columns: Iterable[RuledColumn], **kw) -> RuleSet:
        return cls(layout, tuple(evaluated(columns)), **kw)

    def only(self, *rule_ids: int) -> RuleSet:
        """The same set with a part of the rules."""
        parts = (replace(c, rules=tuple(r for r in c.rules if r.rule_id in rule_ids)) for c in self.columns)
        return replace(self, columns=tuple(c for c in parts if c.rules))

    def role(self, name: str) -> RuledColumn | None:
        return next((c for c in self.columns if c.role == name), None)


def leading_run(stripped: list[str]) -> str:
    """Length of the leading run of valid slots; a slot that is no integer resets it to 0."""
    plain = K.any_of(f"{n:02d}" for n in VALID_QUALIFIERS)
    numbers = "|".join(str(n) for n in VALID_QUALIFIERS)
    run = []
    for i, s in enumerate(stripped):
        valid = f"({s} in ({plain}) or {s} rlike '\\\\A[+]?0*({numbers})\\\\z')"
        junk = f"{s} <> '' and not {s} rlike '\\\\A[+-]?[0-9]+\\\\z'"
        run.append(f"when not {valid} then case when {junk} then 0 else {i} end")
    return f"case {' '.join(run)} else {len(stripped)} end"


def first_values(lines: DataFrame, column: RuledColumn, spread: bool = False) -> DataFrame:
    """Value on the first detail line of each file, for files whose lines do not all agree.

    Values are compared by their hashes, which a hash aggregate can keep; the first line's text is
    then looked up for the files that differ alone. With ``spread`` it is looked up by the file, by which the lines lie
    dealt out, and by their number behind the join.
    """
    rows = lines.select("job_key", "line_number", slice_of(F.col("value"), column.start, column.end).alias("first_value"))
    h = F.xxhash64("first_value")
    differing = (
        rows.groupBy("job_key")
        .agg(F.min("line_number").alias("line_number"), F.min(h).alias("lowest"), F.max(h).alias("highest"))
        .where(F.col("lowest") != F.col("highest"))
        .select("job_key", "line_number")
    )
    if spread:
        at = differing.withColumnRenamed("line_number", "_at")
        # no line is before the first one; an equation would become a key of the join, by which to deal out anew
        return rows.join(shuffled(at), "job_key").where("line_number <= _at").select("job_key", "first_value")
    return rows.join(broadcast_if_small(differing), ["job_key", "line_number"]).select("job_key", "first_value")


def with_first_value(lines: DataFrame, rules: RuleSet, spread: bool = False) -> DataFrame:
    """Attach the first value of the file; only files with differing values are joined.

    With ``spread`` these are never broadcast, for callers that come again and again.
    """
    column = rules.role("first_value")
    if column is None:
        return lines
    side = shuffled if spread else broadcast_if_small
    return lines.join(side(first_values(lines, column, spread)), "job_key", "left")


class _Compiler:
    """Turns columns into ``(rule id, reported when, error)`` SQL texts, in layout order."""

    def __init__(self, rules: RuleSet, with_first: bool):
        self.with_first = with_first
        spans = [(f.start, f.end) for f in rules.layout.fields] + [(c.start, c.end) for c in rules.columns]
        self.cutter = ByteCutter(spans)
        self.line = Line(
            rules.layout, self.cutter, rules.as_of, {**rules.settings, "slot_qualifiers": rules.slots}
        )
        slots = [rules.layout[name] for name in rules.slots]
        columns = {(c.start, c.end): str(c.column_id) for c in rules.columns}
        self.names = {**{(f.start, f.end): f"q{i}" for i, f in enumerate(slots)}, **columns}
        self.slot_names = [self.names[f.start, f.end] for f in slots]
        self.flags: dict[str, str] = {}
        self.stops: list[str] = []
        count = rules.role("slot_count")
        if count is not None:
            v = f"_v{count.column_id}"
            self.count = f"case when {v} rlike '{K.DIGITS}' then try_cast({v} as int) end"
        elif rules.role("slot") is not None:
            raise ValueError("slot columns need the slot count column")
        if rules.role("category") is not None:
            hit = " or ".join(f"_v{n} = '{CATEGORY_QUALIFIER}'" for n in self.slot_names)
            self.flags["_category"] = hit

    def stop(self, name: str, condition: str) -> None:
        self.flags[name] = f"coalesce({condition}, false)"
        self.stops.append(name)

    def error(self, column: RuledColumn, rule) -> str:
        v, s = f"_v{column.column_id}", f"_s{column.column_id}"
        if rule.kind == "CUSTOM":
            failed, skip = CUSTOM[rule.custom](self.line, v)
            if skip is not None:
                self.stop(f"_skip{rule.rule_id}", skip)
            return K.custom_error(v, column, rule, failed)
        return K.KINDS[rule.kind](v, s, column, rule) if rule.kind in K.KINDS else K.PASSED

    def column(self, column: RuledColumn) -> list[tuple[int, str | None, str]]:
        return getattr(self, column.role)(column)

    def plain(self, column: RuledColumn):
        return [(r.rule_id, None, self.error(column, r)) for r in column.rules]

    def slot_count(self, column: RuledColumn):
        first = column.rules[0]
        errors = [self.error(column, r) for r in column.rules]
        failed = f"coalesce({', '.join(errors)}, '') <> ''"
        run = leading_run([f"_s{name}" for name in self.slot_names])
        self.stop("_count_failed", failed)
        self.stop("_count_wrong", f"not ({failed}) and coalesce({self.count} <> {run}, true)")
        self.flags["_count"] = self.count
        told = K.text(M.SLOT_COUNT, column, first, value=f"_v{column.column_id}")
        out = [(first.rule_id, None, f"case when _count_wrong then {told} else {errors[0]} end")]
        return out + [(r.rule_id, "not _count_wrong", e) for r, e in zip(column.rules[1:], errors[1:])]

    def first_value(self, column: RuledColumn):
        if not self.with_first:
            return self.plain(column)
        v = f"_v{column.column_id}"
        told = column.rules[min(1, len(column.rules) - 1)]
        errors = [self.error(column, r) for r in column.rules]
        self.flags["_differs"] = f"coalesce({', '.join(errors)}, '') = '' and coalesce({v} <> first_value, false)"
        text = K.text(M.FIRST_VALUE, column, told, value=v, first="first_value")
        return [
            (r.rule_id, None, f"case when _differs then {text} else {e} end")
            if r is told
            else (r.rule_id, "not _differs", e)
            for r, e in zip(column.rules, errors)
        ]

    def category(self, column: RuledColumn):
        v, s = f"_v{column.column_id}", f"_s{column.column_id}"
        out = []
        for r in column.rules:
            asked = K.required_and_range(v, s, column, r) if r.kind == "REQUIRED_AND_RANGE" else K.PASSED
            out.append((r.rule_id, None, f"case when _category then {asked} else {K.blank(v, s, column, r)} end"))
        return out

    def slot(self, column: RuledColumn):
        v, s = f"_v{column.column_id}", f"_s{column.column_id}"
        used = f"{column.slot_number} <= _count"
        told = next((r for r in column.rules if r.kind in ("REQUIRED", "REQUIRED_AND_RANGE")), None)
        out, passed = [], []
        for r in column.rules:
            strict = K.KINDS[r.kind](v, s, column, r) if r.kind in K.SLOT_KINDS else K.PASSED
            so_far = " and ".join(["true", *passed])
            if r is told:
                unused = K.blank(v, s, column, r)
                if AMOUNT_NAME in column.name:
                    unused = f"case when {s} <> '' then {K.zeros(v, s, column, r)} end"
                reported = f"not ({used}) or ({so_far})" if passed else None
                out.append((r.rule_id, reported, f"case when {used} then {strict} else {unused} end"))
            else:
                out.append((r.rule_id, f"{used} and {so_far}", strict))
            passed.append(f"({strict}) is null")
        return out


def evaluate(
    lines: DataFrame,
    rules: RuleSet,
    keep: Iterable[str] = ("job_key", "line_number"),
    failures_only: bool = False,
    level: int | None = None,
) -> DataFrame:
    """One row per evaluated rule and line. No shuffle, no Python on the rows.

    Columns are taken in layout order; a failed slot count or a skip ends the line. Pass lines
    that carry ``first_value`` (see ``with_first_value``) to check values against the first line.
    With ``failures_only``, passed rules are dropped before they become rows; with a ``level``, so are rules
    of other levels, while what they say of the rules behind them still holds.
    """
    keep = list(keep)
    with_first = "first_value" in lines.columns
    compiler = _Compiler(rules, with_first)
    outcomes: list[str] = []
    for column in rules.columns:
        live = [f"not {name}" for name in compiler.stops]
        levels = {r.rule_id: r.error_level for r in column.rules}
        for rule_id, reported, error in compiler.column(column):
            if level is not None and levels[rule_id] != level:
                continue
            outcome = f"named_struct('rule_id', {rule_id}, 'error', {error})"
            conditions = live + ([f"({reported})"] if reported else [])
            if conditions:
                outcome = f"case when {' and '.join(conditions)} then {outcome} end"
            outcomes.append(outcome)

    made = f"array({', '.join(outcomes)})" if outcomes else "cast(array() as array<struct<rule_id:int,error:string>>)"
    cutter = compiler.cutter
    first = ["first_value"] if with_first else []
    blocks = cutter.measured(lines, *keep, *first).selectExpr(
        *keep, *first, *cutter.block_columns(), "_printable"
    )
    # a line without control or non-ASCII characters needs no search for other white space
    work = blocks.selectExpr(
        *keep,
        *first,
        *cutter.block_columns_kept(),
        *[f"{cutter.field(*span)} as _v{name}" for span, name in compiler.names.items()],
        *[
            f"case when _printable then trim({cutter.field(*span)})"
            f" else trim(both {quote(WHITESPACE)} from {cutter.field(*span)}) end as _s{name}"
            for span, name in compiler.names.items()
        ],
    )
    if compiler.flags:
        work = work.selectExpr("*", *[f"{sql} as {name}" for name, sql in compiler.flags.items()])
    wanted = F.col("outcomes")
    if failures_only:
        wanted = F.filter(wanted, lambda o: o["error"].isNotNull())
    return (
        # The array is a projection of its own, so that it is compiled in small functions. The outer
        # form keeps Spark from copying the whole array into a "not empty" filter below the generator.
        work.selectExpr(*keep, f"{made} as outcomes")
        .select(*keep, F.inline_outer(wanted))
        .where(F.col("rule_id").isNotNull())
        .select(
            *keep,
            "rule_id",
            F.when(F.col("error").isNull(), "Y").otherwise("N").alias("validation_result"),
            F.coalesce("error", F.lit(" ")).alias("error_message"),
        )
    )
