"""Many feeds in one run: every feed has its own structure spec and rule catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.functions import kinds as K
from ferrybook.operators.catalogue import Rule, RuledColumn, compile_rows
from ferrybook.operators.rule_data import evaluate_from_data, is_plain, rule_table
from ferrybook.operators.rules import RuleSet, evaluate, with_first_value
from ferrybook.operators.structure import SpecColumn, StructureSpec, detail_error, spec_table, verdict
from ferrybook.session import broadcast_if_small

# Catalogues of a run that are compiled; beyond, plain ones are evaluated from data.
COMPILED = 24


@dataclass(frozen=True)
class FeedPlan:
    """What a feed's files are checked by. ``duplicates`` names the id column and the rule that reports repeats;
    ``detail_rules`` are rules that count as structure."""

    spec: StructureSpec
    rules: RuleSet
    id_column: str = ""
    duplicates: tuple[RuledColumn, Rule] | None = None
    detail_rules: tuple[RuledColumn, ...] = ()


def catalogues_of_feeds(rows: DataFrame, base: RuleSet) -> dict[int, RuleSet]:
    """The catalogue rows of all feeds, compiled. What people keep for a feed is a matter of hundreds of rows."""
    from dataclasses import replace

    feeds = [r.feed_id for r in rows.select("feed_id").distinct().collect()]
    return {f: replace(base, columns=tuple(compile_rows(rows, f))) for f in sorted(feeds)}


def numbered(plans: Mapping[int, FeedPlan]) -> tuple[dict[int, RuleSet], dict[int, int]]:
    """Distinct catalogues by number, and the number of each feed's."""
    found: dict[str, int] = {}
    catalogues, of_feed = {}, {}
    for feed, plan in sorted(plans.items()):
        r = plan.rules
        key = repr((r.layout, r.columns, r.slots, r.as_of, sorted(r.settings.items())))
        number = found.setdefault(key, len(found))
        catalogues[number] = r
        of_feed[feed] = number
    return catalogues, of_feed


def feed_verdicts(lines: DataFrame, jobs: DataFrame, plans: Mapping[int, FeedPlan]) -> DataFrame:
    """Verdicts of the files of all feeds from one scan; every line carries the spec of its file's feed."""
    specs = spec_table(lines.sparkSession, {f: p.spec for f, p in plans.items()})
    known = jobs.select("job_key", "feed_id").join(F.broadcast(specs), "feed_id")  # a row per feed
    detail = "".join(f" when {f} then {detail_error(p.detail_rules)}" for f, p in sorted(plans.items()) if p.detail_rules)
    own = lines.join(broadcast_if_small(jobs.select("job_key", "feed_id")), "job_key").join(F.broadcast(specs), "feed_id")
    return verdict(own, SpecColumn(), listing=known, detail_rules=f"case _spec.feed_id{detail} end" if detail else K.PASSED)


def evaluate_feeds(lines: DataFrame, plans: Mapping[int, FeedPlan], compiled: int = COMPILED) -> DataFrame:
    """Rule outcomes of lines with ``job_key, line_number, feed_id, value, catalogue``, each by its feed's catalogue.

    ``lines`` are best stored in a folder per ``catalogue``: every catalogue then reads its own part, and all
    lines are read once. Up to ``compiled`` catalogues are projections of their own; of more, the plain
    ones are one projection together. Lines are sorted by job and number within a partition, and their outcomes with them.
    """
    order = ("job_key", "line_number")
    catalogues, _ = numbered(plans)
    data = {k: r for k, r in catalogues.items() if len(catalogues) > compiled and is_plain(r)}
    parts = []
    for number, rules in catalogues.items():
        if number not in data:
            own = lines.where(F.col("catalogue") == number).select("job_key", "line_number", "value")
            parts.append(evaluate(with_first_value(own, rules).sortWithinPartitions(*order), rules))
    if data:
        table = rule_table(lines.sparkSession, data)
        parts.append(evaluate_from_data(lines.where(F.col("catalogue").isin(*data)).sortWithinPartitions(*order), table))
    return reduce(DataFrame.unionByName, parts)


def by_layout(plans: Mapping[int, FeedPlan]) -> dict[str, tuple[RuleSet, Sequence[int]]]:
    """Per layout name a rule set that has it and the numbers of the catalogues that share it."""
    catalogues, _ = numbered(plans)
    out: dict[str, tuple[RuleSet, list[int]]] = {}
    for number, rules in catalogues.items():
        held = out.setdefault(rules.layout.name, (rules, []))
        if held[0].layout != rules.layout:
            raise ValueError(f"two layouts are called {rules.layout.name}")
        held[1].append(number)
    return out
