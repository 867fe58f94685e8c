"""The rule catalogue: columns of a feed, their rules, error codes; loading, cloning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name parts that give a column a special role.
COUNT_NAME = "Balance Count"
CATEGORY_NAME = "Specific Category Type"
FIRST_VALUE_NAME = "Submission Number"
AMOUNT_NAME = "Applied Amount"

@dataclass(frozen=True)
class Rule:
    rule_id: int
    priority: int
    kind: str
    equal_to: str = ""
    values: tuple[str, ...] = ()
    custom: str = ""
    error_code: int = 0
    error_level: int = 1
    active: bool = True


@dataclass(frozen=True)
class RuledColumn:
    column_id: int
    name: str
    start: int
    end: int
    accumulator: bool = False
    rules: tuple[Rule, ...] = field(default=())

    @property
    def report_position(self) -> str:
        return f"{self.start + 1}:{self.end}"

    @property
    def role(self) -> str:
        if COUNT_NAME in self.name:
            return "slot_count"
        if CATEGORY_NAME in self.name:
            return "category"
        if FIRST_VALUE_NAME in self.name:
            return "first_value"
        return "slot" if self.accumulator else "plain"

    @property
    def slot_number(self) -> int:
        return int(self.name[-2:])


def evaluated(columns: Iterable[RuledColumn]) -> list[RuledColumn]:
    """Active rules the engine runs, by priority; columns by position in the line."""
    kept = []
    for c in columns:
        rules = sorted(
            (r for r in c.rules if r.active and r.kind != "EXTERNAL"), key=lambda r: r.priority
        )
        if rules:
            kept.append(replace(c, rules=tuple(rules)))
    return sorted(kept, key=lambda c: (c.start, c.end))


def catalogue_rows(
    feeds: DataFrame,
    columns: DataFrame,
    rules: DataFrame,
    errors: DataFrame,
    client_id: int | None = None,
    feed_id: int | None = None,
) -> DataFrame:
    """Active, internally checked rules with their column, feed and error text, of one client or feed
    if given, in the order of evaluation."""
    if client_id is not None:
        feeds = feeds.where(F.col("client_id") == client_id)
    if feed_id is not None:
        feeds = feeds.where(F.col("feed_id") == feed_id)
    return (
        columns.join(
            rules.where((F.col("is_active") == "Y") & (F.col("validation_type") != "EXTERNAL")),
            "file_column_id",
        )
        .join(feeds, "feed_id")
        .join(errors, "error_code")
        .select(
            "client_id", "feed_id", "file_column_id", "file_column_name", "column_position",
            "rule_id", "validation_type", "priority", "equal_to", "list_of_values", "formula",
            "error_code", "error_message", "is_accumulator", "error_level",
        )
        .orderBy("feed_id", "file_column_id", "priority", "rule_id")
    )


def compile_rows(rows: DataFrame, feed_id: int | None = None) -> list[RuledColumn]:
    """One feed's catalogue as rule objects. What a person keeps for one feed is a matter of hundreds of rows."""
    if feed_id is not None:
        rows = rows.where(F.col("feed_id") == feed_id)
    ordered = rows.orderBy("file_column_id", "priority", "rule_id").collect()
    out = []
    for _, group in groupby(ordered, key=lambda r: r["file_column_id"]):
        group = list(group)
        head = group[0]
        start, end = (int(n) for n in head["column_position"].split(":"))
        rules = tuple(
            Rule(
                r["rule_id"], int(r["priority"]), r["validation_type"], r["equal_to"] or "",
                tuple(r["list_of_values"].split(",")) if r["list_of_values"] else (),
                (r["formula"] or "") if r["validation_type"] == "CUSTOM" else "", r["error_code"], r["error_level"],
            )
            for r in group
        )
        out.append(
            RuledColumn(head["file_column_id"], head["file_column_name"], start, end,
                        head["is_accumulator"] == "Y", rules)
        )
    return evaluated(out)


def feeds_with_rules(feeds: DataFrame, columns: DataFrame) -> DataFrame:
    """Feeds that have at least one configured column."""
    return feeds.join(columns.select("feed_id").distinct(), "feed_id", "left_semi").select("feed_id")


def clone_columns(columns: DataFrame, source: int, target: int, offset: int) -> DataFrame:
    """Columns of one feed copied to another under shifted ids, next to the originals."""
    copy = columns.where(F.col("feed_id") == source).select(
        *[
            (F.col("file_column_id") + offset).alias(c)
            if c == "file_column_id"
            else F.lit(target).cast("int").alias(c)
            if c == "feed_id"
            else F.col(c)
            for c in columns.columns
        ]
    )
    return columns.unionByName(copy)


def clone_rules(
    columns: DataFrame,
    rules: DataFrame,
    source: int,
    offset: int,
    overrides: Mapping[str, str],
) -> DataFrame:
    """Rules of the source feed's columns under shifted ids.

    ``overrides`` gives, by column name, the constant an EQUALTO rule takes in the copy.
    """
    constant: Column = F.col("equal_to")
    for name, value in overrides.items():
        constant = F.when(
            (F.col("validation_type") == "EQUALTO") & (F.col("file_column_name") == name), F.lit(value)
        ).otherwise(constant)
    copy = (
        rules.join(
            columns.where(F.col("feed_id") == source).select("file_column_id", "file_column_name"),
            "file_column_id",
        )
        .withColumn("equal_to", constant)
        .withColumn("rule_id", F.col("rule_id") + offset)
        .withColumn("file_column_id", F.col("file_column_id") + offset)
        .select(*rules.columns)
    )
    return rules.unionByName(copy)
