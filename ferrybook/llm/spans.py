"""Places of pattern matches in whole texts with built-in functions only.

Spark's functions give the matches of a pattern and the stretches between them; lengths of both add
up to places. All places count code points from 0, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<s:int,e:int,m:string>"
NONE = f"cast(array() as array<{SPAN}>)"


def matches(text: Column, pattern: str, hint: Column | None = None) -> Column:
    """array<struct<s, e, m>>: the leftmost non-overlapping matches; ``hint`` is false where there can be none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g")))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["g"]
        end = start + F.length(x["m"])
        span = F.struct(start.alias("s"), end.alias("e"), x["m"].alias("m"))
        return F.struct(end.alias("at"), F.array_append(state["out"], span).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.expr(NONE).alias("out"))
    spans = F.aggregate(pairs, begin, step, lambda state: state["out"])
    return F.when(text.rlike(pattern) if hint is None else hint & text.rlike(pattern), spans).otherwise(F.expr(NONE))


def written(kind: str, spans: Column) -> Column:
    """array<string> of kind:start:end."""
    return F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))


def replaced(text: Column, spans: Column) -> Column:
    """The text with every span (struct of s, e, by) replaced by its ``by``; where spans overlap, by the first."""

    def step(state: Column, x: Column) -> Column:
        kept = F.substring(text, state["at"] + 1, x["s"] - state["at"])
        new = F.struct(x["e"].alias("at"), F.concat(state["out"], kept, x["by"]).alias("out"))
        over = F.struct(F.greatest(state["at"], x["e"]).alias("at"), state["out"].alias("out"))
        return F.when(x["s"] >= state["at"], new).otherwise(over)

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text) - state["at"]))
    return F.aggregate(F.array_sort(spans), begin, step, rest)
