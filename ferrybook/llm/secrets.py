"""Secret scans over an incremental ledger of blobs, with built-in functions only.

Every historical version of a file is known by the sha256 of its text, the blob. The ledger is a
table of (blob, rules, findings): which rules, each with its version, have scanned a blob, and what
they found. A scan reads the ledger, takes each blob once, runs only the rule versions that have not
seen it, and appends what it did. Findings are then joined back to all paths that hold the blob.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrybook.llm.common import stored
from ferrybook.llm.spans import matches

FINDING = "struct<kind:string,s:int,e:int>"
LEDGER = f"blob string, rules array<string>, findings array<struct<rule:string,found:array<{FINDING}>>>"


class Rule(NamedTuple):
    """A pattern whose matches count when they have ``least`` code points, or ``group`` of them has."""

    name: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    hint: str = ""

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


BASE = (
    Rule(
        "assign", 1, r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 1
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 18, 0, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", 0, 0, "eyJ"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0, "-----BEGIN "),
    Rule("hub", 1, r"gh[pousr]_[A-Za-z0-9]{36,}+", 0, 0, "gh"),
)
RULES = BASE + MORE


def _scan(text: Column, rule: Rule) -> Column:
    found = matches(text, rule.pattern, text.contains(rule.hint) if rule.hint else None)
    if rule.least:
        part = lambda m: F.regexp_extract(m, rule.pattern, rule.group) if rule.group else m
        found = F.filter(found, lambda x: F.length(part(x["m"])) >= rule.least)
    return F.transform(found, lambda x: F.struct(F.lit(rule.name).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def scan(
    versions: DataFrame, ledger: str, path: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One row per row of ``versions``: the path column, ``blob``, ``findings`` (kind, s, e) in the order
    of start and then of ``rules``.

    ``ledger`` is a folder of Parquet files that grows with every scan; it may not exist yet. A null
    text counts as an empty one. A path may have many versions, and a text many paths. An empty table
    gives no rows; other columns are not read.
    """
    spark = versions.sparkSession
    read = versions.select(F.col(path).alias("path"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    read = read.withColumn("blob", F.sha2("text", 256))
    refs = stored(read.select("path", "blob"), "refs")
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)  # so that it can be read
    past = spark.read.schema(LEDGER).parquet(ledger)
    wanted = F.array(*[F.lit(r.key) for r in rules])
    blobs = read.groupBy("blob").agg(F.first("text").alias("text"))
    if past.limit(1).count():
        seen = past.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        fresh = refs.select("blob").distinct().join(seen, "blob", "left")
        todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        fresh = fresh.select("blob", todo.alias("todo")).where("size(todo) > 0")
        unseen = read.join(fresh, "blob").groupBy("blob", "todo").agg(F.first("text").alias("text"))
    else:
        unseen = blobs.withColumn("todo", wanted)
    none = F.expr(f"cast(array() as array<{FINDING}>)")
    scanned = [
        F.struct(
            F.lit(r.key).alias("rule"),
            F.when(F.array_contains("todo", r.key), _scan(F.col("text"), r)).otherwise(none).alias("found"),
        )
        for r in rules
    ]
    found = F.filter(F.array(*scanned), lambda x: F.size(x["found"]) > 0)
    unseen.select("blob", F.col("todo").alias("rules"), found.alias("findings")).write.mode("append").parquet(ledger)
    known = spark.read.schema(LEDGER).parquet(ledger).where("size(findings) > 0")
    known = known.select("blob", F.explode("findings").alias("x")).where(F.col("x.rule").isin([r.key for r in rules]))
    known = known.groupBy("blob").agg(F.flatten(F.collect_set("x.found")).alias("findings"))
    out = refs.join(known, "blob", "left").withColumn("findings", F.coalesce("findings", none))
    ranked = F.expr(
        "transform(array_sort(transform(findings, x -> struct(x.s as s, cast(array_position(array("
        + ", ".join(f"'{r.name}'" for r in rules)
        + "), x.kind) as int) as rank, x.e as e, x.kind as kind))), x -> struct(x.kind as kind, x.s as s, x.e as e))"
    )
    return out.select(F.col("path").alias(path), "blob", ranked.alias("findings"))


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


def digests(found: DataFrame, path: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their places, and all places as text."""
    base = [r.name for r in BASE]
    of = lambda spans: F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string")))
    mine = F.filter(F.col("findings"), lambda x: x["kind"].isin(base))
    return found.select(
        path,
        *[F.size(F.filter(F.col("findings"), _of_kind(k))).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(F.array_join(of(mine), ","), 256).alias("base_sha256"),
        F.array_join(of(F.col("findings")), ",").alias("spans"),
    )
