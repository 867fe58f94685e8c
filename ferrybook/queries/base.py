"""Access to the derived relations for the queries, and their SQL for the checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.fixtures.dialect import DUCK, Dialect
from ferrybook.operators.layout import parse
from ferrybook.operators.structure import StructureSpec
from ferrybook.session import configure_queries

SPEC = StructureSpec(
    line_length=R.LINE_LENGTH,
    header_id="HD", header_at=(0, 2),
    trailer_id="TR", trailer_at=(0, 2),
    header_batch=(2, 12), trailer_batch=(2, 12),
    trailer_count=(12, 22),
    sender_at=(12, 22), receiver_at=(22, 32),
    sender="SENDER", receiver="HUB",
)


def registry() -> tuple[dict, dict, Callable]:
    """Queries by name, their checking SQL, and the decorator that fills both."""
    queries, oracles = {}, {}

    def query(name: str, oracle: str | None = None):
        def register(fn):
            queries[name] = lambda spark, folder: fn(Tables(spark, folder))
            if oracle is not None:
                oracles[name] = oracle
            return fn

        return register

    return queries, oracles, query


# Relations whose ``value`` is put together from many columns. The generator keeps Spark from building it again
# in every filter on a slice of it.
BUILT = ("line", "file", "wide_line")


class Tables:
    """The derived relations over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure_queries(spark)
        self.dialect = Dialect(True, folder)

    def table(self, name: str) -> DataFrame:
        return self.spark.sql(f"select * from {self.dialect.table(name)}")

    def relation(self, name: str) -> DataFrame:
        made = self.spark.sql(getattr(R, name)(self.dialect))
        if name in BUILT:
            rest = [c for c in made.columns if c != "value"]
            made = made.select(*rest, F.explode_outer(F.array("value")).alias("value"))
        return made

    def record(self) -> DataFrame:
        """Lines parsed to columns, with the columns a loaded record has beside its slices."""
        return parse(self.relation("line"), R.RECORD).selectExpr("*", *LOADED)


# Every tenth record was sent before; a third of the jobs comes from the upstream partner.
LOADED = (
    "case when line_number % 10 = 0 then cast(floor(job_key / 2) as bigint) end as out_job_key",
    "case when job_key % 3 = 0 then 'UPSTREAM' else 'SENDER1' end as sender",
)
RECORD_SQL = f"""select job_key, line_number, {R.record_columns()}, {", ".join(LOADED)}
from line"""


def with_relations(names: str, body: str) -> str:
    """A checking query over derived relations; ``record`` stands for the parsed lines."""
    parts = []
    wanted = names.split()
    if "record" in wanted and "line" not in wanted:
        wanted.insert(0, "line")
    for name in wanted:
        sql = RECORD_SQL if name == "record" else getattr(R, name)(DUCK)
        parts.append(f"{name} as ({sql})")
    return f"with {', '.join(parts)}\n{body}"
