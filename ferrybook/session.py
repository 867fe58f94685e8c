"""Session settings, the shared folder, and the size check behind every broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What results depend on; the only setting a caller's session is given.
RUNTIME = {"spark.sql.session.timeZone": "UTC"}
# What a session of our own starts with; others may take it over.
STARTUP = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot file, feed or id is split over several tasks at the join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # longer generated methods are never compiled by the JVM; Spark then splits them instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # the wide projections of the rule engine go there directly
    "spark.sql.codegen.maxFields": "60",
}

# What the hub's own queries set in any session: without it, generated methods of the rule engine are too long for the JVM to compile.
COMPILED = {k: v for k, v in STARTUP.items() if k.startswith("spark.sql.codegen.")}

# Bytes a side may take in the driver's memory and still be broadcast.
BROADCAST_BYTES = 48 << 20
# What a row of a broadcast side takes beside its columns: its header and its place in the hash table.
ROW_BYTES = 64
# Files hold a row in far less than memory does; statistics made from them are believed up to this part of the limit.
BELIEVED = 64


def configure(spark: SparkSession) -> SparkSession:
    """Times of the operators are UTC."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def configure_queries(spark: SparkSession) -> SparkSession:
    """The same, and generated code in methods that the JVM compiles."""
    for key, value in COMPILED.items():
        spark.conf.set(key, value)
    return configure(spark)


def build(master: str = "local[*]", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(master).appName("ferrybook")
    settings = {
        **RUNTIME,
        **STARTUP,
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="ferrybook-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table or stream under the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def settle(df: DataFrame) -> DataFrame:
    """Compute once, store in the shared folder, and go on from the stored columns."""
    path = new_folder(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """What Spark's statistics say a relation has at most; huge where they know nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _stored(df: DataFrame) -> bool:
    """Is a relation columns and rows of stored files, so that counting it costs no more than a look at these?"""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().apply(0)
    return plan.nodeName().startswith("Relation") or plan.nodeName() == "LogicalRelation"


def _from_files(df: DataFrame) -> bool:
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return any(leaves.apply(i).nodeName() not in ("LocalRelation", "Range", "OneRowRelation") for i in range(leaves.size()))


def held_bytes(df: DataFrame) -> int:
    """What a stored relation takes in memory as the side of a broadcast join: its rows are counted, not its compressed bytes."""
    return max(plan_bytes(df), df.count() * (df._jdf.schema().defaultSize() + ROW_BYTES))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the side takes at most ``limit`` bytes in memory, else leave it to a shuffle join.

    Where the plan's statistics do not prove it, the side is stored first and its rows are counted. Sizes of
    compressed files prove little: millions of keys in a row fit in a few megabytes of them.
    """
    if plan_bytes(df) <= (limit // BELIEVED if _from_files(df) else limit):
        return F.broadcast(df)
    kept = df if _stored(df) else settle(df)
    return F.broadcast(kept) if held_bytes(kept) <= limit else kept


def shuffled(df: DataFrame) -> DataFrame:
    """The side of a join that is never broadcast, however small it is."""
    return df.hint("merge")


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal relation whose size Spark knows."""
    fields = spark.createDataFrame([], schema).schema
    arrow = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}
    columns = [pa.array([r[i] for r in rows], arrow[f.dataType.simpleString()]) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.table(columns, names=fields.names), fields)
