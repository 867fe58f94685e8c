"""The hub's memory between runs: what earlier runs took in, written per run and seen once a run is committed.

Every table is partitioned by run, next to what reads prune by (the day of a file, a bucket of its name). A
run replaces its own partitions and nothing else, so repeating it adds nothing. Its last act is one row
in ``runs``; readers see committed runs only, so a run that died leaves nothing behind that counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrybook.operators.intake import latest
from ferrybook.session import broadcast_if_small

NAME_BUCKETS = 64

# columns of a table before its partition columns, and these without the run; ``key`` is the type of job keys
TABLES = {
    "files": ("job_key {key}, feed_id int, file_type string, file_name string, start_ts timestamp_ntz, state string", "day date"),
    "names": ("file_name string, job_key {key}", "bucket int"),
    "log": ("job_key {key}, event_no bigint, step string, state string, records bigint, message string", ""),
    "runs": ("stamp string", ""),
}


def name_bucket(name: Column) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(NAME_BUCKETS)).cast("int")


class Store:
    """Tables under one folder. ``key`` is the SQL type of job keys."""

    def __init__(self, spark: SparkSession, folder: str, key: str = "bigint"):
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), key

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def schema(self, table: str) -> str:
        columns, part = TABLES[table]
        return ", ".join(x for x in (columns.format(key=self.key), part, "run string") if x)

    def _raw(self, table: str) -> DataFrame:
        if not exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], self.schema(table))
        return self.spark.read.schema(self.schema(table)).parquet(self.path(table))

    def _parts(self, table: str) -> list[str]:
        part = TABLES[table][1]
        return [*([part.split()[0]] if part else []), "run"]

    def runs(self) -> DataFrame:
        """Committed runs."""
        return self._raw("runs").select("run").distinct()

    def read(self, table: str, but: str | None = None) -> DataFrame:
        """Rows of committed runs, those of one run left out."""
        rows = self._raw(table)
        if but is not None:
            rows = rows.where(F.col("run") != but)
        return rows.join(broadcast_if_small(self.runs()), "run", "left_semi").select(*rows.columns)

    def put(self, table: str, rows: DataFrame, run: str) -> None:
        """Replace a run's part of a table."""
        columns = [c.strip().split()[0] for c in self.schema(table).split(",")]
        rows, parts = rows.withColumn("run", F.lit(run)).select(*columns), self._parts(table)
        if len(parts) > 1:  # a file or a few per day or bucket, not one per task in each
            rows = rows.hint("rebalance", *parts[:-1])
        replace_run(rows, self.path(table), parts)

    def job_states(self) -> DataFrame:
        """``job_key, events, event_no, step, state, records, message``: what the log says of every job last.

        The state is kept as numbered snapshots. A call merges the last one with the log of the runs committed
        since, reads no older part of the log, and writes the next snapshot; its list of runs, written
        last, makes it count.
        """
        columns = ["step", "state", "records", "message"]
        kinds = f"job_key {self.key}, events bigint, event_no bigint, step string, state string, records bigint, message string"
        version, seen = 0, self.spark.createDataFrame([], "run string")
        if exists(self.spark, self.path("state_runs")):
            listed = self.spark.read.schema("run string, version int").parquet(self.path("state_runs"))
            version = listed.agg(F.max("version")).first()[0]
            seen = listed.where(F.col("version") == version).select("run")
        last = self.spark.createDataFrame([], kinds)
        if version:
            last = self.spark.read.schema(kinds).parquet(f"{self.path('state')}/version={version}")
        fresh = [r.run for r in self.runs().join(seen, "run", "left_anti").collect()]  # since the last call
        if not fresh:
            return last
        events = self._raw("log").where(F.col("run").isin(fresh)).withColumn("events", F.lit(1).cast("bigint")).drop("run")
        merged = latest(last.unionByName(events), "job_key", "event_no", columns)
        path = f"{self.path('state')}/version={version + 1}"
        merged.write.mode("overwrite").parquet(path)
        runs = seen.union(self.spark.createDataFrame([(r,) for r in fresh], "run string"))
        runs.write.mode("overwrite").parquet(f"{self.path('state_runs')}/version={version + 1}")
        return self.spark.read.schema(kinds).parquet(path)

    def commit(self, run: str, stamp: str = "") -> None:
        """From now on the run counts."""
        self.put("runs", self.spark.range(1).select(F.lit(stamp).alias("stamp")), run)


def exists(spark: SparkSession, path: str) -> bool:
    """Is there such a folder or file, in whatever store Spark reads?"""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def replace_run(rows: DataFrame, path: str, parts: Sequence[str]) -> None:
    """Overwrite the partitions that the rows fall into; others stay as they are."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
