"""The ledger of sent records in two steps: what an export intends to send, and that it was sent.

Every export is a run with a name. Before its file it writes the keys of its records and an intent, a
row with the file's folder; behind the file it writes a commit. Readers see the keys of committed runs.
Keys of an open intent are kept from other runs, so two exports at once do not send a record twice.
A run that died leaves an open intent: :func:`SentLedger.recover` commits it where its file is whole, else
takes it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrybook.operators.export import KEY, LEDGER
from ferrybook.session import broadcast_if_small
from ferrybook.sources.store import exists, replace_run

INTENT = "path string, records bigint"


class SentLedger:
    """Three tables under one folder, each partitioned by run: ``keys``, ``intents``, ``commits``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def file_of(self, run: str) -> str:
        return f"{self.folder}/files/run={run}"

    def _read(self, table: str, columns: str) -> DataFrame:
        path, schema = f"{self.folder}/{table}", f"{columns}, run string"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _put(self, table: str, rows: DataFrame, run: str) -> None:
        replace_run(rows.withColumn("run", F.lit(run)), f"{self.folder}/{table}", ["run"])

    def commits(self) -> DataFrame:
        return self._read("commits", INTENT)

    def open(self) -> DataFrame:
        """Intents without a commit: ``path, records, run``."""
        return self._read("intents", INTENT).join(self.commits().select("run"), "run", "left_anti")

    def sent(self) -> DataFrame:
        """Keys of the records that committed runs have sent, with the job that sent them."""
        return self._read("keys", LEDGER).join(broadcast_if_small(self.commits().select("run")), "run", "left_semi").drop("run")

    def taken(self, run: str) -> DataFrame:
        """Keys that a run must leave alone: those of committed runs and of open intents of others."""
        live = self.commits().select("run").union(self.open().select("run")).where(F.col("run") != run).distinct()
        return self._read("keys", LEDGER).join(broadcast_if_small(live), "run", "left_semi").select(*KEY)

    def intend(self, run: str, keys: DataFrame, records: int) -> None:
        """Keys first, then the intent that makes them count."""
        self._put("keys", keys, run)
        row = self.spark.range(1).select(F.lit(self.file_of(run)).alias("path"), F.lit(records).cast("bigint").alias("records"))
        self._put("intents", row, run)

    def clash(self, run: str) -> bool:
        """Has a run that goes first taken one of this run's records in the meantime? Of two open runs the smaller
        name goes first, so one of them sees the other and goes back."""
        first = self.commits().select("run").union(self.open().where(F.col("run") < run).select("run")).where(F.col("run") != run)
        keys = self._read("keys", LEDGER)
        theirs = keys.join(broadcast_if_small(first.distinct()), "run", "left_semi").select(*KEY)
        return bool(keys.where(F.col("run") == run).join(theirs, list(KEY), "left_semi").limit(1).count())

    def commit(self, run: str) -> None:
        self._put("commits", self._read("intents", INTENT).where(F.col("run") == run).drop("run"), run)

    def drop(self, run: str) -> None:
        """Take an open intent back, then its keys."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for table in ("intents", "keys"):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}/run={run}")
            path.getFileSystem(conf).delete(path, True)

    def recover(self, run: str | None = None) -> dict[str, str]:
        """Finish or drop open intents, all of them or one run's. Not for runs that are still at work."""
        done = {}
        for r in self.open().collect():  # as many as runs have died
            if run is None or r.run == run:
                whole = exists(self.spark, f"{r.path}/_SUCCESS")
                (self.commit if whole else self.drop)(r.run)
                done[r.run] = "committed" if whole else "dropped"
        return done
