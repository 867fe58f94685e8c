"""A stored table with deletes, updates and reloads, on plain Parquet.

Rows lie in generations: ``base/part=<bucket of the key>/gen=<version>``. A delete writes keys, an update
writes keys with the new values of the mutable columns, both as patches beside the rows; readers merge
them. A patch counts for rows of generations before it, so a reload is a delete and an append of one
version. :meth:`Table.compact` rewrites the parts that have patches, and no others, as a new generation.

Every change is a run with a name. Its files count once its commit, one small file, is written: a run
that died leaves nothing that counts, and a repeated run changes nothing. Changes are made by one
writer at a time; readers need no care.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrybook.session import broadcast_if_small
from ferrybook.sources.store import exists, replace_run

ROWS, REWRITE, PATCH = "rows", "rewrite", "patch"
COMMIT = "version int, kind string, part int, source int, run string"


class Table:
    """``schema`` names the columns, ``key`` those that identify a row (rows with a null there cannot be
    patched), ``bucket`` is an integer SQL expression over the key, ``mutable`` the columns that updates set."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: Sequence[str], bucket: str, mutable: Sequence[str] = ()):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.key, self.bucket, self.mutable = list(key), bucket, list(mutable)
        fields = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], schema).schema}
        self.columns = list(fields)
        self.patch = ", ".join(f"`{c}` {fields[c]}" for c in [*self.key, *self.mutable]) + ", deleted boolean"

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def commits(self) -> DataFrame:
        """``version, kind, part, source, run``: what committed runs have changed, one row per kind and part."""
        return self._read("commits", COMMIT)

    def version(self) -> int:
        return self.commits().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def changed(self, since: int = 0) -> DataFrame:
        """Parts whose rows differ from those of a version; a compaction changes none."""
        return self.commits().where((F.col("version") > since) & F.col("kind").isin(ROWS, PATCH)).select("part").distinct()

    def _live(self) -> DataFrame:
        """Generations that readers see: a part's last rewrite and what came behind it."""
        held = self.commits().where(F.col("kind").isin(ROWS, REWRITE))
        last = held.where(F.col("kind") == REWRITE).groupBy("part").agg(F.max("version").alias("last"))
        held = held.join(broadcast_if_small(last), "part", "left")
        return held.where(F.col("version") >= F.coalesce("last", F.lit(0))).select("part", F.col("version").alias("gen")).distinct()

    def _open(self) -> DataFrame:
        """Patches newer than the last rewrite of their part."""
        last = self.commits().where(F.col("kind") == REWRITE).groupBy("part").agg(F.max("version").alias("last"))
        patches = self.commits().where(F.col("kind") == PATCH).join(broadcast_if_small(last), "part", "left")
        return patches.where(F.col("version") > F.coalesce("last", F.lit(0))).select("part", "version").distinct()

    def rows(self, parts: DataFrame | None = None) -> DataFrame:
        """The table as of the last commit, or only some parts of it."""
        live, patches = self._live(), self._open()
        if parts is not None:
            parts = broadcast_if_small(parts.select("part"))
            live, patches = live.join(parts, "part", "left_semi"), patches.join(parts, "part", "left_semi")
        base = self._read("base", f"{self.schema}, part int, gen int").join(broadcast_if_small(live), ["part", "gen"], "left_semi")
        if patches.isEmpty():
            return base.select(*self.columns)
        given = self._read("patches", f"{self.patch}, version int, part int").join(broadcast_if_small(patches), ["part", "version"], "left_semi")
        # numbers only: the newest delete and the newest update of every key, then the values of that update
        newest = given.groupBy(*self.key).agg(
            F.max(F.when(F.col("deleted"), F.col("version"))).alias("_gone"), F.max(F.when(~F.col("deleted"), F.col("version"))).alias("_set")
        )
        values = given.where(~F.col("deleted")).select(*self.key, F.col("version").alias("_set"), *[F.col(c).alias(f"_new_{c}") for c in self.mutable])
        newest = newest.join(values, [*self.key, "_set"], "left")
        merged = base.join(broadcast_if_small(newest), self.key, "left").where(F.coalesce(F.col("_gone") <= F.col("gen"), F.lit(True)))
        set_here = F.coalesce(F.col("_set") > F.col("gen"), F.lit(False))
        return merged.select(*[F.when(set_here, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in self.mutable else c for c in self.columns])

    def done(self, run: str) -> bool:
        return not self.commits().where(F.col("run") == run).isEmpty()

    def _put(self, rows: DataFrame, version: int) -> DataFrame:
        """Write a generation; the parts it has rows in."""
        placed = rows.select(*self.columns, F.expr(self.bucket).cast("int").alias("part"), F.lit(version).alias("gen"))
        replace_run(placed, f"{self.folder}/base", ["part", "gen"])
        return self._read("base", f"{self.schema}, part int, gen int").where(F.col("gen") == version).select("part").distinct()

    def _patch(self, rows: DataFrame, version: int, deleted: bool) -> DataFrame:
        """Write a version's patches; the parts they fall into. A repeated key counts once."""
        values = [F.lit(None).alias(c) if deleted else F.col(c) for c in self.mutable]
        names = self.spark.createDataFrame([], self.patch).schema
        rows = rows.dropDuplicates(self.key).select(*self.key, *values).withColumn("deleted", F.lit(deleted))
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in names], F.lit(version).alias("version"), F.expr(self.bucket).cast("int").alias("part"))
        replace_run(rows, f"{self.folder}/patches", ["version", "part"])
        return self._read("patches", f"{self.patch}, version int, part int").where(F.col("version") == version).select("part").distinct()

    def _commit(self, run: str, version: int, changes: dict[str, DataFrame], source: int | None = None) -> None:
        rows = [parts.select(F.lit(kind).alias("kind"), "part") for kind, parts in changes.items()]
        rows.append(self.spark.range(1).select(F.lit("run").alias("kind"), F.lit(None).cast("int").alias("part")))
        out = rows[0]
        for more in rows[1:]:
            out = out.unionByName(more)
        out = out.select(F.lit(version).alias("version"), "kind", "part", F.lit(source).cast("int").alias("source"), F.lit(run).alias("run"))
        replace_run(out.coalesce(1), f"{self.folder}/commits", ["run"])

    def _change(self, run: str, rows: DataFrame | None = None, gone: DataFrame | None = None, values: DataFrame | None = None) -> None:
        if self.done(run):
            return
        version = self.version() + 1
        self._forget(version)
        changes = {}
        if gone is not None:
            changes[PATCH] = self._patch(gone, version, True)
        if values is not None:
            changes[PATCH] = self._patch(values, version, False)
        if rows is not None:
            changes[ROWS] = self._put(rows, version)
        self._commit(run, version, changes)

    def append(self, run: str, rows: DataFrame) -> None:
        """Add rows; their keys are new."""
        self._change(run, rows=rows)

    def delete(self, run: str, keys: DataFrame) -> None:
        """Delete the rows with these keys."""
        self._change(run, gone=keys)

    def update(self, run: str, rows: DataFrame) -> None:
        """Set the mutable columns, all of them, of the rows with these keys."""
        self._change(run, values=rows)

    def reload(self, run: str, rows: DataFrame, keys: DataFrame) -> None:
        """Delete and add in one commit; added rows may have keys of deleted ones."""
        self._change(run, rows=rows, gone=keys)

    def compact(self, run: str) -> None:
        """Rewrite the parts that have patches newer than their last rewrite."""
        if self.done(run):
            return
        self._rewrite(run, self._open().select("part").distinct(), self.rows)

    def refresh(self, run: str, source: Table, build: Callable[[DataFrame], DataFrame]) -> None:
        """Keep this table equal to ``build`` over all rows of ``source``, computing only the parts that changed there
        since the last refresh. Both share key and bucket; ``build`` keeps rows in their part."""
        if self.done(run):
            return
        seen, now = self.commits().agg(F.coalesce(F.max("source"), F.lit(0))).first()[0], source.version()
        self._rewrite(run, source.changed(seen), lambda parts: build(source.rows(parts)), now)

    def _rewrite(self, run: str, parts: DataFrame, rows: Callable[[DataFrame], DataFrame], source: int | None = None) -> None:
        version = self.version() + 1
        self._forget(version)
        self._put(rows(parts), version)
        self._commit(run, version, {REWRITE: parts}, source)

    def _forget(self, version: int) -> None:
        """Files that a run left which died under the version that is due now."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/base/part=*/gen={version}")
        files = path.getFileSystem(conf)
        for status in files.globStatus(path) or []:
            files.delete(status.getPath(), True)
        files.delete(jvm.org.apache.hadoop.fs.Path(f"{self.folder}/patches/version={version}"), True)
