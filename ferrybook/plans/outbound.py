"""Outbound: one exported set, computed once, feeds details, trailer and the sent mark."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrybook.operators.export import KEY, LEDGER, last_in_ledger, not_sent, precondition, sent_order, sent_rows, with_defaults
from ferrybook.operators.layout import encode
from ferrybook.session import new_folder, settle
from ferrybook.sources.ledger import SentLedger
from ferrybook.sources.sinks import append_ledger, merge_sections, write_merged

ORDER = ("sort_key", *KEY)


@dataclass(frozen=True)
class Parties:
    sender: str
    receiver: str
    file_type: str
    batch: str = "0000001"
    version: str = "10"


def routing_id(sender: Column, moment: Column) -> Column:
    return F.concat(sender, F.date_format(moment, "MMddyyyyHHmmss"))


def clock(moment: Column, hours: int = 12) -> Column:
    """Hour and minute of a header; partners get a 12-hour clock by default."""
    return F.date_format(moment, "hhmm" if hours == 12 else "HHmm")


def header_value(routing: Column, moment: Column, sender: Column, receiver: Column, parties: Parties, length: int) -> Column:
    # Widths of a header.
    fields = [
        (routing, 40), (F.lit("HD"), 2), (F.lit("T"), 1), (F.date_format(moment, "yyyyMMdd"), 8), (clock(moment), 4),
        (sender, 10), (receiver, 10), (F.lit(parties.batch), 7), (F.lit(parties.file_type), 1), (F.lit(parties.version), 2),
    ]
    used = sum(w for _, w in fields)
    return encode([*fields, (F.lit(""), length - used)])


def trailer_value(routing: Column, count: Column, parties: Parties, length: int) -> Column:
    fields = [
        (routing, 40), (F.lit("TR"), 2), (F.lit(parties.batch), 7), (F.lpad(count.cast("string"), 10, "0"), 10),
    ]
    used = sum(w for _, w in fields)
    return encode([*fields, (F.lit(""), length - used)])


@dataclass(frozen=True)
class Export:
    """The exported set, settled, and the file made of it."""

    exported: DataFrame
    parties: Parties
    moment: datetime
    length: int

    @classmethod
    def of(cls, selected: DataFrame, parties: Parties, moment: datetime, length: int) -> Export:
        return cls(settle(selected), parties, moment, length)

    @property
    def stamp(self) -> Column:
        return F.lit(self.moment.isoformat(sep=" ")).cast("timestamp_ntz")

    @property
    def routing(self) -> Column:
        return routing_id(F.lit(self.parties.sender), self.stamp)

    def header(self) -> DataFrame:
        value = header_value(
            self.routing, self.stamp, F.lit(self.parties.sender), F.lit(self.parties.receiver), self.parties, self.length
        )
        return self.exported.sparkSession.range(1).select(value.alias("value"))

    def details(self, fields: Sequence[tuple[Column, int]]) -> DataFrame:
        used = 40 + sum(w for _, w in fields)
        line = encode([(self.routing, 40), *fields, (F.lit(""), self.length - used)])
        return self.exported.select(
            sent_order(F.col("service_date"), F.col("transmission_time")).alias("sort_key"), *KEY, line.alias("value")
        )

    def trailer(self) -> DataFrame:
        count = self.exported.agg(F.count(F.lit(1)).alias("n"))
        return count.select(trailer_value(self.routing, F.col("n"), self.parties, self.length).alias("value"))

    def file(self, fields: Sequence[tuple[Column, int]], create_empty: bool) -> DataFrame:
        """Header, details and trailer; nothing at all for an unwanted empty file."""
        merged = merge_sections(self.header(), self.details(fields), self.trailer(), ORDER)
        if not create_empty and self.exported.isEmpty():
            return merged.limit(0)
        return merged


def run(
    setting: DataFrame, wanted: DataFrame, ledger: str, selected: DataFrame, defaults, parties: Parties, moment: datetime,
    length: int, fields: Sequence[tuple[Column, int]], job_key: int, out_jobs: DataFrame,
) -> tuple[str | None, int]:
    """One export: the folder of the file written and its number of records, (None, 0) where nothing is sent.

    ``setting`` is the row in force, ``wanted`` the waiting files (job_key); nothing is sent without a
    setting, or when no file is newer than the last export of ``out_jobs`` in the ledger. Records of the
    ledger are not sent again; the ones sent now are appended to it after the file is written.
    """
    spark = selected.sparkSession
    in_force = setting.select("create_empty").limit(1).collect()
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)  # so that it can be read
    sent = spark.read.schema(LEDGER).parquet(ledger)
    if not in_force or not precondition(wanted, last_in_ledger(sent, out_jobs)).first()["files"]:
        return None, 0
    export = Export.of(with_defaults(not_sent(selected, sent), defaults), parties, moment, length)
    n = export.exported.count()
    if not n and not in_force[0]["create_empty"]:
        return None, 0
    path = new_folder(spark, "outbound")
    write_merged(export.file(fields, create_empty=True), ORDER, path)
    append_ledger(sent_rows(export.exported, job_key), ledger)
    return path, n


class Clash(RuntimeError):
    """Another export that goes first has taken some of the records."""


def run_export(
    ledger: SentLedger, run: str, setting: DataFrame, wanted: DataFrame, selected: DataFrame, defaults, parties: Parties,
    moment: datetime, length: int, fields: Sequence[tuple[Column, int]], job_key: int, out_jobs: DataFrame,
) -> tuple[str | None, int]:
    """One export under a name, in steps that can be taken up again: intent, file, commit.

    A committed run gives its file again. One that died before is finished where its file is whole, else
    it starts anew. Records that others have sent, or are about to send, are left out; a run that
    finds itself overtaken takes its intent back and raises :class:`Clash`.
    """
    ledger.recover(run)
    done = ledger.commits().where(F.col("run") == run).first()
    if done:
        return done["path"], done["records"]
    in_force = setting.select("create_empty").limit(1).collect()
    if not in_force or not precondition(wanted, last_in_ledger(ledger.sent(), out_jobs)).first()["files"]:
        return None, 0
    free = selected.join(ledger.taken(run), list(KEY), "left_anti")
    export = Export.of(with_defaults(free, defaults), parties, moment, length)
    n = export.exported.count()
    if not n and not in_force[0]["create_empty"]:
        return None, 0
    ledger.intend(run, sent_rows(export.exported, job_key), n)
    if ledger.clash(run):
        ledger.drop(run)
        raise Clash(run)
    write_merged(export.file(fields, create_empty=True), ORDER, ledger.file_of(run), "overwrite")
    ledger.commit(run)
    return ledger.file_of(run), n
