"""File structure checks. The first error of a file wins; one hash aggregate and a few looked-up lines give the verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import astuple, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrybook.functions import kinds as K
from ferrybook.functions import messages as M
from ferrybook.functions.messages import message, quote
from ferrybook.functions.text import length_sql, strip_sql
from ferrybook.operators.catalogue import RuledColumn
from ferrybook.session import broadcast_if_small, settle, shuffled

SUCCESS, FAIL, INCOMPLETE = "Success", "Fail", "Incomplete"


@dataclass(frozen=True)
class StructureSpec:
    """Positions are 0-based with the end excluded."""

    line_length: int
    header_id: str
    header_at: tuple[int, int]
    trailer_id: str
    trailer_at: tuple[int, int]
    header_batch: tuple[int, int]
    trailer_batch: tuple[int, int]
    trailer_count: tuple[int, int]
    sender_at: tuple[int, int]
    receiver_at: tuple[int, int]
    sender: str
    receiver: str

    columns = ()  # of a line that checks look at beside its text

    @classmethod
    def from_row(cls, row, line_length: int) -> StructureSpec:
        """From the one-row table partners keep their positions in."""

        def at(name: str) -> tuple[int, int]:
            return int(row[f"{name}_POS_START"]), int(row[f"{name}_POS_END"])

        return cls(
            line_length, row["HEADER_IDENTIFIER"], at("HEADER"), row["TRAILER_IDENTIFIER"], at("TRAILER"),
            at("HEADER_BATCH_ID"), at("TRAILER_BATCH_ID"), at("TRAILER_RECORD_COUNT"), at("SENDER_ID"),
            at("RECEIVER_ID"), row["SENDER_ID_VALUE"], row["RECEIVER_ID_VALUE"],
        )

    def sql(self, name: str) -> str:
        """SQL text of a number or a text."""
        value = getattr(self, name)
        return str(value) if isinstance(value, int) else quote(value)

    def cut(self, name: str) -> str:
        """SQL text of the slice of a line at a position."""
        return _cut(getattr(self, name))


class SpecColumn:
    """The same for lines that carry their own spec in a struct column: one scan for the files of many feeds."""

    NAME = "_spec"
    columns = (NAME,)

    def sql(self, name: str) -> str:
        return f"{self.NAME}.{name}"

    def cut(self, name: str) -> str:
        at = self.sql(name)
        return f"substring(value, {at}[0] + 1, {at}[1] - {at}[0])"


def spec_table(spark: SparkSession, specs: Mapping[int, StructureSpec]) -> DataFrame:
    """``feed_id, _spec``: a row per feed."""
    spans = [f.name for f in fields(StructureSpec) if f.type.startswith("tuple")]
    kinds = {f.name: "int" if f.name == "line_length" else "array<int>" if f.name in spans else "string" for f in fields(StructureSpec)}
    rows = [(feed, *(list(v) if isinstance(v, tuple) else v for v in astuple(spec))) for feed, spec in sorted(specs.items())]
    table = spark.createDataFrame(rows, "feed_id int, " + ", ".join(f"{n} {k}" for n, k in kinds.items()))
    return table.select("feed_id", F.struct("feed_id", *kinds).alias(SpecColumn.NAME))


Spec = StructureSpec | SpecColumn


def _cut(at: tuple[int, int]) -> str:
    return f"substring(value, {at[0] + 1}, {at[1] - at[0]})"


def marked(lines: DataFrame, spec: Spec, keep: Sequence[str]) -> DataFrame:
    """What every check looks at, cut once per line. Narrow."""
    return lines.selectExpr(
        *keep,
        *spec.columns,
        "line_number",
        "value",
        f"{length_sql('value')} as _length",
        f"{spec.cut('header_at')} = {spec.sql('header_id')} as _is_header",
        f"line_number > 1 and {spec.cut('header_at')} <> {spec.sql('header_id')}"
        f" and {spec.cut('trailer_at')} = {spec.sql('trailer_id')} as _is_trailer",
        # parties are told by the first line alone
        f"case when line_number = 1 then {strip_sql(spec.cut('sender_at'))} end as _sender",
        f"case when line_number = 1 then {strip_sql(spec.cut('receiver_at'))} end as _receiver",
        f"{spec.cut('trailer_count')} as _count_text",
        f"{spec.cut('header_batch')} as _head_batch",
        f"{spec.cut('trailer_batch')} as _tail_batch",
    )


def _line_message(template: str, **values: str) -> str:
    return message(template, {"line": "line_number", **values})


def length_error(spec: Spec) -> str:
    expected = spec.sql("line_length")
    return f"case when _length <> {expected} then {_line_message(M.LINE_LENGTH, length='_length', expected=expected)} end"


def header_error(spec: Spec) -> str:
    return f"case when line_number = 1 and not _is_header then {_line_message(M.NO_HEADER)} end"


def party_error(spec: Spec) -> str:
    sender, receiver = spec.sql("sender"), spec.sql("receiver")
    return (
        f"case when line_number <> 1 or not _is_header then null"
        f" when _sender <> {sender} then {_line_message(M.SENDER, value='_sender', expected=sender)}"
        f" when _receiver <> {receiver} then {_line_message(M.RECEIVER, value='_receiver', expected=receiver)} end"
    )


def second_header_error(spec: Spec) -> str:
    return f"case when line_number > 1 and _is_header then {_line_message(M.SECOND_HEADER)} end"


def detail_error(columns: Sequence[RuledColumn] | str) -> str:
    """REQUIRED and EQUALTO rules of detail lines, for feeds where they count as structure; SQL text stays as it is."""
    if isinstance(columns, str):
        return columns
    errors = []
    for c in columns:
        v = _cut((c.start, c.end))
        s = strip_sql(v)
        for r in c.rules:
            constants = dict(
                name=c.name, pos=c.report_position, code=r.error_code, level=r.error_level, expected=r.equal_to
            )
            values = {"line": "line_number", "value": s}
            if r.kind == "REQUIRED":
                text = message(M.DETAIL_REQUIRED, values, **constants)
                errors.append(f"when {s} = '' then {text}")
            elif r.kind == "EQUALTO" and r.equal_to:
                text = message(M.DETAIL_EQUAL_TO, values, **constants)
                errors.append(f"when {s} <> {quote(r.equal_to)} then {text}")
    if not errors:
        return K.PASSED
    return f"case when line_number = 1 or _is_header or _is_trailer then null {' '.join(errors)} end"


def check_lines(lines: DataFrame, spec: StructureSpec, error: str, keep: Sequence[str] = ("job_key",)) -> DataFrame:
    """All lines one check complains about.

    The generator keeps Spark from evaluating the check twice, in a pushed-down filter and again.
    """
    return (
        marked(lines, spec, keep)
        .selectExpr(*keep, "line_number", f"explode_outer(array({error})) as message")
        .where(F.col("message").isNotNull())
    )


def _line_error(spec: Spec) -> str:
    return f"coalesce({length_error(spec)}, {header_error(spec)}, {party_error(spec)}, {second_header_error(spec)})"


def _good_head(spec: Spec) -> str:
    return f"line_number = 1 and _is_header and _length = {spec.sql('line_length')}"


def numbers(
    lines: DataFrame, spec: Spec, keep: Sequence[str] = ("job_key",), detail_rules: Sequence[RuledColumn] | str = ()
) -> DataFrame:
    """What a verdict needs of a file as numbers alone: one hash aggregate with partial sums.

    The first error is its line number and rank in one long; batches are compared by hashes. The line
    after the first trailer is ``trailer + 1``, as numbered lines are consecutive there. It is a
    second trailer exactly when the smallest trailer of the other parity is that line, so two minima
    replace a list of trailer lines.
    """
    work = marked(lines, spec, keep).selectExpr(
        "*", f"({_line_error(spec)}) is not null as _error", f"({detail_error(detail_rules)}) is not null as _detail_error",
        f"{_good_head(spec)} as _head",
    )
    return work.groupBy(*keep, *spec.columns).agg(
        *[
            F.expr(sql).alias(name)
            for name, sql in {
                "lines": "count(1)",
                "last_line": "max(line_number)",
                "details": "count(case when line_number > 1 and not _is_header and not _is_trailer then 1 end)",
                "trailers": "count(case when _is_trailer then 1 end)",
                "even_trailer": "min(case when _is_trailer and line_number % 2 = 0 then line_number end)",
                "odd_trailer": "min(case when _is_trailer and line_number % 2 <> 0 then line_number end)",
                "_stated": f"max(case when _is_trailer and _count_text rlike '{K.DIGITS}' then coalesce(try_cast(_count_text as bigint), -1) end)",
                "_tail": "max(case when _is_trailer then xxhash64(_tail_batch) end)",
                "_head": "max(case when _head then xxhash64(_head_batch) end)",
                "_first": "min(case when _error then line_number * 4 when _detail_error then line_number * 4 + 2 end)",
            }.items()
        ]
    ).withColumn("trailer_line", F.expr("least(even_trailer, odd_trailer)"))


# A file of which the numbers alone tell that nothing is wrong: the sender and receiver are the expected ones.
PLAIN = (
    "_first is null and trailers = 1 and last_line = trailer_line and _head is not null"
    " and coalesce(_stated = details, false) and _head = _tail"
)


def with_texts(
    lines: DataFrame, files: DataFrame, spec: Spec, keep: Sequence[str] = ("job_key",), detail_rules: Sequence[RuledColumn] | str = (),
    spread: bool = False,
) -> DataFrame:
    """Rows of :func:`numbers` with ``trailer``, ``header`` and ``first_error``, from three lines of a file at most.

    ``files`` are stored rows; their lines are found by a join on the file and the line number. Only first lines,
    trailers and lines with an error can be among them, so no other line gets to the join. With ``spread``
    no side is broadcast, for callers that come again and again: what they send to the driver would add up. Their
    lines lie dealt out by file and are joined by it, so that they need not be dealt out again.
    """
    side = shuffled if spread else broadcast_if_small
    at = F.expr("array_distinct(array_compact(array(1L, trailer_line, _first div 4)))")
    if spread:
        met = marked(lines.join(shuffled(files.select(*keep, at.alias("_at"))), list(keep)).where("array_contains(_at, line_number)"), spec, keep)
    else:
        asked = f"line_number = 1 or _is_trailer or ({_line_error(spec)}) is not null or ({detail_error(detail_rules)}) is not null"
        # the generator keeps the condition on cut columns from being pushed to where it would cut them again
        able = marked(lines, spec, keep).selectExpr("*", f"explode_outer(array({asked})) as _asked").where("_asked")
        met = able.join(broadcast_if_small(files.select(*keep, F.explode(at).alias("line_number"))), [*keep, "line_number"])
    told = met.selectExpr(
        *keep,
        f"""named_struct('line_number', line_number, 'error', {_line_error(spec)}, 'detail', {detail_error(detail_rules)},
          'stated', _count_text, 'tail', _tail_batch, 'head', {_good_head(spec)}, 'batch', _head_batch,
          'sender', _sender, 'receiver', _receiver) as line""",
    )
    told = told.groupBy(*keep).agg(F.collect_list("line").alias("_lines"))
    line = "get(filter(_lines, x -> {}), 0)".format
    return (
        files.join(side(told), list(keep), "left")
        .selectExpr(
            "*", f"{line('x.line_number = trailer_line')} as _t", f"{line('x.line_number = 1 and x.head')} as _h",
            f"{line('x.line_number = _first div 4')} as _e",
        )
        .selectExpr(
            *[f"`{c}`" for c in files.columns],
            "case when _t is not null then named_struct('line_number', trailer_line, 'stated', _t.stated, 'batch', _t.tail) end as trailer",
            "case when _h is not null then named_struct('sender', _h.sender, 'receiver', _h.receiver, 'batch', _h.batch) end as header",
            "case when _first is not null then named_struct('line_number', _first div 4, 'rank', cast(_first % 4 as int),"
            " 'message', coalesce(_e.error, _e.detail)) end as first_error",
        )
    )


def summarise(
    lines: DataFrame, spec: Spec, keep: Sequence[str] = ("job_key",), detail_rules: Sequence[RuledColumn] | str = (), where: str = "true"
) -> DataFrame:
    """Numbers and texts of every file, or of those whose numbers meet a condition."""
    counted = settle(numbers(lines, spec, keep, detail_rules))
    return with_texts(lines, counted.where(where), spec, keep, detail_rules)


def after_trailer(files: DataFrame) -> DataFrame:
    """Adds the line behind the first trailer, if any, and its kind."""
    return files.selectExpr(
        "*",
        "case when last_line > trailer.line_number then trailer.line_number + 1 end as after_line",
        "greatest(even_trailer, odd_trailer) = trailer.line_number + 1 and even_trailer is not null"
        " and odd_trailer is not null as after_is_trailer",
    )


DIGITS_ERROR = (
    f"case when not trailer.stated rlike '{K.DIGITS}' then "
    + message(M.TRAILER_COUNT, {"line": "trailer.line_number", "value": "trailer.stated"})
    + " end"
)
SECOND_TRAILER_ERROR = (
    f"case when after_line is not null and after_is_trailer then {message(M.SECOND_TRAILER, {'line': 'after_line'})} end"
)
DETAIL_AFTER_ERROR = (
    f"case when after_line is not null and not coalesce(after_is_trailer, false)"
    f" then {message(M.DETAIL_AFTER, {'line': 'after_line'})} end"
)
STATED = f"case when trailer.stated rlike '{K.DIGITS}' then coalesce(try_cast(trailer.stated as bigint), -1) end"
COUNT_ERROR = (
    f"case when {STATED} <> details then "
    + message(M.COUNT_MISMATCH, {"lines": "lines", "found": "details", "stated": STATED})
    + " end"
)
BATCH_ERROR = (
    "case when header.batch <> trailer.batch then "
    + message(M.BATCH_MISMATCH, {"line": "lines + 1", "header": "header.batch", "trailer": "trailer.batch"})
    + " end"
)
NO_TRAILER_ERROR = f"case when trailer is null then {quote(M.NO_TRAILER)} end"


def check_files(
    lines: DataFrame, spec: StructureSpec, error: str, keep: Sequence[str] = ("job_key",)
) -> DataFrame:
    """All files one file-level check complains about. Files of which the numbers tell that nothing is wrong are not looked up."""
    known = " and ".join(f"`{c}` is not null" for c in keep)
    return (
        after_trailer(summarise(lines, spec, keep, where=f"not coalesce({PLAIN} and {known}, false)"))
        .selectExpr(*keep, f"{error} as message")
        .where(F.col("message").isNotNull())
    )


def verdict(
    lines: DataFrame,
    spec: Spec,
    keep: Sequence[str] = ("job_key",),
    detail_rules: Sequence[RuledColumn] | str = (),
    listing: DataFrame | None = None,
    spread: bool = False,
) -> DataFrame:
    """One row per file: status, first error, record count, sender and receiver.

    The numbers of all files are stored first; only files that do not pass by them are looked up for the
    texts of their message. A file without a line is known from a ``listing`` of the keys alone; it
    has no trailer. With a :class:`SpecColumn` every line carries its spec. ``spread`` as in :func:`with_texts`.
    """
    counted = settle(numbers(lines, spec, keep, detail_rules))
    passed = counted.where(PLAIN).selectExpr(
        *keep, f"'{SUCCESS}' as status", "'' as error_message", "lines - 2 as record_count",
        f"{spec.sql('sender')} as sender", f"{spec.sql('receiver')} as receiver",
    )
    files = after_trailer(with_texts(lines, counted.where(f"not coalesce({PLAIN}, false)"), spec, keep, detail_rules, spread))
    found = files.selectExpr(
        "*",
        f"""array_min(array_compact(array(
            case when first_error is not null then
              named_struct('line', first_error.line_number, 'rank', first_error.rank, 'message', first_error.message) end,
            case when trailer is not null and {DIGITS_ERROR} is not null then
              named_struct('line', trailer.line_number, 'rank', 1, 'message', {DIGITS_ERROR}) end,
            case when after_line is not null then
              named_struct('line', after_line, 'rank', 1,
                           'message', coalesce({SECOND_TRAILER_ERROR}, {DETAIL_AFTER_ERROR})) end
        ))).message as line_message""",
    )
    told = found.selectExpr(
        *keep,
        f"coalesce(line_message, {NO_TRAILER_ERROR}, {COUNT_ERROR}, {BATCH_ERROR}) as _found",
        "lines",
        "header",
    ).selectExpr(
        *keep,
        f"case when _found is null then '{SUCCESS}' else '{FAIL}' end as status",
        "coalesce(_found, '') as error_message",
        "case when _found is null then lines - 2 else cast(0 as bigint) end as record_count",
        "coalesce(header.sender, '') as sender",
        "coalesce(header.receiver, '') as receiver",
    )
    told = passed.unionByName(told)
    if listing is None:
        return told
    return listing.select(*keep).join(shuffled(told) if spread else told, list(keep), "left").selectExpr(
        *keep,
        f"coalesce(status, '{FAIL}') as status",
        f"coalesce(error_message, {quote(M.NO_TRAILER)}) as error_message",
        "coalesce(record_count, cast(0 as bigint)) as record_count",
        "coalesce(sender, '') as sender",
        "coalesce(receiver, '') as receiver",
    )


def already_processed(arrivals: DataFrame, archive: DataFrame) -> DataFrame:
    """Arrived files whose base name is in the archive listing."""
    name = F.substring_index("path", "/", -1)
    return (
        arrivals.withColumn("name", name)
        .join(archive.select(name.alias("name")), "name", "left_semi")
        .drop("name")
    )


def flag_hold(files: DataFrame, feeds: DataFrame) -> DataFrame:
    """Files of feeds with a check switched off are parked as Incomplete, with their count."""
    off = ~F.col("check_structure") | ~F.col("check_details")
    told: Column = F.when(~F.col("check_structure"), "structure").when(~F.col("check_details"), "details")
    return (
        files.join(feeds.select("feed_id", "check_structure", "check_details"), "feed_id")
        .where(off)
        .select(
            "job_key",
            "feed_id",
            told.alias("flag"),
            F.lit(INCOMPLETE).alias("status"),
            (F.col("lines") - 2).alias("record_count"),
        )
    )


def field_findings(lines: DataFrame, config: dict, keep: Sequence[str] = ("job_key", "line_number")) -> DataFrame:
    """The light variant: a field config (required, range, date) and every error of every line."""
    errors = []
    for name, spec in config.items():
        start, end = spec["position"]
        v = _cut((start, end))
        s = strip_sql(v)
        # The texts of the light checks.
        if spec.get("required"):
            errors.append((name, f"case when {s} = '' then {quote(f'Field {name} is required but does not have a value')} end"))
        if "range" in spec:
            allowed = K.any_of(x.lower() for x in spec["range"])
            text = f"concat({quote(f'Expected {name}')}, '\\'s value, ', {v}, {quote(f', to be in range: {spec['range']}')})"
            errors.append((name, f"case when lower({s}) not in ({allowed}) then {text} end"))
        if spec.get("format") == "$date":
            text = f"concat({quote(f'Field {name} does not contain a valid date (')}, {v}, ')')"
            errors.append((name, f"case when ({K.parsed_day(v)}) is null then {text} end"))
    structs = ", ".join(
        f"case when ({e}) is not null then named_struct('field', {quote(n)}, 'message', {e}) end" for n, e in errors
    )
    return lines.selectExpr(*keep, f"array_compact(array({structs})) as found").select(
        *keep, F.inline_outer("found")
    ).where(F.col("field").isNotNull())


def file_findings(lines: DataFrame, spec: StructureSpec, detail_id: str) -> DataFrame:
    """The light file checks: first line a header, last line a trailer, details in between.

    The kind of a line is a digit behind its number, so the ends of a file are a minimum and a maximum of longs.
    """
    kind = spec.cut("header_at")
    code = f"case {kind} when {quote(spec.header_id)} then 1 when {quote(spec.trailer_id)} then 2 when {quote(detail_id)} then 3 else 0 end"
    ends = lines.selectExpr("job_key", f"line_number * 4 + {code} as _at").groupBy("job_key").agg(
        F.min("_at").alias("first"),
        F.max("_at").alias("last"),
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.col("_at") % 4 != 3, 1)).alias("other"),
    )
    first, last = F.col("first") % 4, F.col("last") % 4
    outside = F.col("other") - (first != 3).cast("int") - ((last != 3) & (F.col("lines") > 1)).cast("int")
    found = F.array_compact(
        F.array(
            F.when(first != 1, F.lit("first line is no header")),
            F.when(last != 2, F.lit("last line is no trailer")),
            F.when(outside > 0, F.lit("line between is no detail")),
        )
    )
    return ends.select("job_key", F.explode(found).alias("check_name"))
