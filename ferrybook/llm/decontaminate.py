"""Benchmark decontamination by winnowing, with built-in functions only.

A window is 13 consecutive words of an item; a shorter item is one window as a whole. With ``t = 13``,
``k = 5`` and ``w = t - k + 1``, both sides are winnowed: of every ``w`` consecutive k-grams the one with
the smallest hash is kept with its place. Two texts that share ``t`` words share ``w`` k-grams in the same
order, so they keep the same one: no window is missed. Documents' fingerprints are joined with the
items'; each hit is extended to the windows that can hold it, whose words are then compared as text.

Items shorter than a window leave no room for winnowing. They take a pass of their own, for each of
their lengths: hashes of all runs of so many words, met with the items' while the texts are read and
not stored. So a short item does not thin the winnowing of the others.

A fingerprint is one long: the upper 34 bits of the k-gram's hash, then 30 bits of place. Its minimum
over a stretch is found by doubling, and only hits leave the scan. Whether the items' fingerprints
are broadcast is Spark's choice by their stored size; beyond it the same join shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrybook.llm.common import scratch, stored
from ferrybook.session import broadcast_if_small

WINDOW = 13
GRAM = 5
PLACE_BITS = 30
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; none of a null one."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    # plain ASCII has a fast path; elsewhere other capitals must stay as they are
    low = F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(F.translate(whole, CAPITALS, SMALL))
    return F.array_remove(F.split(low, SEPARATORS), "")


def _fingerprints(df: DataFrame) -> DataFrame:
    """df with ``w`` (words) -> the same with ``codes``: the kept fingerprints."""
    k = GRAM
    span = WINDOW - k + 1
    mask = -(1 << PLACE_BITS)
    df = df.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    first = F.slice("h", 1, F.greatest(F.size("h") - (k - 1), F.lit(0)))
    code = lambda x, i: F.xxhash64(x, *[F.col("h")[i + j] for j in range(1, k)]).bitwiseAND(F.lit(mask)).bitwiseOR(i)
    df = df.withColumn("g", F.transform(first, code)).drop("h").withColumn("m", F.col("g"))
    least = lambda a, b: F.least(a, b)
    width = 1
    while 2 * width <= span:
        df = df.withColumn("m", F.zip_with("m", F.slice("m", width + 1, F.size("m")), least))
        width *= 2
    if width < span:
        df = df.withColumn("m", F.zip_with("m", F.slice("m", span - width + 1, F.size("m")), least))
    full = F.slice("m", 1, F.greatest(F.size("g") - (span - 1), F.lit(0)))
    return df.withColumn("codes", F.array_distinct(full)).drop("g", "m")


def hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: tuple = (), item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(key, n_words, n_hit, n_items, items) and the columns of ``keep``, for every row of ``docs``: its
    text's key and word count, and for texts that hold a window of an item the rest, else null.

    ``key`` is the md5 of the text. ``items`` are the distinct ids, as strings in their order; a null id
    reads ``null``. Items without words have no windows; repeated items and ids count once. Empty tables
    on either side give no hits; other columns are not read.
    """
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), words(F.col(item_text)).alias("w"))
    items = stored(items.where("size(w) > 0").distinct(), "items")
    length = F.least(F.size("w"), F.lit(WINDOW)).alias("n")
    lengths = sorted(r.n for r in items.select(length).distinct().collect())  # WINDOW values at most
    short = [n for n in lengths if n < WINDOW]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    source = docs.select(*keep, F.unhex(F.md5(whole)).alias("key"), whole.alias("text"), words(whole).alias("w"))
    n_words = F.size("w").cast("long").alias("n_words")
    sized = source.select(*keep, "key", n_words)
    if not lengths:
        return sized.selectExpr("*", "cast(null as bigint) n_hit", "cast(null as bigint) n_items", "cast(null as array<string>) items")
    long = items.where(F.size("w") >= WINDOW).select("w")
    kept = stored(_fingerprints(long).select(F.explode("codes").alias("c")).select(_hash("c")).distinct(), "kept")
    codes = "codes" if WINDOW in lengths else F.lit(None).cast("array<long>").alias("codes")
    prints = stored((_fingerprints(source.drop("text")) if WINDOW in lengths else source).select(*keep, "key", n_words, codes), "prints")
    met = prints.select("key", F.explode("codes").alias("c")).select("key", _place("c"), _hash("c")).join(kept, "hash")
    met = met.select("key", "place", F.lit(None).cast("struct<at:int,n:int>").alias("short"))
    if short:
        told = stored(_exact(items.where(F.size("w") < WINDOW), short).select("hash").distinct(), "short")
        found = _exact(source, short, "key").join(broadcast_if_small(told), "hash")
        met = met.union(found.select("key", F.lit(None).cast("int"), F.struct("at", "n")))
    met = stored(met.groupBy("key").agg(F.collect_set("place").alias("places"), F.collect_set("short").alias("short")), "met")
    texts = source.select("key", "text").join(met, "key").groupBy("key")
    texts = texts.agg(*[F.first(c).alias(c) for c in ("text", "places", "short")])
    found = _matched(texts.select("key", words(F.col("text")).alias("w"), "places", "short"), _windows(items))
    found = stored(found, "matched")
    spans = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("spans"))
    counted = spans.select("key", _covered(F.col("spans")).alias("n_hit"))
    owners = _windows(items, "item")
    listed = found.select("key", "gram").distinct().join(owners, "gram").groupBy("key").agg(F.collect_set("item").alias("items"))
    listed = listed.select("key", F.size("items").cast("long").alias("n_items"), F.sort_array("items").alias("items"))
    return prints.drop("codes").join(counted.join(listed, "key"), "key", "left")


def _hash(code: str) -> Column:
    return F.shiftright(code, PLACE_BITS).alias("hash")


def _place(code: str) -> Column:
    return F.col(code).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int").alias("place")


def _gram(w: Column, at: Column, n: Column) -> Column:
    return F.array_join(F.slice(w, at + 1, n), " ")


def _windows(items: DataFrame, *more: str) -> DataFrame:
    """The distinct windows of the items as text, of their own length each."""
    n = F.least(F.size("w"), F.lit(WINDOW))
    rows = items.withColumn("n", n).withColumn("at", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("n"))))
    return rows.select(_gram(F.col("w"), F.col("at"), F.col("n")).alias("gram"), *more).distinct()


def _exact(df: DataFrame, lengths: list[int], *more: str) -> DataFrame:
    """(at, n, hash) of every run of ``n`` words of ``w``, for each length; of items of fewer words, the whole item."""
    df = df.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))

    def runs(n: int) -> Column:
        first = F.slice("h", 1, F.greatest(F.size("h") - (n - 1), F.lit(0)))
        code = lambda x, i: F.xxhash64(F.lit(n), x, *[F.col("h")[i + j] for j in range(1, n)])
        return F.transform(first, lambda x, i: F.struct(i.cast("int").alias("at"), F.lit(n).alias("n"), code(x, i).alias("hash")))

    return df.select(*more, F.inline(F.concat(*[runs(n) for n in lengths])))


def _matched(texts: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, at, n, gram): the occurrences of windows around the places of the hits, and of short items at theirs."""
    last, back = F.size("w") - WINDOW, WINDOW - GRAM
    of = lambda p: F.sequence(F.greatest(p - back, F.lit(0)), F.least(p, last))
    around = F.transform(F.filter("places", lambda p: F.greatest(p - back, F.lit(0)) <= F.least(p, last)), of)
    starts = F.transform(F.array_distinct(F.flatten(around)), lambda i: F.struct(i.alias("at"), F.lit(WINDOW).alias("n")))
    rows = texts.withColumn("x", F.explode(F.concat(starts, "short")))
    rows = rows.select("key", "x.at", "x.n", _gram(F.col("w"), F.col("x.at"), F.col("x.n")).alias("gram"))
    return rows.join(windows, "gram")


def _covered(spans: Column) -> Column:
    """How many words sorted (at, n) spans cover together."""

    def step(state: Column, x: Column) -> Column:
        end = F.greatest(state["end"], x["at"] + x["n"])
        fresh = end - F.greatest(state["end"], x["at"])
        return F.struct(end.alias("end"), (state["sum"] + F.greatest(fresh, F.lit(0))).alias("sum"))

    begin = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(spans, begin, step, lambda state: state["sum"])


CONTAMINATED = "coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= n_words"


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items, contaminated."""
    out = hits(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark, "text", ("doc_id",))
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.expr(CONTAMINATED).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    Null and empty texts hold nothing and stay; repeated rows share a fate; long texts are searched whole.
    An empty table gives an empty one, and without items all rows stay.
    """
    name = "key"
    while name in (c.lower() for c in docs.columns):
        name += "_"
    with scratch(docs.sparkSession):
        marked = hits(docs, benchmark, text).where(CONTAMINATED).select(F.col("key").alias(name)).distinct()
        marked = stored(marked, "marked", lasting=True)
    keyed = docs.withColumn(name, F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))))
    return keyed.join(marked, name, "left_anti").select(*docs.columns)
