"""Information-theoretic sanitisation of personal data, with built-in functions only.

Personal data found by form (mail and network addresses, card and phone numbers) are the protected
entities, each by itself and as one of its class, which recurs where the literal does not: a mail
address's domain, a network, a card's issuer, a phone number's prefix. A term near an entity
discloses it as far as the corpus says so: with the number of documents that hold the term, the
entity, and the term near the entity, the point-wise mutual information of both is compared with the
entity's own information. The chance of the entity given the term is smoothed towards the entity's
own by ``PRIOR`` documents, so one meeting of two rare ones counts for much, but for less than many.
The ratio is near 1 for a term that never occurs apart from the entity, and 0 for an unrelated one.
Terms at ``GENERALISE`` or more for the literal or its class are generalised to a placeholder, at
``REMOVE`` or more removed, wherever they stand near the entity.

Counts cover all documents. Mentions, terms and entities are counted with partial sums before any
shuffle; the terms' document counts come from one aggregation over all words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrybook.llm.common import stored
from ferrybook.llm.spans import matches, replaced, written

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
# Possessive forms of the base patterns. A match can only begin at the start of a run of its first
# characters or where the match before it ended, which keeps long runs linear.
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "phone": "+"}
WIDTH = 60  # code points on either side of an entity that are near it
LETTERS = 4  # of a term at least
GENERALISE, REMOVE, PRIOR = 0.8, 0.95, 0.5
ISSUER, PREFIX = 6, 5  # first digits that name a card's issuer, a phone number's country and area
TERM = rf"(?<!\S)\p{{L}}{{{LETTERS},}}+(?![^\s.,;:!?])"
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def _luhn(digits: Column) -> Column:
    def digit(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + digit(i))
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("long") <= 255, F.lit(False)))
    if kind == "card":
        digits = F.translate(m, " -", "")
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.translate(m, "+ ().-", "")).between(9, 15)
    return F.lit(True)


def _entity(kind: str, m: Column) -> Column:
    return F.lower(m) if kind == "email" else F.translate(m, "+ ().-", "") if kind in ("card", "phone") else m


def _classed(kind: Column, entity: Column) -> Column:
    """The literal entity and its class."""
    wider = F.when(kind == "email", F.substring_index(entity, "@", -1)).when(kind == "ip", F.substring_index(entity, ".", 3))
    wider = wider.otherwise(F.substring(entity, F.lit(1), F.when(kind == "card", ISSUER).otherwise(PREFIX)))
    return F.array(F.concat_ws(":", kind, entity), F.concat_ws(":", F.lit("of"), kind, wider))


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind the places of personal data by form."""
    out = {}
    for kind in KINDS:
        if kind == "card":
            hint = text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")
        elif kind == "ip":
            hint = text.rlike(r"[0-9]\.[0-9]")
        else:
            hint = text.contains(HINTS[kind])
        found = matches(text, PATTERNS[kind], hint)
        out[kind] = F.filter(found, _validator(kind))
    return out


def _validator(kind: str):
    return lambda x: _valid(kind, x["m"])


def _near(text: Column, spans: Column) -> Column:
    """Per span the terms on either side of it that touch none of ``spans``."""

    def side(x: Column, start: Column, stop: Column) -> Column:
        # one more code point on either side shows whether a word is cut
        lo, hi = F.greatest(start - 1, F.lit(0)), F.least(stop + 1, F.length(text))
        part = F.substring(text, lo + 1, hi - lo)
        found = F.transform(
            matches(part, TERM),
            lambda t: F.struct((t["s"] + lo).alias("s"), (t["e"] + lo).alias("e"), F.lower(t["m"]).alias("term")),
        )
        inside = lambda t: (t["s"] >= start) & (t["e"] <= stop) & ~F.exists(spans, lambda b: (t["s"] < b["e"]) & (t["e"] > b["s"]))
        return F.filter(found, inside)

    def around(x: Column) -> Column:
        left = side(x, F.greatest(x["s"] - WIDTH, F.lit(0)), x["s"])
        right = side(x, x["e"], F.least(x["e"] + WIDTH, F.length(text)))
        return F.struct(x["kind"].alias("kind"), x["entity"].alias("entity"), F.concat(left, right).alias("near"))

    return F.transform(spans, around)


def _tagger(kind: str):
    return lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"), _entity(kind, x["m"]).alias("entity")
    )


def _replacer(by: str):
    return lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(by).alias("by"))


def _found(docs: DataFrame, doc_id: str, text: str, keep_text: bool) -> DataFrame:
    """Stored rows: row, doc_id, a column of places per kind, ``mentions`` with the terms near each entity."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("*", *[c.alias(kind) for kind, c in base_spans(F.col("text")).items()])
    rows = rows.withColumn("tagged", F.concat(*[F.transform(F.col(kind), _tagger(kind)) for kind in KINDS]))
    empty = F.expr("cast(array() as array<struct<kind:string,entity:string,near:array<struct<s:int,e:int,term:string>>>>)")
    near = F.when(F.size("tagged") > 0, _near(F.col("text"), F.col("tagged"))).otherwise(empty)
    rows = rows.withColumn("mentions", near).drop("tagged")
    return stored(rows if keep_text else rows.drop("text"), "personal")


def _disclosing(found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(row, s, e, removed): places of terms that disclose an entity near them."""
    mentions = found.where("size(mentions) > 0").select("row", F.explode("mentions").alias("x"))
    mentions = mentions.select("row", F.explode(_classed(F.col("x.kind"), F.col("x.entity"))).alias("entity"), "x.near")
    places = mentions.select("row", "entity", F.explode("near").alias("t")).select("row", "entity", "t.term", "t.s", "t.e")
    entities = mentions.select("row", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    both = places.select("row", "entity", "term").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"))
    both = stored(both, "together")
    # the same words as in the terms: runs of letters, once per document
    words = F.array_distinct(F.split(F.lower(F.col(text).cast("string")), r"[^\p{L}]+"))
    terms = docs.select(F.explode(words).alias("term")).where(F.length("term") >= LETTERS)
    terms = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    total = F.lit(float(max(1, docs.count())))
    rated = both.join(entities, "entity").join(terms, "term")
    chance = F.col("n_entity") / F.greatest(total, F.col("n_entity") + 1)
    given = (F.col("n_both") + PRIOR * chance) / (F.greatest("n_term", "n_both") + PRIOR)
    rated = rated.withColumn("share", F.log(given / chance) / -F.log(chance)).where(F.col("share") >= GENERALISE)
    rated = rated.select("entity", "term", (F.col("share") >= REMOVE).alias("removed"))
    return places.join(rated, ["entity", "term"]).groupBy("row", "s", "e").agg(F.max("removed").alias("removed"))


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, the places per kind (``email``, ``ip``, ``card``, ``phone``: s, e,
    m), ``terms`` (s, e, removed) in order, and with ``keep_text`` the sanitised ``text``.

    A null text counts as an empty one. Repeated rows and ids stay repeated and count as documents of
    their own. An empty table gives no rows; other columns of ``docs`` are not read.
    """
    found = _found(docs, doc_id, text, keep_text)
    terms = _disclosing(found, docs, text).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("s", "e", "removed"))).alias("terms"))
    none = F.expr("cast(array() as array<struct<s:int,e:int,removed:boolean>>)")
    out = found.drop("mentions").join(terms, "row", "left").withColumn("terms", F.coalesce("terms", none))
    if keep_text:
        by = [F.transform(F.col(k), _replacer(PLACEHOLDERS[k])) for k in KINDS]
        term_by = F.transform(
            F.col("terms"),
            lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.when(x["removed"], "").otherwise("[TERM]").alias("by")),
        )
        out = out.withColumn("text", replaced(F.col("text"), F.concat(*by, term_by)))
    return out.drop("row")


def digests(found: DataFrame) -> DataFrame:
    """The counts, the digest of the base places and all places of :func:`sanitise` as text."""
    base = F.concat(*[written(k, F.col(k)) for k in KINDS])
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, written("term", F.col("terms"))), ",").alias("spans"),
    )
