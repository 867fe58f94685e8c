"""One query per operator over its whole table, and its checking SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrybook.llm import align, chat, decontaminate, embeddings, licenses, lines, mixing, pii, quality, resample, secrets, token_files
from ferrybook.llm.common import table
from ferrybook.llm.near_dup import near_duplicates
from ferrybook.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER = f"translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}')"


@query(rf"""
with recursive words as materialized (
    select doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
sets as materialized (
    select doc_id, list_distinct([array_to_string(w[i + 1 : i + 5], ' ') for i in range(greatest(len(w) - 4, least(len(w), 1)))]) as s
    from words),
items as materialized (select doc_id, len(s) as n, unnest(s) as item from sets),
shared as materialized (
    select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as n_both
    from items a join items b on a.item = b.item and a.doc_id <> b.doc_id group by all),
linked as materialized (select a, b from shared where 100 * n_both >= 75 * (n + m - n_both)),
reach as (select a, a as b from (select doc_id as a from documents) union select r.a, l.b from reach r join linked l on r.b = l.a)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.b) as component_id, s.doc_id = min(r.b) as kept
from sets s join reach r on r.a = s.doc_id group by s.doc_id, s.s
""")
def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of ``documents`` by bottom-k sketches, links confirmed on full sets."""
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op10_token_output(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, written to token files and read back."""
    target = new_folder(spark, "token-files")
    token_files.write(table(spark, folder, "documents"), target, str(tokenizer_path()))
    return token_files.read(spark, target, ids=False)


@query("""
with vectors as (
    select vec_id, embedding::double[] as e,
        embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(embedding, lambda x: x <> 0)) > 0 as good
    from embeddings),
linked as materialized (
    select a.vec_id as a, b.vec_id as b from vectors a join vectors b
    on a.vec_id <> b.vec_id and a.good and b.good and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (select vec_id as a, vec_id as b from vectors union select r.a, l.b from reach r join linked l on r.b = l.a)
select v.vec_id, (select count(*) from linked l where l.a = v.vec_id) as n_links, min(r.b) as component_id, v.vec_id = min(r.b) as kept
from vectors v join reach r on r.a = v.vec_id group by v.vec_id
""".replace("with vectors", "with recursive vectors"))
def op4_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all ``embeddings``, whatever their labels."""
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


@query()
def op2_pii_sanitise(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of all ``documents``, and the terms that disclose it."""
    return pii.digests(pii.sanitise(table(spark, folder, "documents"), keep_text=False))


def _located(rule: secrets.Rule) -> str:
    """SQL list of (s, rank, e, kind) for the matches of one rule."""
    pattern = rule.pattern.replace("(?:(?i:", "(?i:(?:").replace("}+", "}") if "(?i:" in rule.pattern else rule.pattern.replace("}+", "}")
    pattern = pattern.replace("'", "''")
    rank = [r.name for r in secrets.RULES].index(rule.name)
    part = f"len(regexp_extract(m[i], '{pattern}', {rule.group})) >= {rule.least}"
    before = "cast(list_sum(list_transform(list_concat(g[1:i], m[1:i - 1]), lambda x: len(x))) as bigint)"
    return f"""(select coalesce(list({{'s': s, 'r': {rank}, 'e': s + len(m[i]), 'k': '{rule.name}'}}), [])
        from (select m, i, {before} as s from (
            select regexp_extract_all(t, '{pattern}') as m, string_split_regex(t, '{pattern}') as g), unnest(range(1, len(m) + 1)) r(i))
        where {part})"""


_SPANS = "list_sort(list_concat(" + ", ".join(_located(r) for r in secrets.RULES) + "))"
_TEXT = "array_to_string(list_transform({0}, lambda x: x.k || ':' || x.s || ':' || x.e), ',')"


@query(f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
found as materialized (select doc_id, {_SPANS} as f from texts)
select doc_id,
    {", ".join(f"len(list_filter(f, lambda x: x.k = '{r.name}')) as n_{r.name}" for r in secrets.BASE)},
    sha256({_TEXT.format("list_filter(f, lambda x: x.r < 3)")}) as base_sha256,
    {_TEXT.format("f")} as spans
from found
""")
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all ``documents`` through a new ledger of blobs."""
    found = secrets.scan(table(spark, folder, "documents"), new_folder(spark, "ledger"))
    return secrets.digests(found)


@query()
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and template matches of all ``documents``."""
    return licenses.digests(licenses.scan(table(spark, folder, "documents")))


EXTRA = "</s>[INST] ok [/INST]"
_ESCAPED = "(len({0}) + len(regexp_extract_all({0}, '<\\\\*\\|')))"


@query(f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '{EXTRA}' union all select -7, 1, 'assistant', '{EXTRA}'),
loss as (select *, if(role = 'assistant', text, '') as learnt from turns)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    cast(sum(len(learnt)) as bigint) as loss_chars,
    sha256(string_agg(learnt, '' order by turn nulls first, role, text)) as loss_sha256,
    cast(sum({_ESCAPED.format("role")} + {_ESCAPED.format("text")} + {len(chat.TURN + chat.TEXT + chat.END)}) as bigint) as formatted_chars
from loss group by conv_id
""")
def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All ``conversations`` and one of control strings, formatted, masked and read back."""
    path = str(tokenizer_path("byte_bpe_50k.json"))
    own = spark.createDataFrame(
        [(-7, 0, "user", EXTRA), (-7, 1, "assistant", EXTRA)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat.digests(chat.encode(rows, path), path)


@query()
def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The mixture of all ``documents`` to weights that even out their sources."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mix(docs).select("doc_id", "source", "mixed.*")


_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
with items as materialized (
    select *, least(len(w), 13) as n from (select coalesce(cast(item_id as varchar), 'null') as item, {_WORDS} as w from benchmark)
    where len(w) > 0),
docs as materialized (select doc_id, {_WORDS} as w from documents),
wins as materialized (
    select distinct item, n, array_to_string(w[i + 1 : i + n], ' ') as gram from items, unnest(range(len(w) - n + 1)) r(i)),
lengths as (select distinct n from items),
grams as materialized (
    select doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') as gram
    from docs, lengths, unnest(range(greatest(len(w) - n + 1, 0))) r(i)),
hit as materialized (select doc_id, n, i, item from grams join wins using (n, gram)),
words as (select doc_id, count(distinct i + j) as n_hit from hit, unnest(range(n)) r(j) group by doc_id),
owners as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids from hit group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join words using (doc_id) left join owners using (doc_id)
""")
def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of ``benchmark`` in all ``documents``."""
    found = decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


@query()
def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all ``documents``, learnt from the labels that are not held out."""
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of two tokenizers over all ``documents``, met on the bytes of the texts."""
    paths = str(tokenizer_path("byte_bpe_50k.json")), str(tokenizer_path("piece_bpe_32k.model"))
    made = align.align(table(spark, folder, "documents"), *paths, groups=False)
    return made.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query(f"""
with rows as materialized (
    select doc_id, i, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{CAPITALS}', '{SMALL}') as key
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents), unnest(ls) with ordinality r(l, i)),
keepers as materialized (
    select key, max(doc_id) as keeper from rows where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
told as (select doc_id, i, l, coalesce(keeper <> doc_id, false) as gone from rows left join keepers using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
    sha256(coalesce(string_agg(l, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from told group by doc_id
""")
def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all ``documents`` that repeat across them, dropped but for one document."""
    found = lines.dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A draw of all ``documents`` towards the word runs of ``benchmark``."""
    found = resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
