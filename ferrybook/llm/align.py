"""Alignment of two tokenizers' tokens on the bytes of the same texts.

Both tokenizers cut the bytes of a space and the text. The work on a slice of documents is Arrow work
on flat columns: token lists are flattened with the index of their parent document, token lengths
become ends by segmented cumulative sums, and a full outer hash join on (document, end) merges the two
lists of ends. Between two neighbouring ends of the merged list lies one piece of the text, which is
in exactly one token of each side: the piece is their link. Tokens that both end there close a group.

How many documents hold a pair of ids linked is counted by ``Table.group_by`` per slice and summed by
Spark. Links are stored once, a row per document with its distinct pairs, and meet the counts in a
join, so that no text is encoded twice.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.llm.common import give_back, pieces, stored
from ferrybook.session import broadcast_if_small

SLICE_BYTES = 384 << 10
COUNT_BYTES = 16 << 20  # stored bytes of pair counts that are still broadcast

# Fixed value: how the byte-level tokenizer cuts texts before it merges bytes.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, "
    "a array<int>, b array<int>, times array<int>"
)
EMPTY = ("n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256")  # not null where there are no tokens


def _alphabet() -> dict[str, int]:
    """The byte that a letter of a byte-level vocabulary stands for: printable ones are themselves, the
    others follow from code point 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE of a ``tokenizers`` file whose ids are the ranks of its merges. Special tokens are plain text."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        letters, special = _alphabet(), {t["content"] for t in told["added_tokens"]}
        entries = {k: bytes(letters[c] for c in t) for t, k in told["model"]["vocab"].items() if t not in special}
        self.bytes = [entries.get(k, b"") for k in range(max(entries) + 1)]
        ranks = {v: k for k, v in entries.items()}
        self.core = tiktoken.Encoding(path, pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.core.encode_to_numpy(" " + t) for t in texts]


class Pieces:
    """A SentencePiece model; it puts a space before every text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.core = SentencePieceProcessor(model_file=path)
        self.bytes = [self._of(k) for k in range(self.core.piece_size())]

    def _of(self, k: int) -> bytes:
        piece = self.core.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.core.is_byte(k) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int32) for x in self.core.encode(texts, num_threads=1)]


class _Side:
    """A tokenizer with the bytes of its ids and their numbers as columns."""

    def __init__(self, tokenizer: ByteLevel | Pieces):
        self.tokenizer = tokenizer
        self.bytes = pa.array(tokenizer.bytes, pa.large_binary())
        self.lengths = pc.binary_length(self.bytes).cast(pa.int64())

    def tokens(self, texts: list[str], wanted: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        """Token lists of the texts, and which texts the joined bytes of their tokens give back."""
        arrays = self.tokenizer.encode(texts)
        ends = np.cumsum([0, *(len(x) for x in arrays)])
        flat = pa.array(np.concatenate(arrays).astype(np.int32) if arrays else np.empty(0, np.int32))
        joined = self.bytes.take(flat)
        data, at = memoryview(joined.buffers()[2] or b""), np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1)[ends]
        same = [bytes(data[b:e]) == w for b, e, w in zip(at[:-1], at[1:], wanted.to_pylist())]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), np.array(same, bool)

    def table(self, lists: pa.ListArray, index: str) -> pa.Table:
        """(doc, end, index) of all tokens: the document's place, where the token ends in it, the token's place."""
        ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int32())
        sums = pc.cumulative_sum(self.lengths.take(ids))
        past = np.concatenate([[0], sums.to_numpy()])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        end = pc.subtract(sums, pa.array(past[:-1]).take(doc))
        return pa.table({"doc": doc, "end": end, index: pa.array(np.arange(len(ids)), pa.int64())})


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = _Side(ByteLevel(a_path)), _Side(Pieces(b_path))
        self.size = max(len(self.a.bytes), len(self.b.bytes))
        # the number of every id with each of the marks that can stand behind it
        self.numbers = pa.array([f"{k}{mark}" for mark in ",|;" for k in range(self.size)], pa.large_string())

    def _groups(self, n: int, ids_a, ids_b, doc_a, doc_b, closes, has_a, has_b) -> list[str]:
        """Per document its groups as text."""
        group = np.cumsum(closes) - closes
        g_a, g_b = group[has_a], group[has_b]
        total = int(closes.sum())
        before_b = np.cumsum(np.bincount(g_b, minlength=total)) - np.bincount(g_b, minlength=total)
        upto_a = np.cumsum(np.bincount(g_a, minlength=total))
        codes = np.empty(len(g_a) + len(g_b), np.int64)
        codes[np.arange(len(g_a)) + before_b[g_a]] = ids_a + self.size * closes[has_a]
        codes[np.arange(len(g_b)) + upto_a[g_b]] = ids_b + 2 * self.size * closes[has_b]
        text = self.numbers.take(pa.array(codes))
        data, at = memoryview(text.buffers()[2] or b""), np.frombuffer(text.buffers()[1], np.int64, len(text) + 1)
        bounds = at[np.cumsum([0, *(np.bincount(doc_a, minlength=n) + np.bincount(doc_b, minlength=n))])]
        return [bytes(data[b : max(b, e - 1)]).decode() for b, e in zip(bounds[:-1], bounds[1:])]

    def align(self, texts: pa.Array) -> dict[str, pa.Array]:
        """The columns of ``ALIGNED`` behind ``doc_id``, a row per text, none of them null or empty."""
        n, plain = len(texts), texts.to_pylist()
        wanted = pc.binary_join_element_wise(" ", texts, "").cast(pa.large_binary())
        (lists_a, same_a), (lists_b, same_b) = self.a.tokens(plain, wanted), self.b.tokens(plain, wanted)
        good = pa.array(np.where(same_a & same_b, np.arange(n), -1))
        lists_a, lists_b = (x.take(pc.if_else(pc.less(good, 0), None, good)) for x in (lists_a, lists_b))
        lists_a, lists_b = (pa.ListArray.from_arrays(_offsets(x), pc.list_flatten(x)) for x in (lists_a, lists_b))
        one, two = self.a.table(lists_a, "i"), self.b.table(lists_b, "j")
        links = one.join(two, ["doc", "end"], join_type="full outer", use_threads=False).combine_chunks()
        links = links.take(pa.array(np.lexsort((links["end"].to_numpy(), links["doc"].to_numpy()))))
        has_a, has_b = (pc.is_valid(links[c]).to_numpy() for c in ("i", "j"))
        closes = has_a & has_b
        ids_a, ids_b = pc.list_flatten(lists_a), pc.list_flatten(lists_b)
        # the token around a piece is the next one that ends: at the piece's end or behind it
        pairs = pa.table(
            {
                "doc": links["doc"],
                "a": ids_a.take(pc.fill_null_backward(links["i"].combine_chunks())),
                "b": ids_b.take(pc.fill_null_backward(links["j"].combine_chunks())),
            }
        )
        distinct = pairs.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
        distinct = distinct.take(pc.sort_indices(distinct["doc"]))
        doc, doc_a, doc_b = links["doc"].to_numpy(), one["doc"].to_numpy(), two["doc"].to_numpy()
        groups = self._groups(n, ids_a.to_numpy(), ids_b.to_numpy(), doc_a, doc_b, closes, has_a, has_b)
        cuts = pa.array(np.searchsorted(distinct["doc"].to_numpy(), np.arange(n + 1)), pa.int32())
        listed = lambda c: pa.ListArray.from_arrays(cuts, distinct[c].combine_chunks().cast(pa.int32()))
        counted = lambda d, w=None: pa.array(np.bincount(d, w, minlength=n).astype(np.int64))
        return {
            "n_a": counted(doc_a),
            "n_b": counted(doc_b),
            "n_groups": counted(doc, closes),
            "n_links": counted(doc),
            "groups": pa.array(groups, pa.string()),
            "groups_sha256": pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]),
            "a": listed("a"),
            "b": listed("b"),
            "times": listed("count_all"),
        }


def _offsets(lists: pa.ListArray) -> pa.Array:
    return pa.array(np.cumsum([0, *pc.fill_null(pc.list_value_length(lists), 0).to_numpy()]), pa.int32())


def encoded(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", groups: bool = True) -> DataFrame:
    """Columns ``ALIGNED``, a row per row of ``docs``, without ``groups`` if not asked for.

    ``groups`` is the text of the groups, ``a``, ``b``, ``times`` the distinct linked pairs and how often
    each is linked. A null or empty text, and one that a tokenizer does not give back, has no tokens.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for part in pieces(batches, 2, SLICE_BYTES):
            texts = part.column(2).fill_null("")
            full = pc.greater(pc.binary_length(texts), 0)
            columns = aligner.align(texts.filter(full).cast(pa.string()))
            place = np.where(full.to_numpy(False), np.cumsum(full.to_numpy(False)) - 1, -1)
            place = pc.if_else(pa.array(place >= 0), pa.array(place), None)
            out = {"row": part.column(0), "doc_id": part.column(1)}
            for name, column in columns.items():
                if groups or name != "groups":
                    taken = column.take(place)
                    out[name] = taken.fill_null(0 if name.startswith("n_") else "") if name in EMPTY else taken
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))
        del aligner
        give_back()

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInArrow(made, ALIGNED if groups else ALIGNED.replace("groups string, ", ""))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs per document -> how many documents of a batch hold each pair."""
    for batch in batches:
        flat = pa.table({c: pc.list_flatten(batch.column(c)) for c in ("a", "b")})
        counts = flat.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
        yield from counts.select(["a", "b", "count_all"]).rename_columns(["a", "b", "n"]).to_batches()


PAIR = "shiftleft(cast(a as bigint), 32) | b"


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, pair, n, best): the documents that hold a pair linked; ``best`` where no pair of its ``a`` has more."""
    partial = aligned.select("a", "b").where(F.size("a") > 0).mapInArrow(_counted, "a int, b int, n long")
    counts = stored(partial.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # a row per id of the vocabulary
    told = counts.join(broadcast_if_small(most), "a")
    return told.select("a", "b", F.expr(PAIR).alias("pair"), "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", groups: bool = True
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups, groups_sha256, a, b, times, n_best, count_sum.

    ``n_best`` counts the links whose pair is held by as many documents as any pair of its ``a``, ties
    included; ``count_sum`` sums these document counts over all links. Null and empty texts, and texts
    that a tokenizer changes, have zeros, no pairs and empty texts of groups. Rows that repeat an id
    are documents of their own, null ids stay null. A long text is aligned whole, as a slice of its own.
    An empty table gives an empty one; other columns of ``docs`` are not read.
    """
    made = stored(encoded(docs, a_path, b_path, doc_id, text, groups), "aligned")
    counts = stored(pair_counts(made).select("pair", "n", "best"), "counts")
    links = made.where(F.size("a") > 0).select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("x"))
    links = links.select("row", "x.*").select("row", F.expr(PAIR).alias("pair"), "times")
    met = links.join(broadcast_if_small(counts, COUNT_BYTES), "pair")
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    )
    out = made.join(sums, "row", "left").drop("row")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")})
