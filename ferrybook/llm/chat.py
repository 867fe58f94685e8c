"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as a whole: per turn a turn mark, the role, a text mark, the text, an end
mark. The marks are special tokens of their own, so no token reaches over the edge of a text. Where a
role or text holds something that looks like a special token, one backslash is put behind its ``<``
(one more where backslashes are there already), which reading back removes. The rendered text is
encoded once, with offsets; the sorted spans of the trained texts are intersected with the sorted
token starts by binary search.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
TRAINED = "assistant"
BATCH_CHARACTERS = 1 << 20


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The whole conversation, and the sorted spans of the texts to be learnt."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = TURN + escape(role) + TEXT, escape(text)
        if role == TRAINED:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


class Coder:
    """A byte-level tokenizer with the three marks added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.add_special_tokens([TURN, TEXT, END])
        self.marks = [self.tokenizer.token_to_id(x) for x in (TURN, TEXT, END)]

    def encode(self, texts: list[str]):
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)


def mask(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> np.ndarray:
    """True for tokens that begin inside one of the sorted spans."""
    starts = np.fromiter((s for s, _ in offsets), np.int64, len(offsets))
    out = np.zeros(len(starts), bool)
    for begin, end in spans:
        out[np.searchsorted(starts, begin) : np.searchsorted(starts, end)] = True
    return out


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def encode(rows: DataFrame, path: str, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, ``formatted``, ``ids``, ``starts`` and ``ends`` of the tokens in
    code points, ``loss`` per token.

    Turns go by ``turn`` (null first), equal turns by role and text; repeated rows are repeated turns. A
    null text or role is empty. Rows without conv_id make one conversation with a null id. An empty
    table gives no rows; other columns are not read.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = rows.groupBy(F.col(conv_id).cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text")))).alias("turns")
    )
    turns = turns.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def flush(ids: list, rendered: list):
        out: dict[str, list] = {k: [] for k in ("formatted", "ids", "starts", "ends", "loss")}
        for (text, spans), encoded in zip(rendered, coder(path).encode([t for t, _ in rendered])):
            offsets = encoded.offsets
            out["formatted"].append(text)
            out["ids"].append(encoded.ids)
            out["starts"].append([s for s, _ in offsets])
            out["ends"].append([e for _, e in offsets])
            out["loss"].append(mask(offsets, spans))
        longs, flags = pa.list_(pa.int32()), pa.list_(pa.bool_())
        kinds = [pa.int64(), pa.string(), longs, longs, longs, flags]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip([ids, *out.values()], kinds)], ["conv_id", *out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rendered, size = [], [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                conv, roles, texts = (batch.column(c)[k].as_py() for c in range(3))
                ids.append(conv)
                rendered.append(render(list(zip(roles, texts))))
                size += len(rendered[-1][0])
                if size >= BATCH_CHARACTERS:
                    yield flush(ids, rendered)
                    ids, rendered, size = [], [], 0
        if ids:
            yield flush(ids, rendered)

    schema = "conv_id long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
    return turns.mapInArrow(run, schema)


def read_back(ids: list[int], loss: list[bool], path: str) -> tuple[list[tuple[str, str]], str]:
    """The turns, and all text under the mask, from ids and mask alone."""
    code = coder(path)
    turn, text, end = code.marks
    values, under = np.asarray(ids, np.int64), np.asarray(loss, bool)
    begins, middles, ends = (np.flatnonzero(values == m) for m in (turn, text, end))
    turns, learnt = [], []
    for b, m, e in zip(begins, middles, ends):
        turns.append((unescape(code.decode(ids[b + 1 : m])), unescape(code.decode(ids[m + 1 : e]))))
        part = values[m + 1 : e][under[m + 1 : e]]
        if len(part):
            learnt.append(unescape(code.decode(part.tolist())))
    return turns, "".join(learnt)


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """Counts and digests of turns and learnt text, read back from ids and mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                conv, formatted, ids, loss = (batch.column(c)[k].as_py() for c in range(4))
                turns, learnt = read_back(ids, loss, path)
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, learnt)]
                out.append((conv, len(turns), sha[0], len(learnt), sha[1], len(formatted)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*out), kinds)], names) if out else pa.RecordBatch.from_arrays([pa.array([], t) for t in kinds], names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return encoded.select("conv_id", "formatted", "ids", "loss").mapInArrow(run, schema)
