import hashlib
from collections import Counter

import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ferrybook.llm import align
from ferrybook.llm.common import table
from ferrybook.llm.queries import tokenizer_path

A, B = str(tokenizer_path("byte_bpe_50k.json")), str(tokenizer_path("piece_bpe_32k.model"))
ODD = [
    None, "", " ", "  a  b ", "it's <|endoftext|> and </s> <unk> <s> <0x41>", "line\n\n\ttab\r\n end ", "ﬁ Ａ é é 😀 漢字かな", "▁ a▁b",
    "x" * 20000, " " * 5000, "nul\x00 \x7f ​ ﻿", "12,345.67 + 8", "Ünïcödé ß İ", "a", "\n", "the the the the", "the the",
]


class Brute:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in printable}
        for n, b in enumerate(b for b in range(256) if b not in printable):
            letters[chr(256 + n)] = b
        self.of_a = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab().items() if i < 50256}

    def of_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(self, ids, of):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(of(i))))
            at = out[-1][2]
        return out

    def tokens(self, text):
        if not text:
            return [], []
        want = (" " + text).encode()
        a = self.spans(self.a.encode(" " + text, add_special_tokens=False).ids, self.of_a.get)
        b = self.spans(self.b.encode(text), self.of_b)
        good = all(b"".join(of(i) for i, _, _ in x) == want for x, of in ((a, self.of_a.get), (b, self.of_b)))
        return (a, b) if good else ([], [])

    def rows(self, texts):
        made = []
        for text in texts:
            a, b = self.tokens(text)
            links, j = [], 0
            for i, s, e in a:
                while j and b[j][1] > s:
                    j -= 1
                while b[j][2] <= s:
                    j += 1
                while j < len(b) and b[j][1] < e:
                    links.append((i, b[j][0]))
                    j += 1
                j -= 1
            cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
            groups, ia, ib = [], iter(a), iter(b)
            for cut in cuts:
                sides = []
                for side in (ia, ib):
                    own = []
                    for i, _, e in side:
                        own.append(str(i))
                        if e == cut:
                            break
                    sides.append(",".join(own))
                groups.append("|".join(sides))
            made.append((a, b, links, ";".join(groups)))
        held = Counter(p for _, _, links, _ in made for p in set(links))
        most = {}
        for (i, _), n in held.items():
            most[i] = max(most.get(i, 0), n)
        return [
            (len(a), len(b), text.count("|"), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
             hashlib.sha256(text.encode()).hexdigest() if text else "")
            for a, b, links, text in made
        ]


FIELDS = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_a", "'x' as row", "2 as a", "3 as best").repartition(3)
    got = align.align(df, A, B).collect()
    want = Brute().rows([t for _, t in rows])
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, *(r[f] for f in FIELDS)) for r in got), key=key) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=key)
    return got


def test_all_documents(spark, folder):
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    got = check(spark, docs)
    assert sum(r.n_links > 0 for r in got) > len(docs) / 2
    some = next(r for r in got if r.groups)
    assert hashlib.sha256(some.groups.encode()).hexdigest() == some.groups_sha256 and sum(some.times) == some.n_links


def test_odd_rows(spark):
    check(spark, [*enumerate(ODD), (None, "no id"), (None, "no id"), (3, "again"), (3, "again"), (-5, "neg")])


def test_pairs_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(align, "COUNT_BYTES", 1)
    check(spark, [(i, f"a hot text and {i} again, x{i % 3}") for i in range(300)])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(df, A, B).collect() == []


@pytest.mark.parametrize("texts", [[], ["a"], ["▁"]])
def test_slices_without_tokens(texts):
    made = align.Aligner(A, B).align(pa.array(texts, pa.string()))
    assert [len(c) for c in made.values()] == [len(texts)] * len(made)
