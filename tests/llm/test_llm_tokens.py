import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from ferrybook.llm import token_files
from ferrybook.llm.queries import tokenizer_path
from ferrybook.llm.tokens import LETTERS, WordEncoder
from ferrybook.session import new_folder

PATH = str(tokenizer_path())
ODD = [
    None, "", " ", "it's a b.c's X.'s don't,, <|endoftext|>.. a<|startoftext|>!b 12.5% İstanbul ΣΑΣ. é. Å! J̌ x≠ ...", "a\x1cb c d.!",
    "İ. É!! ß. ×. é.", "a", '1. 2! "." x". "x', "x" * 3000, "́a  b c", "😀.! 漢字, ok?!",
]


def test_words_give_the_ids_of_texts(spark, folder):
    texts = ODD + [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").limit(150).collect()]
    plain, encoder = Tokenizer.from_file(PATH), WordEncoder(PATH, limit=100_000)
    for k in range(0, len(texts), 20):
        ids, ends = encoder.encode(pa.array(texts[k : k + 20], pa.string()))
        begin = 0
        for text, end in zip(texts[k : k + 20], ends):
            assert ids[begin:end].tolist() == plain.encode(text or "", add_special_tokens=False).ids
            begin = end


def check(spark, rows):
    folder = new_folder(spark, "tokens")
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as part", "'x' as ids").repartition(3)
    token_files.write(df, folder, PATH)
    got = token_files.read(spark, folder).orderBy("start").collect()
    plain = Tokenizer.from_file(PATH)
    want = sorted((i if i is not None else -(1 << 60), [*plain.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -(1 << 60), r.ids) for r in got) == want
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda i: -(1 << 60) if i is None else i)
    start = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        start += r.n_tokens
    return folder


def test_round_trip(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    made = check(spark, docs)
    assert [x.tolist() for x in token_files.fetch(spark, made, docs[5][0])] == [
        [*Tokenizer.from_file(PATH).encode(docs[5][1], add_special_tokens=False).ids, 1]
    ]
    assert token_files.fetch(spark, made, -99) == []


def test_odd_rows(spark):
    check(spark, [(k, t) for k, t in enumerate(ODD)] + [(None, "b"), (None, "a"), (3, "again"), (3, "again"), (-5, "neg")])


def test_empty_table(spark):
    check(spark, [])


def test_control_strings_keep_their_case(spark):
    texts = ["a <|ENDOFTEXT|> b", "<|EndOfText|>", "x<|StartOfText|>. Y<|endoftext|>Z!", "<| A |> <|ENDOFTEXT|>,", "A<|B <|É|>"]
    plain, (ids, ends) = Tokenizer.from_file(PATH), WordEncoder(PATH).encode(pa.array(texts))
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == want and want[1] != [49407]
    check(spark, list(enumerate(texts)))


def test_the_dictionary_is_shaped_by_late_ids(spark):
    phrase = "the quick brown fox jumps over one lazy dog"
    rows = [(k, f"{k} " + "x " * 2000 + f"{phrase} {k} " * 200) for k in range(120)]
    content = token_files.train(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    ids = Tokenizer.from_file(PATH).encode(phrase, add_special_tokens=False).ids
    assert np.array(ids[2:6], "<u4").tobytes() in content


def test_words_of_letters_have_the_ids_of_the_whole_tokenizer():
    """Every letter at the begin, inside and at the end of words, beside letters of all its blocks and capitals."""
    plain, encoder = Tokenizer.from_file(PATH), WordEncoder(PATH)
    words = [w for c in LETTERS for w in (c, c + c, f"a{c}", f"{c}e", f"Th{c}e", f"é{c}Σ", f"Σ{c}ж")]
    words += ["".join(LETTERS[i : i + n]) for n in (3, 7, 40, 400) for i in range(0, len(LETTERS), n)]
    words += [w + mark for w in ("ΑΣ", "İa", "ŉa", "Åb", "straße", "Ǆx", "xͺ", "ჯa", "日a", "a\u0301b", "İ", "a\u0345") for mark in ("", ".", "'s", "1", "\u0301")]
    ids, ends = encoder.encode(pa.array(words))
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [plain.encode(w, add_special_tokens=False).ids for w in words]


def test_words_of_letters_skip_normalizer_and_pre_tokenizer():
    """They are most distinct words of a text, and those two steps most of the time that one takes."""
    encoder, whole = WordEncoder(PATH), []

    class Watched:
        def encode_batch_fast(self, texts, add_special_tokens):
            whole.extend(texts)
            return inner.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    inner, encoder.tokenizer = encoder.tokenizer, Watched()
    text = "Thereareining naïve. Überstraße, слово! it's b2b 漢字 12.5%"
    ids, _ = encoder.encode(pa.array([text]))
    assert ids.tolist() == inner.encode(text, add_special_tokens=False).ids
    sent = {w for t in whole for w in t.split(encoder.mark)}
    assert {"it's", "b2b", "漢字"} <= sent and not [w for w in sent if w and set(w) <= set(LETTERS) - {"İ"}]
