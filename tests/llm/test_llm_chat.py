import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrybook.llm import chat
from ferrybook.llm.queries import EXTRA, QUERIES, tokenizer_path

PATH = str(tokenizer_path("byte_bpe_50k.json"))
PIECES = st.sampled_from(["<|end|>", "<|turn|>", "<\\|", "<", "|", "\\", "<|endoftext|>", "é", "😀", " a", "\n", "漢", EXTRA, "́"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|text|>", ""]), st.lists(PIECES).map("".join)), max_size=5))
def test_round_trip(turns):
    text, spans = chat.render(turns)
    encoded = chat.coder(PATH).encode([text])[0]
    loss = chat.mask(encoded.offsets, spans)
    back, learnt = chat.read_back(encoded.ids, loss.tolist(), PATH)
    assert back == turns
    assert learnt == "".join(t for r, t in turns if r == "assistant")


def test_escaping_is_reversible():
    for text in ("<|x", "<\\|x", "<\\\\|", "<", "a<b|c", "<|<|"):
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def test_odd_rows(spark):
    rows = [
        (1, 2, "assistant", None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, None, "first"), (None, 0, "assistant", "x"), (2, 0, "assistant", "y" * 200000),
        (3, 0, "assistant", "same"), (3, 0, "assistant", "same"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' as turns", "1 as ids")
    out = {r.conv_id: r for r in chat.digests(chat.encode(df, PATH), PATH).collect()}
    assert out[1].n_turns == 4 and out[1].loss_chars == 0 and out[None].loss_chars == 1
    assert out[2].loss_chars == 200000 and out[3].n_turns == 2 and out[3].loss_chars == 8
    assert chat.encode(df.limit(0), PATH).collect() == []


def test_offsets_and_masks_agree(spark, folder):
    df = spark.read.parquet(f"{folder}/conversations.parquet")
    for r in chat.encode(df, PATH).limit(20).collect():
        assert len(r.ids) == len(r.starts) == len(r.ends) == len(r.loss) and r.ends[-1] == len(r.formatted)


def test_the_added_conversation(spark, folder):
    row = QUERIES["op6_chat_format"](spark, folder).where("conv_id = -7").first()
    assert row.n_turns == 2 and row.loss_chars == len(EXTRA)
    with pytest.raises(AttributeError):
        row.conversation
