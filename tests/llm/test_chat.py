import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat

pieces = st.lists(
    st.sampled_from(["<|im_start|>", "<|im_end|>", "</s>", "[INST]", "[/INST]", "<", "\\", "|im_end|>", "\n", "a", "é", "<\\|im_end|>", "[\\\\INST]"]),
    max_size=8,
).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(pieces, pieces), max_size=4))
def test_round_trip(turns):
    text = "".join(chat.render(r, t)[0] for r, t in turns)
    assert chat.read(text) == turns
    reader, got = chat.Reader(), []
    for r, t in turns:  # the same when the turns arrive one by one
        got += [x[:2] for x in reader.feed(chat.render(r, t)[0])]
    reader.close()
    assert got == turns


def test_plain_text_is_not_escaped():
    assert chat.render("user", "a < b [x] \\ c")[0] == "<|im_start|>user\na < b [x] \\ c<|im_end|>\n"
    turn, a, b = chat.render("assistant", "</s>[INST] ok [/INST]")
    assert turn[a:b] == "<\\/s>[\\INST] ok [\\/INST]"


@pytest.mark.parametrize("bad", ["x", "<|im_start|>user\na", "<|im_start|>u\na</s>b<|im_end|>\n", "<|im_end|>\n", "<|im_start|>u<|im_end|>\n"])
def test_bad_text_is_refused(bad):
    with pytest.raises(chat.BadChat):
        chat.read(bad)


def test_awkward_conversations(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, None, None, None),
        (2, 0, "assistant", "x\n<|im_end|>\né😀"), (None, 0, "us\ner", "</s>"), (3, 0, "Assistant", ""),
        *[(4, i, "assistant" if i % 2 else "user", f"turn {i} " * 50) for i in range(3000)],
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as piece", "2 as pos")
    for got in (chat.read_back(chat.formatted(df), ordered=True), chat.read_back(chat.formatted(df))):
        got = {r["conv_id"]: r for r in got.collect()}
        assert set(got) == {1, 2, 3, 4, None}
        for c, r in got.items():
            turns = sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
            said = "".join(x[3] or "" for x in turns if x[2] == "assistant")
            assert r["n_turns"] == len(turns)
            assert r["turns_sha256"] == hashlib.sha256("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns).encode()).hexdigest()
            assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.read_back(chat.formatted(df.limit(0))).count() == 0


def test_loss_spans_are_places_in_the_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "[INST]"), (1, 2, "assistant", "z")], "conv_id long, turn long, role string, text string")
    rows = sorted(chat.formatted(df).collect(), key=lambda r: r["pos"])
    whole = "".join(r["piece"] for r in rows)
    assert [whole[r["loss_start"] : r["loss_end"]] for r in rows if r["loss_start"] is not None] == ["[\\INST]", "z"]
