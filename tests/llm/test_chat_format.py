"""Chat formatting: folding, rendering, reading back."""

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from hashloom.llm import chat_format as chat

pieces = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\x1b", "\x1b|", "e", "s", "\n", "é", "😀", "user", " "]), max_size=8).map("".join)


@given(st.lists(st.tuples(pieces, pieces), max_size=6))
def test_round_trip(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    masked = [chat.unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True)]
    assert masked == [t for r, t in turns if r == "assistant"]
    inner = text.replace("</s>\n", "").replace("<s>", "") if not turns else "".join(chat.escape(r) + chat.escape(t) for r, t in turns)
    assert not any(c in inner for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_fold():
    m, d, e, r, x = "message", "delta", "edit", "regenerate", "delete"
    assert chat.fold([(m, "1", "user", "hi"), (d, "2", "assistant", "a"), (d, "2", None, "b"), (d, None, None, "c")]) == [("user", "hi"), ("assistant", "abc")]
    assert chat.fold([(m, "1", "user", "hi"), (m, "2", "assistant", "old"), (m, "3", "user", "x"), (r, "2", None, "new"), (d, "2", None, "!")]) == [("user", "hi"), ("assistant", "new!")]
    assert chat.fold([(m, "1", "user", "hi"), (m, "2", "assistant", "y"), (e, "1", None, "hello"), (x, "2", None, None), (x, "9", None, None)]) == [("user", "hello")]
    assert chat.fold([(None, None, None, None), (None, None, "user", "b")]) == [("", ""), ("user", "b")]
    assert chat.fold([]) == []
    with pytest.raises(ValueError, match="unknown"):
        chat.fold([("merge", None, "user", "x")])


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (None, 0, "user", None), (2**60 + 1, 0, None, "</s>"),
        (3, 0, "user", "long " * 200_000), (3, None, "assistant", "first"),
    ]
    turns = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, kind string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(chat.turns_as_events(turns))).collect()}
    assert set(got) == {1, None, 2**60 + 1, 3}
    assert got[1].n_turns == 3 and got[1].loss_chars == 2
    assert got[1].turns_sha256 == hashlib.sha256(b"user\na\nassistant\nb\nassistant\nb\n").hexdigest()
    assert got[None].n_turns == 1 and got[None].loss_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[3].turns_sha256 == hashlib.sha256(("assistant\nfirst\nuser\n" + "long " * 200_000 + "\n").encode()).hexdigest()


def test_empty(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_chats(chat.turns_as_events(turns))).count() == 0


def test_a_log_of_deltas_edits_and_regenerations_ends_in_the_turns(spark):
    rows = [(1, 0, "user", "héllo 😀!"), (1, 1, "assistant", "abc"), (1, 1, "assistant", "abc"), (1, 1, "user", "tie"), (1, 2, None, None), (1, 3, "assistant", ""), (1, 4, "assistant", None), (None, 0, "system", "x"), (2, None, "user", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    log = chat.turns_as_log(turns)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate", "delete"}
    told = lambda events: sorted((tuple(r) for r in chat.format_chats(events).collect()), key=repr)
    assert told(log) == told(chat.turns_as_events(turns))
    assert chat.turns_as_log(turns.limit(0)).count() == 0
