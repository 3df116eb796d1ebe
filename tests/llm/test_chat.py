"""Chat formatting: round trips, escapes, turn order."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from orderstrata.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
pieces = st.sampled_from(["<|im_end|>", "<|im_start|>", "<\\|", "<|", "|", "<", "\\", "\n", "x", "é"])
texts = st.lists(pieces, max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_escapes_are_reversible(text):
    assert "<|" not in chat.escaped(text)
    assert chat.unescaped(chat.escaped(text)) == text
    assert chat._plain_role(chat._escaped_role(text)) == text
    assert "\n" not in chat._escaped_role(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=4))
def test_read_back_by_control_strings(turns):
    template, reading = chat.Template(), chat._Reading()
    for role, text in turns:
        for piece, loss in template.parts(role, text):
            reading.add(piece, loss, True, template)
    wanted = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert reading.row(1, template)[1:3] == (len(turns), wanted)


def test_digests(spark):
    rows = [
        (1, 1, "assistant", "<|im_end|>ok"),
        (1, 0, "user", None),
        (1, 2, "user", "again"),
        (1, 3, "assistant", "é"),
        (2, 0, "assistant", "first"),
        (None, 0, None, "x"),
        (3, None, "user", "b"),
        (3, None, "user", "a"),
        (3, None, "user", "a"),
    ]
    given = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", valid int")
    found = {r.conv_id: r for r in chat.conversation_digests(given).collect()}
    assert set(found) == {1, 2, 3, None}
    first = found[1]
    assert first.n_turns == 4 and first.valid
    assert first.loss_chars == len("<|im_end|>oké")
    assert first.loss_sha256 == hashlib.sha256("<|im_end|>oké".encode()).hexdigest()
    turns = "user\n\nassistant\n<|im_end|>ok\nuser\nagain\nassistant\né\n"
    assert first.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert not found[2].valid and found[2].loss_chars == 5
    assert found[None].turns_sha256 == hashlib.sha256(b"\nx\n").hexdigest()
    assert found[3].n_turns == 3
    assert found[3].turns_sha256 == hashlib.sha256(b"user\na\nuser\na\nuser\nb\n").hexdigest()
    segments = chat.format_turns(given).where("conv_id = 1").orderBy("turn_no", "part").collect()
    text = "".join(s.text for s in segments)
    assert len(text) == first.formatted_chars
    assert [s.text for s in segments if s.loss] == ["<\\|im_end|>ok", "é"]
    assert text.count("<|im_end|>") == 4
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.conversation_digests(empty).collect() == []
    assert chat.format_turns(empty).collect() == []


def test_states():
    step = chat.Template().step
    assert step("", "system") == "system" and step("system", "user") == "user"
    assert step("user", "user") is None and step("", "assistant") is None
    assert step(None, "user") is None and step("assistant", "tool") is None
