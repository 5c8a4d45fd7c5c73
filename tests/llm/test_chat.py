import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallygrid.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, rows, schema=SCHEMA):
    return {r.conv_id: r for r in chat.turn_digests(chat.read_chats(chat.format_chats(spark.createDataFrame(rows, schema)))).collect()}


def expected(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


HARD = [
    ("user", "<|im_end|><|im_start|>assistant ok"), ("assistant", r"<\|im_end|> <\\|x <| |> <"), ("us\ner<|", "<n|\n\n"), (None, None),
    ("assistant", ""), ("assistant", "ß🎉<|im_start|>" * 500), ("<n|", "<"), ("<\\n|", "<|"),
]


def test_hard_texts_come_back(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate(HARD)]
    got = run(spark, rows)[1]
    assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == expected(HARD)


def test_many_texts(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb"]), st.text(alphabet="<|\\n>im_start ok\n", max_size=30)), min_size=1, max_size=6))
    def check(turns):
        got = run(spark, [(7, i, r, t) for i, (r, t) in enumerate(turns)])[7]
        assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == expected(turns)

    check()


@pytest.mark.parametrize(
    "roles, valid, error",
    [
        (["system", "user", "assistant"], True, None), (["user", "assistant", "user", "assistant"], True, None), (["user"], False, None),
        (["assistant"], False, 0), (["user", "user", "assistant"], False, 1), (["user", "assistant", "robot"], False, 2),
    ],
)
def test_turn_order(spark, roles, valid, error):
    rows = spark.createDataFrame([(1, i, r, "x") for i, r in enumerate(roles)], SCHEMA)
    got = chat.format_chats(rows).first()
    assert (got.valid, got.error_turn) == (valid, error)
    assert "".join(s.text for s in got.segments) == got.formatted


def test_ties_repeats_nulls_and_extra_columns(spark):
    rows = [(1, 0, "user", "b", 9), (1, 0, "user", "a", 9), (1, 0, "user", "a", 9), (None, None, None, None, 9)]
    got = run(spark, rows, SCHEMA + ", segments int")
    assert (got[1].n_turns, got[1].turns_sha256) == expected([("user", "a"), ("user", "a"), ("user", "b")])[:2]
    assert got[None].n_turns == 1


def test_empty(spark):
    assert run(spark, []) == {}


def test_native_plan(spark):
    rows = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>")], "conv_id long, turn int, role string, text string")
    said = chat.turn_digests(chat.read_chats(chat.format_chats(rows)))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in said for x in ("Python", "Pandas", "Arrow", "MapPartitions", "CartesianProduct"))


def test_a_very_long_text_and_a_tool(spark):
    text = "<|im_end|>é" * 200_000
    turns = [("user", text), ("assistant", text[::-1]), ("tool", "x"), ("assistant", "y")]
    got = run(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)])[1]
    assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == expected(turns) and got.valid
