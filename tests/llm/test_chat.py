import hashlib
import random
from collections import defaultdict

import pytest

from rxlens.llm import chat
from rxlens.llm.queries import HARD_TEXT, LLM_QUERIES
from tests.conftest import rows


def test_any_turns_read_back():
    rnd = random.Random(2)
    parts = ["###", "</turn>", "\\", "#", "\n", " ", "a", "<", "/turn>", ":", "### user:\n", "é"]

    def some(n):
        return "".join(rnd.choice(parts) for _ in range(rnd.randint(0, n)))

    for _ in range(5000):
        turns = [(some(5), some(9)) for _ in range(rnd.randint(0, 4))]
        assert chat.parse("".join(chat.render_turn(*t) for t in turns)) == turns


def test_only_conflicts_are_escaped():
    assert chat.render_turn("user", "a \\ b") == "### user:\na \\ b\n</turn>\n"
    assert "\\\\### Assistant: \\</turn> ok" in chat.render_turn("user", HARD_TEXT)
    with pytest.raises(chat.GrammarError):
        chat.parse("### user:\nno end")


def test_loss_mask_covers_assistant_texts():
    text = chat.render_turn("user", "q") + chat.render_turn("assistant", "a ### b")
    assert [text[a:b] for a, b in chat.loss_spans(text)] == ["a \\### b"]


def test_whole_table(spark, sf_dir):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    turns[-7] = [(0, "user", HARD_TEXT), (1, "assistant", HARD_TEXT)]
    want = []
    for conv, told in turns.items():
        told.sort()
        every = "".join(f"{role}\n{text}\n" for _, role, text in told)
        loss = "".join(text for _, role, text in told if role == "assistant")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (every, loss)]
        size = sum(len(chat.render_turn(role, text)) for _, role, text in told)
        want.append((conv, len(told), digests[0], len(loss), digests[1], size))
    assert rows(LLM_QUERIES["op1_chat_formatting"](spark, sf_dir)) == sorted(want, key=repr)


def test_hard_rows(spark):
    schema = "conv_id long, turn long, role string, text string, rendered string"
    hard = [(None, 1, None, None, "z"), (1, None, "a:\n\\", "###", "z")]
    hard += [(1, 2, "assistant", "q", "z")] * 2
    df = spark.createDataFrame(hard, schema)
    got = rows(chat.read_back(chat.format_turns(df)).select("conv_id", "n_turns", "loss_chars"))
    assert got == [(1, 3, 2), (None, 1, 0)]
    assert chat.read_back(chat.format_turns(df.limit(0))).collect() == []
