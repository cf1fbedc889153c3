"""Chat formatting against formatting every prefix anew."""

import hashlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from txnlake.llm import chat

PIECES = [*chat.CONTROL, "\\", "<", "[", "/", "s>", "INST]", " ", "\n", "a", "é", "<\\s>", "[\\\\/INST]", "<<", "SYS>>", "<s", "</", ">", "]", ""]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool", "<s>", "</s>\\"]), st.lists(st.sampled_from(PIECES), max_size=8)), max_size=6))
def test_turns_come_back(talk):
    talk = [(role, "".join(parts)) for role, parts in talk]
    text = "".join("".join(chat.formatted(role, body)) for role, body in talk)
    assert list(chat.turns(text)) == talk


def test_no_control_string_stays():
    for parts in product(PIECES, repeat=3):
        text = "".join(parts)
        assert not any(c in chat.escaped(text) for c in chat.CONTROL)
        assert chat.unescaped(chat.escaped(text)) == text
    assert chat.escaped("</s>[INST] ok <\\s> [x]") == "<\\/s>[\\INST] ok <\\\\s> [x]"


TURNS = [
    (1, 0, "system", "be <s>kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello </s>"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (2, 0, "user", "no reply [INST]"), (3, 0, "assistant", "first\nword"), (3, None, "user", "no turn"), (3, 1, None, "nobody"), (3, 1, "tool\n", "é" * 30),
    (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (4, 1, "user", "u" * 5000), (None, 0, "user", "lost"), (None, 1, "assistant", "found"),
    *[(5, i, "assistant" if i % 3 else "user", f"turn {i} " + "x" * (i % 7)) for i in range(120)], (6, 0, "user", "y" * 300_000), (6, 1, "assistant", "z" * 200_000),
    (7, -3, "assistant", " [/INST]"), (7, 2, "user", "</s>"), (7, 10, "user", "later"),
]


def plain():
    talks = {}
    for conv, turn, role, text in TURNS:
        talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out, digests = [], []
    for conv, talk in talks.items():
        talk = [x[2:] for x in sorted(talk)]
        mine = []
        for i, (role, body) in enumerate(talk):
            if role == "assistant" or i == len(talk) - 1:
                text = "".join("".join(chat.formatted(*t)) for t in talk[: i + 1])
                end = len(text) - len("</s>")
                mine.append((conv, text, *((end - len(chat.escaped(body)), end) if role == "assistant" else (None, None))))
        out += mine
        replies = [body for role, body in talk if role == "assistant"]
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        digests.append((
            conv, len(talk), sha("".join(f"{r}\n{b}\n" for r, b in talk)), sum(map(len, replies)), sha("".join(replies)), sum(len(x[1]) for x in mine), len(mine)
        ))
    return out, digests


@pytest.mark.parametrize("context", [chat.CONTEXT, 50, 1])
def test_examples_equal_plain(spark, tmp_path, context):
    rows = [(*t, "k", "e") for t in reversed(TURNS)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, kind string, example string").repartition(5)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want, digests = plain()
    made = chat.examples(table, context)
    assert sorted(map(tuple, chat.whole_texts(made).collect()), key=key) == sorted(want, key=key)
    assert sorted(map(tuple, chat.read_back(made).collect()), key=key) == sorted(digests, key=key)
    made.repartition(7).write.parquet(str(tmp_path / "made"))
    stored = chat.in_order(spark.read.parquet(str(tmp_path / "made")))
    assert sorted(map(tuple, chat.read_back(stored).collect()), key=key) == sorted(digests, key=key)
    # the output of a long conversation grows with its text, not with its square
    size = sum(len(r.text) for r in made.where("conv_id = 5").collect())
    if context == 50:
        assert size < 5 * sum(len(t[3]) + 20 for t in TURNS if t[0] == 5)
    if context == 1:
        assert chat.read_back(chat.examples(table.where("false"))).count() == 0
