"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and only its reply
under the loss mask. A conversation that does not end in a reply gets one more example with
no mask, so no turn is lost.

The template: system `<<SYS>>text<</SYS>>`, user `[INST] text [/INST]`, assistant `text</s>`, any other role
`<s>role</s>text</s>`. Control strings inside texts and roles get a backslash after their first character, and those that
have backslashes there get one more. So no text can pose as a mark, and taking one
backslash off again gives the text back.

The context of a long conversation repeats in each of its examples. Once CONTEXT characters of whole
turns have gathered they become a context row, written once; an example holds its text from the last context row on and the
number of context rows before it. So the output grows with the input and a task holds one such row and one turn, however long a
conversation is; most conversations have no context row and their examples hold everything. whole_texts() puts the parts
together. Rows are shuffled once by conversation and each conversation is then read as a
stream, in order, by one task.

Turns stand in the order of turn, nulls first, ties by role and text; equal rows are turns of their own. A null text or role
is an empty one. Rows without conv_id are one conversation, of null id. Further columns are not read. An
empty table has no examples. Offsets and lengths count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's marks before and after a text, by role, and its control strings.
TEMPLATE = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("", "</s>")}
CONTROL = ("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
REPLY = "assistant"
#: Characters of whole turns that make a context row, and characters in a batch of rows.
CONTEXT, BATCH = 1 << 16, 1 << 20
_REST = {first: "|".join(re.escape(c[1:]) for c in CONTROL if c[0] == first) for first in "<["}
_PLAIN = re.compile("|".join(rf"{re.escape(first)}(?=\\*(?:{rest}))" for first, rest in _REST.items()))
_ESCAPED = re.compile("|".join(rf"(?<={re.escape(first)})\\(?=\\*(?:{rest}))" for first, rest in _REST.items()))
EXAMPLES = "conv_id long, kind string, contexts int, text string, loss_start long, loss_end long, n_chars long"


def escaped(text: str) -> str:
    return _PLAIN.sub(r"\g<0>\\", text) if "<" in text or "[" in text else text


def unescaped(text: str) -> str:
    return _ESCAPED.sub("", text) if "\\" in text else text


def formatted(role: str, text: str) -> tuple[str, str, str]:
    """Mark, escaped text and mark of one turn."""
    before, after = TEMPLATE[role] if role in TEMPLATE else (f"<s>{escaped(role)}</s>", "</s>")
    return before, escaped(text), after


def turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted run of whole turns."""
    at = 0

    def upto(mark: str) -> str:
        nonlocal at
        end = text.index(mark, at)
        part, at = text[at:end], end + len(mark)
        return unescaped(part)

    while at < len(text):
        if text.startswith("<s>", at):
            at += len("<s>")
            role = upto("</s>")
            yield role, upto("</s>")
            continue
        role = next((r for r, (before, _) in TEMPLATE.items() if before and text.startswith(before, at)), REPLY)
        at += len(TEMPLATE[role][0])
        yield role, upto(TEMPLATE[role][1])


class _Conversation:
    """The rows of one conversation, turn by turn."""

    def __init__(self, conv_id: int | None, context: int):
        self.conv_id, self.context = conv_id, context
        self.contexts, self.before, self.text, self.open = 0, 0, "", False

    def row(self, kind: str, start: int | None = None, end: int | None = None) -> tuple:
        return self.conv_id, kind, self.contexts, self.text, start, end, self.before + len(self.text)

    def add(self, role: str, text: str) -> Iterator[tuple]:
        before, body, after = formatted(role, text)
        start = len(self.text) + len(before)
        self.text += before + body + after
        self.open = role != REPLY
        if not self.open:
            yield self.row("example", start, start + len(body))
        if len(self.text) >= self.context:
            yield self.row("context")
            self.contexts, self.before, self.text = self.contexts + 1, self.before + len(self.text), ""

    def end(self) -> Iterator[tuple]:
        if self.open:
            yield self.row("example")


def _batched(rows: Iterator[tuple], schema: pa.Schema, width: int) -> Iterator[pa.RecordBatch]:
    """Batches of about BATCH characters in column `width`."""
    waiting, size = [], 0
    for row in rows:
        waiting.append(row)
        size += 64 + len(row[width] or "")
        if size > BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting, strict=True), schema, strict=True)], schema=schema)
            waiting, size = [], 0
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting, strict=True), schema, strict=True)], schema=schema)


def _rows(batches, *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns], strict=True)


_EXAMPLES = pa.schema(
    [("conv_id", pa.int64()), ("kind", pa.string()), ("contexts", pa.int32()), ("text", pa.string())]
    + [(c, pa.int64()) for c in ("loss_start", "loss_end", "n_chars")]
)
_WHOLE = pa.schema([("conv_id", pa.int64()), ("text", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])


def examples(conversations: DataFrame, context: int = CONTEXT) -> DataFrame:
    """Examples and context rows of conversations (conv_id, turn, role, text), each conversation's in order.

    kind is example or context; contexts counts the context rows before the row; the loss mask of an example's
    text is from loss_start to loss_end, both null without a reply; n_chars is its length with all its context.
    """

    def run(batches):
        def rows():
            talk = None
            for conv_id, role, text in _rows(batches, "conv_id", "role", "text"):
                if talk is None or talk.conv_id != conv_id:
                    if talk is not None:
                        yield from talk.end()
                    talk = _Conversation(conv_id, context)
                yield from talk.add(role, text)
            if talk is not None:
                yield from talk.end()

        return _batched(rows(), _EXAMPLES, 3)

    empty = F.lit("")
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(run, EXAMPLES)


def in_order(stored: DataFrame) -> DataFrame:
    """Stored examples with each conversation's rows in one task and in order again."""
    return stored.repartition("conv_id").sortWithinPartitions("conv_id", "contexts", F.col("kind") == "context", "n_chars")


def whole_texts(rows: DataFrame) -> DataFrame:
    """(conv_id, text, loss_start, loss_end) of every example with all its context; rows as examples() gives them."""

    def run(batches):
        def whole():
            talk, context = None, ""
            for conv_id, kind, contexts, text, start, end in _rows(batches, "conv_id", "kind", "contexts", "text", "loss_start", "loss_end"):
                if talk != (conv_id,) or not contexts:
                    talk, context = (conv_id,), ""
                if kind == "context":
                    context += text
                else:
                    yield conv_id, context + text, *[None if x is None else len(context) + x for x in (start, end)]

        return _batched(whole(), _WHOLE, 1)

    return rows.mapInArrow(run, "conv_id long, text string, loss_start long, loss_end long")


def read_back(rows: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, read from its formatted rows as examples() gives them.

    Turns are parsed from the context rows and the last example, replies from under the masks. A conversation's
    texts go through running digests and are never gathered.
    """

    def run(batches):
        talk, last = None, ""

        def read(text):
            for role, body in turns(text):
                talk["n"] += 1
                talk["turns"].update(f"{role}\n{body}\n".encode())

        def told():
            read(last)
            return talk["id"], talk["n"], talk["turns"].hexdigest(), talk["chars"], talk["loss"].hexdigest(), talk["all"], talk["examples"]

        def conversations():
            nonlocal talk, last
            for conv_id, kind, text, start, end, n_chars in _rows(batches, "conv_id", "kind", "text", "loss_start", "loss_end", "n_chars"):
                if talk is None or talk["id"] != conv_id:
                    if talk is not None:
                        yield told()
                    talk = {"id": conv_id, "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0, "examples": 0}
                    last = ""
                if kind == "context":
                    read(text)
                    last = ""
                    continue
                reply = "" if start is None else unescaped(text[start:end])
                talk["loss"].update(reply.encode())
                talk["chars"] += len(reply)
                talk["all"] += n_chars
                talk["examples"] += 1
                last = text
            if talk is not None:
                yield told()

        return _batched(conversations(), _DIGESTS, 2)

    return rows.mapInArrow(run, DIGESTS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"
_DIGESTS = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DIGESTS.split(", ")])
