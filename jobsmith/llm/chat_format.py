"""Chat formatting by grammar round trip.

A conversation is written in one template and read again by a deterministic
parser; what comes back is compared to the source, and content that conflicts with
the template is escaped until both are identical.

Grammar (one token decides every step; ``TEXT`` ends at the next control string,
which must be the one that the rule names)::

    part = turn*
    turn = "[INST] " TEXT " [/INST]"                        user
         | " " TEXT " </s>"                                 assistant
         | "<<SYS>>\\n" TEXT "\\n<</SYS>>\\n\\n"            system
         | "<|role|>" TEXT "<|text|>" TEXT "<|end|>"        any other role

In a ``TEXT`` a control string with backslashes after its first character stands
for the one with a backslash less, so escaping adds one backslash to every control
string, escaped or not, and undoing it takes one off. A text that holds none is
written as it is. ``<s>`` is a control string too: the sequence's beginning is left
to the tokenizer.

``format_chat`` deals turns by (conversation, turn) ranges and writes parts: whole
turns, some ``PART_CHARS`` characters, with the spans of the loss mask (the
assistants' texts). A long conversation is many parts of several tasks; parts in
order, joined, are its formatted text. ``read_chat`` parses them again.

Turns ascend by turn number (null first), then role and hash of the text; null roles and texts
are empty; repeated rows are turns of their own; rows with a null conversation are
a conversation of null id. Texts of any length are one turn, written whole. Other
columns, whatever their names, are not looked at. An empty table gives no parts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsmith.llm.common import width

#: opening, closing of the named roles' texts
ROLES = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n\n")}
OTHER, MIDDLE, END = "<|role|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"
CONTROL = ("<<SYS>>", "<</SYS>>", "</s>", "<s>", "[INST]", "[/INST]", OTHER, MIDDLE, END)
PLAIN = re.compile("|".join(map(re.escape, CONTROL)))
ANY = re.compile("|".join(rf"{re.escape(c[0])}(?:\\)*{re.escape(c[1:])}" for c in CONTROL))
ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}(?:\\)+{re.escape(c[1:])}" for c in CONTROL))
PART_CHARS = 1 << 20
MOST_ROUNDS = 8


class NotInGrammar(ValueError):
    """The text is not of the template's grammar."""


def escape(text: str) -> str:
    return ANY.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def render(role: str, text: str, rounds: int = 0) -> tuple[str, int]:
    """A turn in the template, its contents escaped ``rounds`` times, and where its text begins."""
    for _ in range(rounds):
        role, text = escape(role), escape(text)
    if role in ROLES:
        before, after = ROLES[role]
    else:
        before, after = OTHER + role + MIDDLE, END
    return before + text + after, len(before)


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """Turns (role, unescaped text, begin and end of the text as written) of a part."""
    turns, at = [], 0

    def content(begin: int, closing: str) -> int:
        """Where the text that begins here ends: at the next control string, which must close it."""
        m = PLAIN.search(text, begin)
        end = m.start() - (len(closing) - len(closing.lstrip())) if m else -1
        if end < begin or not text.startswith(closing, end):
            raise NotInGrammar(f"no {closing!r} for the text at {begin}")
        return end
    while at < len(text):
        role = next((r for r, (before, _) in ROLES.items() if text.startswith(before, at)), None)
        if role is not None:
            begin, after = at + len(ROLES[role][0]), ROLES[role][1]
        elif text.startswith(OTHER, at):
            end = content(at + len(OTHER), MIDDLE)
            role, begin, after = unescape(text[at + len(OTHER):end]), end + len(MIDDLE), END
            if role in ROLES:
                raise NotInGrammar(f"{role!r} has a rule of its own")
        else:
            raise NotInGrammar(f"no turn begins at {at}")
        end = content(begin, after)
        turns.append((role, unescape(text[begin:end]), begin, end))
        at = end + len(after)
    return turns


def _recovered(text: str) -> list[tuple[str, str]] | None:
    try:
        return [(role, said) for role, said, *_ in parse(text)]
    except NotInGrammar:
        return None


def write_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Turns in the template, read back and escaped until identical; and the spans of the loss mask.

    Each round escapes once more the turns that do not come back by themselves, or all of them if
    only the whole does not."""
    rounds = [0] * len(turns)
    for _ in range(MOST_ROUNDS):
        written = [render(*t, k) for t, k in zip(turns, rounds)]
        text = "".join(w for w, _ in written)
        if _recovered(text) == turns:
            spans, at = [], 0
            for (role, _), (w, begin), k in zip(turns, written, rounds):
                if role == LOSS_ROLE:
                    spans.append((at + begin, at + len(w) - len(ROLES[role][1])))
                at += len(w)
            return text, spans
        bad = [_recovered(w) != [t] for t, (w, _) in zip(turns, written)]
        rounds = [k + (b or not any(bad)) for k, b in zip(rounds, bad)]
    raise NotInGrammar("the turns do not come back from the template")


PARTS = "conv_id long, n_turns long, text string, loss array<struct<begin:int,end:int>>"
_PARTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("text", pa.string()),
                    ("loss", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))])


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the turns that come in order, a few megabytes at a time."""
    conv, held, chars, out, size = None, [], 0, [], 0

    def close() -> dict:
        text, spans = write_turns(held)
        return {"conv_id": conv, "n_turns": len(held), "text": text, "loss": [{"begin": a, "end": b} for a, b in spans]}
    for batch in batches:
        for c, role, text in zip(*(batch.column(k) for k in ("c", "role", "text"))):
            c, role, text = c.as_py(), role.as_py(), text.as_py()
            if held and (c != conv or chars > PART_CHARS):
                out.append(close())
                size += chars
                held, chars = [], 0
                if size > 4 * PART_CHARS:
                    yield pa.RecordBatch.from_pylist(out, _PARTS)
                    out, size = [], 0
            conv = c
            held.append((role, text))
            chars += len(text)
    if held:
        out.append(close())
    if out:
        yield pa.RecordBatch.from_pylist(out, _PARTS)


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """Rows (conv_id, part, n_turns, text, loss): parts ascend in a conversation, ``loss`` holds the spans of
    the part's text (in code points) that a model is trained on."""
    none = F.lit("")
    own = turns.select(F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("k"),
                       F.coalesce(F.col(role_col), none).alias("role"), F.coalesce(F.col(text_col), none).alias("text")) \
        .withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = ["c", "k", "role", "h", "row"]
    dealt = own.repartitionByRange(width(turns.sparkSession), *order).sortWithinPartitions(*order)
    return dealt.select("c", "role", "text").mapInArrow(_write, PARTS).withColumn("part", F.monotonically_increasing_id())


def read_chat(parts: DataFrame) -> DataFrame:
    """Rows (conv_id, part, place, role, text, trained): the turns, parsed from the parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, part, text, loss in _rows(batch):
                spans = set(loss)
                turns = parse(text)
                yield pa.RecordBatch.from_pydict({
                    "conv_id": pa.array([conv] * len(turns), pa.int64()), "part": pa.array([part] * len(turns), pa.int64()),
                    "place": pa.array(range(len(turns)), pa.int64()), "role": pa.array([t[0] for t in turns], pa.string()),
                    "text": pa.array([t[1] for t in turns], pa.string()),
                    "trained": pa.array([t[2:] in spans for t in turns], pa.bool_())})
    return parts.select("conv_id", "part", "text", "loss").mapInArrow(
        run, "conv_id long, part long, place long, role string, text string, trained boolean")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for conv, part, text, loss in zip(*(batch.column(k) for k in ("conv_id", "part", "text", "loss"))):
        yield conv.as_py(), part.as_py(), text.as_py(), [(x["begin"], x["end"]) for x in loss.as_py()]


def digest(parts: DataFrame) -> DataFrame:
    """One row per conversation, read from its parts in order (a part at a time): turns, their SHA-256 (role,
    line break, text, line break), the characters and SHA-256 of the text under the loss mask, and
    the characters of the formatted text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, began, out = None, False, []

        def close() -> dict:
            return {"conv_id": conv, "n_turns": n, "turns_sha256": all_.hexdigest(), "loss_chars": loss_chars,
                    "loss_sha256": trained.hexdigest(), "formatted_chars": chars}
        for batch in batches:
            for c, _, text, loss in _rows(batch):
                if began and c != conv:
                    out.append(close())
                    began = False
                if not began:
                    conv, began, n, loss_chars, chars = c, True, 0, 0, 0
                    all_, trained = hashlib.sha256(), hashlib.sha256()
                for role, said, *_ in parse(text):
                    n += 1
                    all_.update(f"{role}\n{said}\n".encode())
                for a, b in loss:
                    said = unescape(text[a:b])
                    loss_chars += len(said)
                    trained.update(said.encode())
                chars += len(text)
            if out:
                yield pa.RecordBatch.from_pylist(out, _DIGEST)
                out = []
        if began:
            yield pa.RecordBatch.from_pylist([close()], _DIGEST)
    return parts.select("conv_id", "part", "text", "loss").repartition(width(parts.sparkSession), "conv_id") \
        .sortWithinPartitions("conv_id", "part").mapInArrow(
            run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
