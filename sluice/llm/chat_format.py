"""Chat formatting with a grammar round trip.

The template marks turns with control strings:

    conversation = "<s>" turn* "</s>"
    turn         = "[TURN " role "]" text "[/TURN]"        role, text: escaped

A conversation is first rendered as it is and reparsed by a deterministic parser. If the
recovered turns differ from the source, because a text or role holds a control string,
the conflicting content is escaped and the round trip repeated until it is identical.
Escaping puts a backslash after the first character of every control string and doubles
every backslash that stands there already, so it is reversible, and one pass always
settles: an escaped text holds no control string.

The parser also gives the loss mask: the spans of the rendered text that hold assistant
texts, between markers.

Turns are grouped by conversation with one shuffle and read in order from sorted
partitions, one conversation at a time, so a partition of any size needs the memory of
its largest conversation only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template's control strings, and what other templates use for control.
START, END, TURN, ROLE_END, TURN_END = "<s>", "</s>", "[TURN ", "]", "[/TURN]"
CONTROL = (START, END, TURN, TURN_END, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")

_BACKSLASHED = regex.compile("|".join(regex.escape(c[0]) + r"\\*" + regex.escape(c[1:]) for c in CONTROL))
_ESCAPED = regex.compile("|".join(regex.escape(c[0]) + r"\\+" + regex.escape(c[1:]) for c in CONTROL))
_ROLE = regex.compile(r"\\|\]")


def escape(text: str) -> str:
    """``text`` without control strings: one backslash more after their first character.
    What looks escaped already gets one more as well, so that unescaping is exact."""
    return _BACKSLASHED.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """The inverse of ``escape``: one backslash less after the first character."""
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("]", "\\]")


def unescape_role(role: str) -> str:
    return unescape(regex.sub(r"\\(.)", r"\1", role, flags=regex.DOTALL))


def render(turns: list[tuple[str, str]], escaped: bool) -> str:
    """The turns in the template, their content escaped or as it is."""
    role_of, text_of = (escape_role, escape) if escaped else (str, str)
    return START + "".join(f"{TURN}{role_of(r)}{ROLE_END}{text_of(t)}{TURN_END}" for r, t in turns) + END


def parse(rendered: str, escaped: bool) -> tuple[list[tuple[str, str]], list[tuple[int, int]]] | None:
    """The turns and the spans of their texts, or None if the grammar does not hold.

    Deterministic: at each place the next control string decides, and none may stand
    where the grammar does not ask for it."""
    at, turns, spans = len(START), [], []
    if not rendered.startswith(START):
        return None
    while rendered.startswith(TURN, at):
        low = at = at + len(TURN)
        while True:  # the first bracket that no backslash protects ends the role
            found = _ROLE.search(rendered, at)
            if found is None:
                return None
            if found[0] == ROLE_END:
                break
            if not escaped:
                at = found.end()
                continue
            at = found.end() + 1
        role, low = rendered[low: found.start()], found.end()
        high = rendered.find(TURN_END, low)
        if high < 0:
            return None
        text = rendered[low:high]
        if any(c in text for c in CONTROL):
            return None
        turns.append((unescape_role(role), unescape(text)) if escaped else (role, text))
        spans.append((low, high))
        at = high + len(TURN_END)
    return (turns, spans) if rendered[at:] == END else None


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, bool, list[tuple[str, str]], list[tuple[int, int]]]:
    """(rendered, escaped, turns read back, their spans), read back equal to the source."""
    for escaped in (False, True):
        rendered = render(turns, escaped)
        back = parse(rendered, escaped)
        if back is not None and back[0] == turns:
            return rendered, escaped, *back
    raise AssertionError("escaped content must round-trip")


def _by_conversation(loss_role: str):
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    schema = pa.schema([("conversation", pa.int64()), ("formatted", pa.string()), ("escaped", pa.bool_()),
                        ("turns", pa.list_(turn)), ("loss_spans", pa.list_(span)), ("loss_texts", pa.list_(pa.string()))])

    def row(key, turns):
        rendered, escaped, back, spans = format_turns(turns)
        loss = [s for (role, _), s in zip(back, spans, strict=True) if role == loss_role]
        texts = [unescape(rendered[a:b]) if escaped else rendered[a:b] for a, b in loss]
        return (key, rendered, escaped, [{"role": r, "text": t} for r, t in back],
                [{"start": a, "end": b} for a, b in loss], texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, turns, rows, size = None, [], [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for k, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if turns and k != key:
                    rows.append(row(key, turns))
                    size += len(rows[-1][1])
                    turns = []
                    if size > 2 << 20:
                        yield out()
                        rows, size = [], 0
                key = k
                turns.append((role, text))
        if turns:
            rows.append(row(key, turns))
        if rows:
            yield out()

    return run


def format_conversations(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation (a long): ``conversation``, ``formatted``, ``escaped``, and read back
    from the output: ``turns`` (role, text), ``loss_spans`` (code points of ``formatted`` under
    the loss mask) and ``loss_texts`` (the same, unescaped).

    Turns are ordered by ``turn`` (nulls first), then role and text, so ties and repeated
    rows, which all stay, have one order. Null roles and texts are empty; rows of null
    conversation form one conversation of null id. Other columns are not used; an empty
    table has no conversations.
    """
    clean = turns.select(F.col(conversation).cast("long").alias("c"), F.col(turn).alias("t"),
                         F.coalesce(F.col(role), F.lit("")).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("x"))
    ordered = clean.repartition("c").sortWithinPartitions("c", "t", "r", "x").select("c", "r", "x")
    return ordered.mapInArrow(
        _by_conversation(loss_role),
        "conversation long, formatted string, escaped boolean, turns array<struct<role:string,text:string>>, "
        "loss_spans array<struct<start:long,end:long>>, loss_texts array<string>")
