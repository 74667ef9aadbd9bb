"""Round trips of adversarial turns, and conversations against their source."""

import random

from sluice.llm import chat_format as C

BITS = [*C.CONTROL, "\\", "]", "[", "<", "s>", "/TURN]", "TURN ", "a", "\n", " ", "[\\TURN x]", "<\\s>", "<\\\\/s>", "]\\", "", "</", "é"]


def test_any_content_round_trips():
    rng = random.Random(0)
    for _ in range(5000):
        turns = [("".join(rng.choices(BITS, k=rng.randint(0, 4))), "".join(rng.choices(BITS, k=rng.randint(0, 6)))) for _ in range(rng.randint(0, 3))]
        rendered, escaped, back, spans = C.format_turns(turns)
        assert back == turns and C.parse(rendered, escaped) == (back, spans)
        assert all(C.unescape(C.escape(t)) == t and not any(c in C.escape(t) for c in C.CONTROL) for _, t in turns)


def test_plain_content_is_left_as_it_is():
    rendered, escaped, *_ = C.format_turns([("user", "a <\\s> b"), ("assistant", "ok")])
    assert not escaped and rendered == "<s>[TURN user]a <\\s> b[/TURN][TURN assistant]ok[/TURN]</s>"


def test_parser_refuses_what_the_grammar_does_not_hold():
    for bad in ("", "<s>", "<s>x</s>", "<s>[TURN a]b</s>", "<s>[TURN a]<s>[/TURN]</s>", "<s>[TURN a", "<s>[TURN a]b[/TURN]</s> "):
        assert C.parse(bad, False) is None


def test_conversations(spark):
    rows = [(1, 1, "assistant", "hi</s>", "e"), (1, 0, "user", None, "e"), (2, 0, None, "x", "e"), (None, 3, "assistant", "n", "e"), (None, None, "user", "m", "e"),
            (3, 0, "assistant", "same", "e"), (3, 0, "assistant", "same", "e"), (4, 0, "assistant", "a" * 100_000 + "[INST]", "e")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string").repartition(3)
    out = {r.conversation: r for r in C.format_conversations(df).collect()}
    plain = {k: [tuple(t) for t in r.turns] for k, r in out.items()}
    assert plain[1] == [("user", ""), ("assistant", "hi</s>")] and plain[2] == [("", "x")] and plain[None] == [("user", "m"), ("assistant", "n")]
    assert plain[3] == [("assistant", "same")] * 2 and out[3].loss_texts == ["same", "same"]
    assert out[1].escaped and out[1].loss_texts == ["hi</s>"] and not out[2].escaped and out[2].loss_texts == []
    assert plain[4] == [("assistant", "a" * 100_000 + "[INST]")]
    for r in out.values():
        cut = [r.formatted[s.start: s.end] for s in r.loss_spans]
        assert [C.unescape(x) if r.escaped else x for x in cut] == r.loss_texts
    assert C.format_conversations(df.limit(0)).count() == 0
