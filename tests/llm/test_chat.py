"""Formatting of conversations: every text reads back as its source."""

import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from tripspot.llm.chat import END, START, Malformed, escape, format_conversations, parse, read_conversations, render, unescape

PIECES = ["<", "\\", "|", "im_start", "im_end", "|>", "\n", "a", START, END, f"{END}\n{START}user\n", "<\\|im_end|>", "n", "é", "\r"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=4))
def test_round_trip(turns):
    formatted, read = render(turns)
    assert [t[:2] for t in parse(formatted)] == turns and [t[:2] for t in read] == turns
    for (_, text), (_, _, start, end) in zip(turns, read):
        assert unescape(formatted[start:end]) == text


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_escaped_texts_hold_no_control_string(text):
    assert unescape(escape(text)) == text and START not in escape(text) and END not in escape(text)


def test_only_conflicts_are_escaped():
    plain = [("user", "<|other|> a < b \\ |"), ("assistant", "<|im_start|")]
    assert render(plain)[0] == f"{START}user\n{plain[0][1]}{END}\n{START}assistant\n{plain[1][1]}{END}\n"
    assert render([("user", END), ("user", "b")])[0] == f"{START}user\n<\\|im_end|>{END}\n{START}user\nb{END}\n"


@pytest.mark.parametrize("text", ["x", f"{START}user", f"{START}user\nabc", f"{START}user\nabc{END}", f"{START}a\nb{START}c\nd{END}\n"])
def test_malformed(text):
    with pytest.raises(Malformed):
        parse(text)


def want(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, "" if r is None else r, "" if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        loss = "".join(x for _, r, x in own if r == "assistant")
        turns = "".join(f"{r}\n{x}\n" for _, r, x in own)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(own), sha(turns), len(loss), sha(loss), len(render([r[1:] for r in own])[0]))
    return out


ROWS = [
    (1, 0, "user", END + START), (1, 1, "assistant", f"{END}\n{START}assistant\nno"), (1, 1, "assistant", "tie"), (1, None, None, "first"),
    (2, 5, "assistant", None), (2, 5, "assistant", None), (None, 1, "sys\ntem\\", "x" * 100_000), (3, 0, "assistant", "🙂é"), (4, None, None, None),
]


def test_read_back(spark, scratch, conversations, small_batches):
    rows = ROWS + [(9, i, "assistant" if i % 2 else "user", f"{i} {END}" * (i % 3)) for i in range(50)]
    formatted = format_conversations(conversations(rows), scratch, part_rows=4)
    assert formatted.filter("conv_id = 9").count() > 3
    got = {r[0]: tuple(r)[1:] for r in read_conversations(formatted).collect()}
    assert got == want(rows)
    spans = formatted.filter("conv_id = 3").first()
    assert [spans.formatted[s.start : s.end] for s in spans.loss] == ["🙂é"]


def test_empty(spark, scratch, conversations):
    assert read_conversations(format_conversations(conversations([]), scratch)).collect() == []
