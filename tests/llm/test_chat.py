import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from webloom.llm import chat
from webloom.llm.queries import TOKENIZER, op7_chat_format

SF = "/root/testdata/sf0.001"
pieces = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "|", ">", "[", "/", "INST]", "s>", "a", " ", "\n", "é", "日本", "🙂", "<|endoftext|>"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), pieces), pieces), max_size=6))
def test_round_trip(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    for role, text in turns:
        assert not any(c in chat.escape(text) or c in chat.escape(role) for c in chat.CONTROL)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), pieces), min_size=1, max_size=5))
def test_mask_is_exact(turns):
    with open(TOKENIZER, encoding="utf-8") as f:
        enc = _tokenizer(f.read()).encode(chat.render(turns)[0], add_special_tokens=False)
    formatted, spans = chat.render(turns)
    offsets = np.array(enc.offsets)
    token, start, end = chat.mask(spans, offsets[:, 0], offsets[:, 1])
    assert chat.masked_text(formatted, start, end) == "".join(t for r, t in turns if r == "assistant")
    inside = {i for i, (a, b) in enumerate(enc.offsets) if any(a < hi and b > lo for lo, hi in spans)}
    assert set(token.tolist()) == inside


_cache = {}


def _tokenizer(content):
    return _cache.setdefault("t", chat._encoder(content))


def want(turns):
    t = "".join(f"{r or ''}\n{x or ''}\n" for r, x in turns)
    loss = "".join(x or "" for r, x in turns if r == "assistant")
    return len(turns), hashlib.sha256(t.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_query_reads_back_every_conversation(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    convs = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        convs.setdefault(r.conv_id, []).append((r.role, r.text))
    convs[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in op7_chat_format(spark, SF).collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        assert tuple(got[c])[1:5] == want(turns) and got[c].formatted_chars == len(chat.render(turns)[0])


def test_edge_cases(spark):
    rows = [(1, 2, "assistant", "b"), (1, 0, "user", None), (1, 2, "assistant", "b"), (1, 2, "assistant", "a"), (2, None, None, "x"),
            (2, 5, "assistant", ""), (None, 0, "user", "hi"), (3, 0, "assistant", "long text " * 60_000)]
    d = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.format_conversations(d, TOKENIZER).collect()}
    assert chat.parse(got[1].formatted) == [("user", ""), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")]
    assert chat.masked_text(got[1].formatted, got[1].loss_starts, got[1].loss_ends) == "abb"
    assert chat.parse(got[2].formatted) == [("", "x"), ("assistant", "")] and not got[2].loss_tokens
    assert chat.parse(got[None].formatted) == [("user", "hi")]
    assert len(chat.masked_text(got[3].formatted, got[3].loss_starts, got[3].loss_ends)) == 600_000
    assert max(got[3].loss_tokens) < len(got[3].input_ids)
    assert chat.format_conversations(d.limit(0), TOKENIZER).count() == 0


@pytest.mark.parametrize("text", ["</s>", "\\", "\\\\</s>\\", "<\\/s>", "[[INST]INST]"])
def test_escape(text):
    assert chat.unescape(chat.escape(text)) == text
