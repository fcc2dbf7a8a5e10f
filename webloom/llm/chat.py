"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole: every turn is ``<|role|>``, a line end, the
text, ``</s>`` and a line end.  Control strings inside roles and texts are broken
by a backslash after their first character, and backslashes are doubled, so
rendering can be undone and no text can pose as markup.  The rendered string is
encoded once, with character offsets; the sorted spans of the assistant's texts
are intersected with the sorted token offsets by binary search.  A token that
reaches over the border of a span is masked for the characters inside only
(``loss_starts``, ``loss_ends``), so a mask never teaches markup.

The tokenizer file is a parameter; its content (a few MB) is broadcast.  Rows
are shuffled by conversation, sorted within partitions and streamed, so a task
holds one conversation's text and one batch of rows at a time: a conversation
is one training record and comes out as one row.

Defined results: null text or role is empty; equal turns sort by role, then
text; repeated rows are turns of their own; a null turn sorts first; null
conv_id is a conversation of its own; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import prepare

CONTROL = ("<</SYS>>", "<<SYS>>", "[/INST]", "[INST]", "</s>", "<s>", "<|", "|>")
LEARNT_ROLE = "assistant"
SCHEMA = ("conv_id long, formatted string, input_ids array<int>, loss_tokens array<int>, "
          "loss_starts array<int>, loss_ends array<int>")
#: Characters that are encoded in one call.
_BATCH_CHARS = 2_000_000

_CONTROL = re.compile(f"(?={'|'.join(map(re.escape, CONTROL))})(.)", re.S)  # overlapping ones too
_ESCAPE = re.compile(r"\\(\\?)")
_TURN = re.compile(r"<\|(.*?)\|>\n(.*?)</s>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the learnt texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<|{escape(role)}|>\n", escape(text)
        if role == LEARNT_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</s>\n"]
        at += len(head) + len(body) + 5
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Undoes ``render``."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def mask(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray):
    """(token, start, end) of the tokens that overlap a span, clipped to it.

    Spans are disjoint and sorted, token offsets sorted; the tokens of one span
    are found by binary search."""
    out = [np.zeros((0, 3), dtype=np.int64)]
    for low, high in spans:
        i, j = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
        if i < j:
            out.append(np.column_stack([np.arange(i, j), np.maximum(starts[i:j], low), np.minimum(ends[i:j], high)]))
    return np.concatenate(out).T


def masked_text(formatted: str, starts, ends) -> str:
    """The text under the mask, each character once (several tokens may share one)."""
    out, done = [], 0
    for s, e in zip(starts, ends):
        if e > done:
            out.append(formatted[max(s, done):e])
            done = e
    return unescape("".join(out))


def _conversations(batches) -> Iterator[tuple]:
    own, turns, begun = None, [], False
    for b in batches:
        for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if begun and conv != own:
                yield own, turns
                turns = []
            own, begun = conv, True
            turns.append((role or "", text or ""))
    if begun:
        yield own, turns


def _batches(found, most: int) -> Iterator[list]:
    some, size = [], 0
    for conv, turns in found:
        some.append((conv, *render(turns)))
        size += len(some[-1][1])
        if size >= most:
            yield some
            some, size = [], 0
    if some:
        yield some


def _encoder(content: str):
    from tokenizers import Tokenizer, processors
    tokenizer = Tokenizer.from_str(content)
    tokenizer.encode_special_tokens = True
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)  # a token's blank is part of its span
    return tokenizer


def format_conversations(rows: DataFrame, tokenizer_json: str) -> DataFrame:
    """One row per conversation (see ``SCHEMA``) of ``rows`` (conv_id, turn, role, text)."""
    spark = rows.sparkSession
    prepare(spark)
    with open(tokenizer_json, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = _encoder(shared.value)
        for some in _batches(_conversations(batches), _BATCH_CHARS):
            cols = [[] for _ in range(6)]
            for (conv, text, spans), enc in zip(some, tokenizer.encode_batch([x[1] for x in some], add_special_tokens=False)):
                offsets = np.array(enc.offsets, dtype=np.int64).reshape(-1, 2)
                token, start, end = mask(spans, offsets[:, 0], offsets[:, 1])
                for col, v in zip(cols, (conv, text, np.array(enc.ids, dtype=np.int32), *(x.astype(np.int32) for x in (token, start, end)))):
                    col.append(v)
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), ints, ints, ints, ints))],
                ["conv_id", "formatted", "input_ids", "loss_tokens", "loss_starts", "loss_ends"])

    sent = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    return sent.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, SCHEMA)
