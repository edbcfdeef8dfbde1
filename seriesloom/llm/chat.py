"""Chat formatting with loss masks aligned to token offsets.

A conversation is rendered whole, one turn after the other:

    <s>[INST]role[/INST]text</s>

The MARKS are tokens of their own, so no token runs across the border of a turn's text. Roles and texts
are escaped: a backslash goes behind the first character of everything that is a mark, or a mark with
backslashes there, so escaping is reversible and no text holds a mark. The rendering is encoded once, with
offsets; sorted spans of the texts under loss are intersected with the token spans by binary search.

Conversations are shuffled by id, sorted by turn and rendered one at a time, so a task holds one
conversation, which becomes one row of the result.

Defined results: null texts and roles are empty; null ids form one conversation, null turns come
first, and rows equal in id and turn are ordered by role and text and all kept; an empty text under loss has no tokens;
an empty table gives no conversations. Other columns are not used.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import mapped

MARKS = ("<s>", "</s>", "[INST]", "[/INST]")
#: Control strings of the vocabulary and of the template, without their first character.
_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|\|endoftext\|>)")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|\|endoftext\|>)")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escaped(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


class Rendered(NamedTuple):
    text: str
    spans: list[tuple[int, int]]


def rendered(turns: Iterable[tuple[str, str]], under_loss: str = "assistant") -> Rendered:
    """The whole conversation, and where the texts of the role ``under_loss`` lie in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>[INST]{escaped(role)}[/INST]", escaped(text)
        if role == under_loss:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</s>"]
        at += len(head) + len(body) + len("</s>")
    return Rendered("".join(parts), spans)


def turns_of(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from a rendering."""
    return [(unescaped(role), unescaped(body)) for role, body in _TURN.findall(text)]


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer, processors

    out = Tokenizer.from_file(path)
    # offsets with the space that a token starts with
    out.post_processor = processors.ByteLevel(trim_offsets=False)
    out.add_special_tokens([AddedToken(mark, normalized=False, special=True) for mark in MARKS])
    return out


#: What a worker keeps between tasks that format conversations.
KEPT = (_tokenizer,)


def masked(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether each token lies in one of the sorted spans."""
    if not spans:
        return np.zeros(len(starts), bool)
    first, last = np.array(spans, np.int64).T
    at = np.searchsorted(first, starts, "right") - 1
    return (at >= 0) & (starts < ends) & (ends <= last[np.maximum(at, 0)])


def loss_texts(text: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The texts under the mask, unescaped, one per run of masked tokens."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [unescaped(text[starts[a] : ends[b - 1]]) for a, b in edge.reshape(-1, 2).tolist()]


FORMATTED = "conv long, text string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
_NAMES = ("conv", "text", "ids", "starts", "ends", "loss")


def formatted(
    rows: DataFrame, *, vocabulary: str, under_loss: str = "assistant",
    key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """FORMATTED, a row per conversation: its rendering, token ids, token spans and loss mask."""
    order = ["conv", "turn", "role", "text"]
    named = rows.select(
        F.col(f"`{key}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).repartition("conv").sortWithinPartitions(*order)

    def row(conv: int | None, turns: list[tuple[str, str]]) -> pa.RecordBatch:
        whole = rendered(turns, under_loss)
        found = _tokenizer(vocabulary).encode(whole.text, add_special_tokens=False)
        starts, ends = np.array(found.offsets, np.int64).reshape(-1, 2).T
        numbers = pa.list_(pa.int32())
        kinds = (pa.int64(), pa.string(), numbers, numbers, numbers, pa.list_(pa.bool_()))
        values = (conv, whole.text, found.ids, starts.tolist(), ends.tolist(), masked(starts, ends, whole.spans).tolist())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], list(_NAMES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, turns, done = None, [], []
        for batch in batches:
            conv, roles, texts = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for c, r, t in zip(conv, roles, texts, strict=True):
                if turns and c != now:
                    done.append(row(now, turns))
                    turns = []
                    if sum(d.nbytes for d in done) > 1 << 22 or len(done) >= 500:
                        yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                        done = []
                now = c
                turns.append((r, t))
        if turns:
            done.append(row(now, turns))
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]

    return mapped(named, run, FORMATTED, vocabulary=True)
