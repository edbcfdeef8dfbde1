"""Tokens of two vocabularies lined up on the bytes of a text.

A byte-level BPE (A) and a piece vocabulary with byte fallback (B) both encode a space and the text. Byte offsets
where tokens of both end cut the tokens into groups; every A token of a group is linked with every B token of it.
For each pair of ids the corpus-wide count is the number of documents that hold it linked.

**Fragments.** A byte range of a text has its own tokens of A and of B. As a fragment they are an open prefix (tokens
up to the first offset where both end), closed groups, and an open suffix. Two neighbouring fragments compose: the
suffix of one and the prefix of the next give a fragment of their own, whose groups lie between the closed ones of
both. Composition is associative, so a text longer than ``chunk`` characters is cut into ranges that are encoded in
different tasks and composed as a tree of ``FAN`` fragments a step. Each vocabulary is cut where no token of
it can cross: A before white space that follows a visible character or where ASCII letters end, B before a
space or line end after a visible character. The ranges of A and B therefore differ and fragments do have open ends.

**Counts.** Words recur, and both vocabularies may be cut before them, so a worker aligns each distinct one once; a
document becomes numbers of a dictionary that its *block* (documents up to ``block`` bytes of one task) shares. A block
asks for its distinct pairs only, not for those of each document: pairs are summed across blocks, joined with the
best count of their A id, and the answers meet the block's documents again. Per document two sums are left.

Defined results: a null or empty text, and one whose tokens do not spell its bytes (the piece vocabulary writes U+2581
for a space), has no tokens; strings of special tokens inside a text are plain text; repeated rows are documents of
their own and count as such, null keys too; an empty table gives no rows. Other columns are not read, so they may
have any name. A very long text is cut as above; only its list of groups, from which the digest is taken, is put
together in one row, as the text was. A stretch without any place to cut is encoded whole.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batches_of, mapped, release, ship, stored
from .text import ranges, slices

#: Fragments composed in one step of the tree.
FAN = 16
#: Memory for aligned words that a worker keeps, by estimate.
CACHE_BYTES = 80 << 20
#: Bytes of an Arrow batch of texts, and of a row group of blocks, which tasks hold whole.
BATCH_BYTES, ROW_GROUP_BYTES = 4 << 20, 16 << 20

# a word with the white space before it; cut only before a space or line end that follows a visible character
_WORDS = re.compile(r"\s*\S+(?:[^\S \n]\s*(?:\S+|\Z))*|\s+")
_CUT_B = re.compile(r"(?<=\S)(?=[ \n])")
_CUT_A = re.compile(r"(?<=\S)(?=[ \n])|(?<=[A-Za-z])(?=[\x00-@\[-`{-\x7f])")

class Tokens(NamedTuple):
    """Ids of consecutive tokens and the byte offsets where they end."""

    ids: np.ndarray
    ends: np.ndarray

    def __getitem__(self, part: slice) -> Tokens:
        return Tokens(self.ids[part], self.ends[part])

    def and_then(self, other: Tokens) -> Tokens:
        return Tokens(np.concatenate([self.ids, other.ids]), np.concatenate([self.ends, other.ends]))

    def up_to(self, end: int) -> int:
        """How many tokens end by an offset."""
        return int(np.searchsorted(self.ends, end, "right"))


class Fragment(NamedTuple):
    """Tokens of a byte range. Not ``cut``: no common end, all tokens are in the head."""

    cut: bool
    head: tuple[Tokens, Tokens]
    closed: list[str]
    tail: tuple[Tokens, Tokens]


_NO_TOKENS = Tokens(np.empty(0, np.int64), np.empty(0, np.int64))


@functools.lru_cache(maxsize=1)
def _written(size: int) -> list[np.ndarray]:
    """Texts of all ids below ``size``, each before a comma, a bar, a semicolon and a line end."""
    texts = [str(i) for i in range(size)]
    return [np.array([t + mark for t in texts], object) for mark in ",|;\n"]


def group_texts(a: Tokens, b: Tokens, common: np.ndarray, lasts: np.ndarray) -> list[str]:
    """Groups as text, cut into lists after the common ends ``lasts``; both end with the last common end."""
    if not len(common):
        return []
    size = 1 << int(max(a.ids.max(), b.ids.max(), 1)).bit_length()
    comma, bar, semicolon, line = _written(max(size, 1 << 16))
    of_a, of_b = np.searchsorted(common, a.ends), np.searchsorted(common, b.ends)
    n_a, n_b = np.bincount(of_a, minlength=len(common)), np.bincount(of_b, minlength=len(common))
    out = np.empty(len(a.ids) + len(b.ids), object)
    out[np.arange(len(a.ids)) + (np.cumsum(n_b) - n_b)[of_a]] = np.where(
        a.ends == common[of_a], bar[a.ids], comma[a.ids]
    )
    closes, ends_list = b.ends == common[of_b], np.isin(b.ends, lasts)
    out[np.arange(len(b.ids)) + np.cumsum(n_a)[of_b]] = np.where(
        ends_list, line[b.ids], np.where(closes, semicolon[b.ids], comma[b.ids])
    )
    return "".join(out.tolist()).removesuffix("\n").split("\n")


def fragment(a: Tokens, b: Tokens) -> Fragment:
    """The fragment of a range's tokens, in order."""
    common = np.intersect1d(a.ends, b.ends, assume_unique=True)
    if not len(common):
        return Fragment(False, (a, b), [], (_NO_TOKENS, _NO_TOKENS))
    first, last = [(t.up_to(common[0]), t.up_to(common[-1])) for t in (a, b)]
    closed = group_texts(a[first[0] : first[1]], b[last[0] : last[1]], common[1:], common[-1:])
    return Fragment(True, (a[: first[0]], b[: last[0]]), closed, (a[first[1] :], b[last[1] :]))


def _one_group(a: Tokens, b: Tokens) -> str:
    return "|".join(",".join(map(str, t.ids.tolist())) for t in (a, b))


def composed(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    left = x.tail if x.cut else x.head
    joint = fragment(left[0].and_then(y.head[0]), left[1].and_then(y.head[1]))
    if not x.cut and not y.cut:
        return joint
    if x.cut and not joint.cut:
        return x._replace(tail=joint.head)
    closed, head = (x.closed + [_one_group(*joint.head)], x.head) if x.cut else ([], joint.head)
    closed = closed + joint.closed
    return Fragment(True, head, closed + y.closed if y.cut else closed, y.tail if y.cut else joint.tail)


def whole(x: Fragment) -> str | None:
    """All groups of a fragment that covers a whole text, as text; None if its ends do not meet."""
    if not x.cut or any(len(t.ids) for t in x.tail):
        return None
    return ";".join([_one_group(*x.head), *x.closed])


def _byte_of() -> dict[str, int]:
    """Characters of a byte-level vocabulary: printable bytes stand for themselves, all others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabularies:
    """Both vocabularies and the words that this worker has aligned."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        byte_of = _byte_of()
        names = self.a.get_vocab()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode()
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\n" in p or re.search("[^▁]▁", p) for p in pieces):
            raise ValueError(f"a piece of {b_path} crosses the start of a word")
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.widths = [np.array([len(t) for t in spelled], np.int64) for spelled in (self.a_bytes, self.b_bytes)]
        self.space = self.b.piece_to_id("▁")
        # aligned words, and those of the time before, of which the ones that come again are kept
        self.known: dict[str, str | None] = {}
        self.older: dict[str, str | None] = {}
        self.held = 0

    def a_tokens(self, text: str, at: int = 0) -> Tokens | None:
        ids = self.a.encode(text, add_special_tokens=False).ids
        return self._placed(ids, self.a_bytes, self.widths[0], text, at)

    def b_tokens(self, text: str, at: int = 0) -> Tokens | None:
        """``text`` starts with a space or a line end; the vocabulary puts a space before what it encodes."""
        if text == " ":
            # an empty text gets no space
            ids = [self.space]
        elif text[0] == " ":
            ids = self.b.encode(text[1:])
        else:
            ids = self.b.encode(text)
            if ids[0] != self.space:
                raise ValueError("a piece reaches beyond the start of a line")
            ids = ids[1:]
        return self._placed(ids, self.b_bytes, self.widths[1], text, at)

    @staticmethod
    def _placed(ids: list[int], spelled: list[bytes], widths: np.ndarray, text: str, at: int) -> Tokens | None:
        """Tokens with their end offsets; None if they do not spell the text."""
        if b"".join([spelled[i] for i in ids]) != text.encode():
            return None
        numbers = np.array(ids, np.int64)
        return Tokens(numbers, at + np.cumsum(widths[numbers]))

    def _aligned(self, words: list[str]) -> list[str | None]:
        """Groups of words that can stand side by side, by encoding them in one go."""
        text = "".join(words)
        a, b = self.a_tokens(text), self.b_tokens(text)
        if a is None or b is None:
            # some word is not spelled
            return [None] if len(words) == 1 else [one for w in words for one in self._aligned([w])]
        ends = np.cumsum([len(w.encode()) for w in words])
        common = np.intersect1d(a.ends, b.ends, assume_unique=True)
        out = group_texts(a, b, common, ends)
        if len(out) != len(words):
            raise ValueError("a token crosses the border of two words")
        return out

    def words(self, texts: list[str]) -> list[list[str | None]]:
        """The groups of the words of each text, given with its leading space; None for a word that is not spelled."""
        cut = [_WORDS.findall(t) for t in texts]
        if self.held > CACHE_BYTES // 2:
            self.older, self.known, self.held = self.known, {}, 0
        known, older = self.known, self.older
        new = {w for words in cut for w in words if w not in known}
        known.update((w, older[w]) for w in new if w in older)
        fresh = [w for w in new if w not in known]
        joint = [w for w in fresh if not w[-1].isspace()]
        found = self._aligned(joint) if joint else []
        known.update(zip(joint, found, strict=True))
        # a word that ends in white space can only stand last
        for w in fresh:
            if w[-1].isspace():
                known[w] = self._aligned([w])[0]
        self.held += sum(200 + len(w) + len(known[w] or "") for w in new)
        return [[known[w] for w in words] for words in cut]

    def range_fragment(self, text: str, at: int, a: tuple[int, int], b: tuple[int, int]) -> Fragment | None:
        """Fragment of a range that starts at byte ``at``; A has the characters ``a`` of it, B those of ``b``."""
        sides = []
        for (start, stop), tokens in ((a, self.a_tokens), (b, self.b_tokens)):
            own = text[start:stop]
            sides.append(tokens(own, at + len(text[:start].encode())) if own else _NO_TOKENS)
        return None if sides[0] is None or sides[1] is None else fragment(sides[0], sides[1])


@functools.lru_cache(maxsize=2)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


#: What a worker keeps between tasks that align texts.
KEPT = (vocabularies,)


def cut_places(text: str, chunk: int, pattern: re.Pattern[str]) -> list[int]:
    """Where ranges start: for each multiple of ``chunk`` the first place from there on, and the end of the text."""
    places = [0]
    for nominal in range(chunk, len(text), chunk):
        found = pattern.search(text, max(nominal, places[-1]))
        places.append(found.start() if found else len(text))
    return [*places, len(text)]


_CHUNKS = "row long, number long, at long, text string, a0 long, a1 long, b0 long, b1 long"
_OPEN = [f"{part}_{side}_{what}" for part in ("head", "tail") for side in "ab" for what in ("ids", "ends")]
_FRAGMENTS = (
    "row long, number long, spelled boolean, cut boolean, "
    + ", ".join(f"{c} array<bigint>" for c in _OPEN)
    + ", closed string"
)
_SUMS = ("n_a", "n_b", "n_groups", "n_links")


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _CHUNKS.split(", ")]
    for batch in batches:
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = " " + text.as_py()
            a, b = cut_places(text, chunk, _CUT_A), cut_places(text, chunk, _CUT_B)
            at, done = 0, 0
            for k in range(len(a) - 1):
                low, high = min(a[k], b[k]), max(a[k + 1], b[k + 1])
                at, done = at + len(text[done:low].encode()), low
                cells = (row, k, at, text[low:high], a[k] - low, a[k + 1] - low, b[k] - low, b[k + 1] - low)
                yield pa.RecordBatch.from_pydict({n: [c] for n, c in zip(names, cells, strict=True)})


def _cells(row: int, number: int, x: Fragment | None) -> dict:
    """A fragment as a row; one that does not spell its text has no tokens."""
    spelled, x = x is not None, x or fragment(_NO_TOKENS, _NO_TOKENS)
    lists = dict(zip(_OPEN, (column for t in (*x.head, *x.tail) for column in t), strict=True))
    return {"row": row, "number": number, "spelled": spelled, "cut": x.cut, **lists, "closed": ";".join(x.closed)}


def _fragment_of(cells: dict) -> Fragment:
    lists = [np.array(cells[name], np.int64) for name in _OPEN]
    a, b, c, d = (Tokens(*lists[k : k + 2]) for k in range(0, 8, 2))
    return Fragment(cells["cut"], (a, b), [cells["closed"]] if cells["closed"] else [], (c, d))


_ARROW_FRAGMENTS = pa.schema(
    [("row", pa.int64()), ("number", pa.int64()), ("spelled", pa.bool_()), ("cut", pa.bool_())]
    + [(c, pa.list_(pa.int64())) for c in _OPEN]
    + [("closed", pa.string())]
)


def _long_texts(rows: DataFrame, a_path: str, b_path: str, chunk: int) -> DataFrame:
    """``row`` and ``groups`` of texts (row, text); null where the tokens do not spell the text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = vocabularies(a_path, b_path)
            for c in batch.to_pylist():
                x = pair.range_fragment(c["text"], c["at"], (c["a0"], c["a1"]), (c["b0"], c["b1"]))
                yield pa.RecordBatch.from_pylist([_cells(c["row"], c["number"], x)], _ARROW_FRAGMENTS)

    def compose(table: pa.Table) -> pa.Table:
        parts = sorted(table.drop_columns(["_up"]).to_pylist(), key=lambda c: c["number"])
        x = None
        if all(c["spelled"] for c in parts):
            x = functools.reduce(composed, map(_fragment_of, parts))
        return pa.Table.from_pylist([_cells(parts[0]["row"], parts[0]["number"] // FAN, x)], _ARROW_FRAGMENTS)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [whole(_fragment_of(c)) if c["spelled"] else None for c in rows]
            columns = [pa.array([c["row"] for c in rows], pa.int64()), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "groups"])

    cut = stored(mapped(rows, lambda batches: _chunks(batches, chunk), _CHUNKS))
    most = cut.agg(F.max("number")).first()[0]
    # chunks of one text go to different tasks
    parts = mapped(cut.repartition("row", "number"), encode, _FRAGMENTS, vocabulary=True)
    while most:
        parts = parts.withColumn("_up", F.floor(F.col("number") / FAN))
        parts = parts.groupBy("row", "_up").applyInArrow(compose, _FRAGMENTS)
        most //= FAN
    return mapped(parts, finish, "row long, groups string")


_BLOCKS = (
    "block long, key long, n_a long, n_b long, n_groups long, n_links long, digest string, words binary, "
    "pairs binary, docs binary, first binary, members binary, times binary"
)
_ARROW_BLOCKS = pa.schema(
    [("block", pa.int64()), ("key", pa.int64())]
    + [(c, pa.int64()) for c in _SUMS]
    + [("digest", pa.string())]
    + [(c, pa.binary()) for c in ("words", "pairs", "docs", "first", "members", "times")]
)


class Links(NamedTuple):
    """Id pairs ``a << 32 | b`` of words: those of word i are first[i]:first[i + 1], each ``times`` over."""

    first: np.ndarray
    pairs: np.ndarray
    times: np.ndarray
    sums: np.ndarray


def _tallied(owner: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, id) in order of the owner, and how often each occurs."""
    key, times = np.unique(owner << 32 | ids, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, times


#: Words whose links are listed at a time, and words of documents whose pairs are counted at a time.
WORDS, COUNTED_WORDS = 20_000, 1 << 15


def links_of(words: list[str]) -> Links:
    """The links of words given as the text of their groups, and their numbers of tokens, groups and links."""
    none = np.empty(0, np.int64)
    parts = [Links(np.zeros(1, np.int64), none, none, np.empty((4, 0), np.int64))]
    for at in range(0, len(words), WORDS):
        part = _links_of(words[at : at + WORDS])
        parts.append(part._replace(first=part.first[1:] + parts[-1].first[-1]))
    first, pairs, times = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return Links(first, pairs, times, np.concatenate([p.sums for p in parts], axis=1))


def _links_of(words: list[str]) -> Links:
    text = ("\n".join(words) + "\n").encode()
    data = np.frombuffer(text, np.uint8)
    marks = data[(data < 48) | (data > 57)]
    ids = np.array(text.translate(_MARKS_TO_SPACE).split(), np.int64)
    closes = (marks == 59) | (marks == 10)
    group = np.cumsum(closes) - closes
    is_b = (np.cumsum(marks == 124) - (marks == 124)) > group
    n_groups = int(group[-1]) + 1
    word_of_group = (np.cumsum(marks == 10) - (marks == 10))[closes]
    side_a, side_b = (_tallied(group[side], ids[side]) for side in (~is_b, is_b))
    # each distinct id of A meets the distinct ids of B of its group
    n_b = np.bincount(side_b[0], minlength=n_groups)
    counts = n_b[side_a[0]]
    partner = ranges((np.cumsum(n_b) - n_b)[side_a[0]], counts)
    a, owner = np.repeat(side_a[1], counts), np.repeat(word_of_group[side_a[0]], counts)
    times = np.repeat(side_a[2], counts) * side_b[2][partner]
    pairs = a << 32 | side_b[1][partner]
    order = np.lexsort((pairs, owner))
    pairs, owner, times = pairs[order], owner[order], times[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    times = np.add.reduceat(times, at)
    word = word_of_group[group]
    n = len(words)
    tokens = [np.bincount(word[side], minlength=n) for side in (~is_b, is_b)]
    linked = np.bincount(owner[at], weights=times, minlength=n).astype(np.int64)
    sums = np.array([*tokens, np.bincount(word_of_group, minlength=n), linked])
    return Links(np.searchsorted(owner[at], np.arange(n + 1)), pairs[at], times, sums)


_MARKS_TO_SPACE = bytes(32 if chr(i) in ",|;\n" else i for i in range(256))


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, each in the fewest bytes that hold the largest; the first byte says how many."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind.newbyteorder("<")).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


class Block:
    """Documents that share a dictionary of words and their pairs."""

    def __init__(self, number: int):
        self.number = number
        self.bytes = 0
        self.index: dict[str, int] = {}
        self.rows: list[tuple[int | None, str, np.ndarray]] = []

    def add(self, key: int | None, words: list[str], size: int) -> None:
        index = self.index
        numbers = np.fromiter([index.setdefault(w, len(index)) for w in words], np.int32, len(words))
        digest = hashlib.sha256(";".join(words).encode()).hexdigest() if words else ""
        self.rows.append((key, digest, numbers))
        self.bytes += size

    def batches(self) -> Iterator[pa.RecordBatch]:
        first, members, times, sums = links_of(list(self.index))
        pairs, members = np.unique(members, return_inverse=True)
        docs = np.zeros(len(pairs), np.int64)
        part = np.cumsum([len(numbers) for _, _, numbers in self.rows]) // COUNTED_WORDS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(self.rows)]
        for at, stop in zip(cuts[:-1], cuts[1:], strict=True):
            rows = self.rows[at:stop]
            held = [np.unique(numbers) for _, _, numbers in rows]
            owner = np.repeat(np.arange(len(held)), [len(h) for h in held])
            words = np.concatenate(held)
            counts = first[words + 1] - first[words]
            seen = np.unique(np.repeat(owner, counts) * len(pairs) + members[ranges(first[words], counts)])
            docs += np.bincount(seen % max(len(pairs), 1), minlength=len(pairs))
            cells = [
                {"block": self.number, "key": key, "digest": digest, "words": packed(numbers)}
                | dict(zip(_SUMS, sums[:, numbers].sum(axis=1).tolist(), strict=True))
                for key, digest, numbers in rows
            ]
            yield pa.RecordBatch.from_pylist(cells, _ARROW_BLOCKS)
        kept = {"pairs": pairs, "docs": docs, "first": first, "members": members, "times": times}
        cells = {name: packed(values) for name, values in kept.items()}
        yield pa.RecordBatch.from_pylist([{"block": self.number, **cells}], _ARROW_BLOCKS)


def _blocks(texts: DataFrame, a_path: str, b_path: str, block: int) -> DataFrame:
    """Documents (key, text or groups) as numbers of their block's words, and each block's dictionary."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        own = Block(number)
        for batch in batches:
            pair = vocabularies(a_path, b_path)
            for part in slices(batch.slice(at, 64) for at in range(0, batch.num_rows, 64)):
                rows = part.to_pylist()
                found = pair.words([" " + r["text"] if r["text"] else "" for r in rows])
                for row, words in zip(rows, found, strict=True):
                    if row["groups"]:
                        own.add(row["key"], row["groups"].split(";"), len(row["groups"]))
                    elif None in words:
                        own.add(row["key"], [], 0)
                    else:
                        own.add(row["key"], words, len(row["text"] or ""))
                    if own.bytes >= block:
                        yield from own.batches()
                        own = Block(own.number + 1)
                        release()
        if own.rows:
            yield from own.batches()

    return mapped(texts, dealt, _BLOCKS, vocabulary=True)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each dictionary with the number of the block's documents that hold them."""
    for batch in batches:
        for block, pairs, docs in zip(*(batch.column(i) for i in range(3)), strict=True):
            pairs, docs = (unpacked(x.as_py()) for x in (pairs, docs))
            for at in range(0, len(pairs), 1 << 16):
                own = pairs[at : at + (1 << 16)]
                columns = [pa.array(np.full(len(own), block.as_py())), pa.array(own), pa.array(docs[at : at + len(own)])]
                yield pa.RecordBatch.from_arrays(columns, ["block", "pair", "docs"])


_RESULT = "key long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _answered(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums over the links of each document of a block."""
    entries = rows.filter(pc.is_valid(rows["pairs"])).to_pylist()
    docs = rows.filter(pc.is_null(rows["pairs"]))
    first, members, times = (unpacked(entries[0][c]) for c in ("first", "members", "times"))
    order = np.argsort(answers["pair"].to_numpy())
    sums = []
    for column in ("best", "count"):
        value = answers[column].to_numpy().astype(np.int64)[order]
        running = np.concatenate([np.zeros(1, np.int64), np.cumsum(value[members] * times)])
        of_word = running[first[1:]] - running[first[:-1]]
        sums.append([int(of_word[unpacked(w.as_py())].sum()) for w in docs["words"]])
    columns = [docs[c] for c in ("key", *_SUMS)] + [pa.array(s, pa.int64()) for s in sums] + [docs["digest"]]
    return pa.Table.from_arrays(columns, names=[c.split()[0] for c in _RESULT.split(", ")])


def aligned(
    docs: DataFrame, *, a: str, b: str, key: str = "doc_id", text: str = "text",
    chunk: int = 1 << 16, block: int = 4 << 20,
) -> DataFrame:
    """Per document its numbers of tokens, groups and links, the sums over its links, and the digest of its groups.

    ``a`` and ``b`` are paths of a byte-level BPE and of a piece model. ``n_best`` counts the links whose pair has
    the highest count of all pairs of its A id, ties included; ``count_sum`` adds up the counts of all links.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    is_long = F.coalesce(F.octet_length("text") > chunk, F.lit(False))
    longer = stored(rows.where(is_long).withColumn("row", F.monotonically_increasing_id()))
    composed_rows = _long_texts(longer.select("row", "text"), a, b, chunk)
    short = rows.where(~is_long).select("key", "text", F.lit(None).cast("string").alias("groups"))
    put = longer.select("row", "key").join(composed_rows, "row")
    put = put.select("key", F.lit(None).cast("string").alias("text"), "groups")
    with batches_of(docs.sparkSession, BATCH_BYTES):
        blocks = stored(_blocks(short.union(put), a, b, block), **{"parquet.block.size": ROW_GROUP_BYTES})

    entries = blocks.where("pairs is not null").select("block", "pairs", "docs")
    asked = mapped(entries, _asked, "block long, pair long, docs long")
    counts = stored(asked.groupBy("pair").agg(F.sum("docs").alias("count")))
    of_a = F.shiftright("pair", 32)
    top = counts.groupBy(of_a.alias("of_a")).agg(F.max("count").alias("top"))
    judged = counts.withColumn("of_a", of_a).join(top, "of_a")
    judged = judged.select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    answers = asked.select("block", "pair").join(judged, "pair")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_answered, _RESULT)
