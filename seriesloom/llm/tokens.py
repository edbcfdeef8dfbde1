"""Token ids of whole texts, by the tokenizers library and a public vocabulary file.

Byte-level BPE cuts a text by a pattern whose matches never run from a visible character into white
space. A text may therefore be cut before any white space that follows a visible character, and the
ids of the parts put together. Parts recur, so each worker keeps the ids of the first CACHE distinct
ones; the rest are encoded in one call per batch and told apart by the byte length of each id. Strings of special
tokens inside a text become these tokens, as the library does by default.
"""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct text parts whose ids a worker keeps.
CACHE = 800_000
#: Parts that are encoded side by side, as one text.
JOINT = 50

# White space of the vocabulary's pattern, listed because Python's own class is wider.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PARTS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_MARKED = re.compile(r"[A-Za-z][,.;:!?]\Z")
_RARE = re.compile(r"[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _rare(text: str) -> bool:
    """Whether the text has white space other than spaces and line ends."""
    if text.isascii():
        return "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text
    return _RARE.search(text) is not None


def spaced(text: str) -> str | None:
    """The text such that its parts lie between spaces, or none where that takes the pattern.

    Put together again, the parts are the text. A part that starts with a single space is given without it and
    one that starts with a line end as it is, so that usual texts need no pattern. Any other part, as the first,
    is given after a tab.
    """
    if _rare(text):
        return None
    out = text.replace("\n", " \n")
    # neither a part that is empty nor one that is a line end alone
    if "  " in out or "\n " in out or out[0] == " " or out[-1] in " \n":
        return None
    return "\t" + out


class Encoder:
    """Encodes batches of texts; one per worker and vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width = np.zeros(size, np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.width[number] = len(token)
        special = "".join(one.content for one in self.tokenizer.get_added_tokens_decoder().values())
        self.marks = "".join(mark for mark in ",.;:!?" if mark not in special)
        self.known: dict[str, bytes] = {}

    def _fresh(self, parts: list[str]) -> dict[str, bytes]:
        # parts that start with white space and end visibly can stand side by side
        joint = [part for part in parts if part[0] != "\t"]
        alone = [part for part in parts if part[0] == "\t"]
        found = self.tokenizer.encode_batch_fast([part[1:] for part in alone], add_special_tokens=False)
        out = {part: np.array(one.ids, "<u4").tobytes() for part, one in zip(alone, found, strict=True)}
        if not joint:
            return out
        raw = [part if part[0] == "\n" else " " + part for part in joint]
        texts = ["".join(raw[i : i + JOINT]) for i in range(0, len(raw), JOINT)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(one.ids, "<u4") for one in found])
        reached = np.cumsum(self.width[ids])
        ends = np.cumsum([len(part) if part.isascii() else len(part.encode()) for part in raw])
        cuts = np.searchsorted(reached, ends) + 1
        if not np.array_equal(reached[cuts - 1], ends):
            raise ValueError("a token crosses the border of two text parts")
        data = ids.tobytes()
        stops = (cuts * 4).tolist()
        out.update((part, data[a:b]) for part, a, b in zip(joint, [0, *stops], stops, strict=False))
        return out

    def _found(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of parts that are not known."""
        marked = {part for part in parts if part[-1] in self.marks and _MARKED.search(part)}
        known = self.known
        stems = {part[:-1] for part in marked}
        fresh = (parts - marked) | {part for part in stems if part not in known}
        fresh |= {mark for part in marked if (mark := "\t" + part[-1]) not in known}
        out = self._fresh(list(fresh))
        for part in marked:
            stem, mark = part[:-1], "\t" + part[-1]
            out[part] = (out.get(stem) or known[stem]) + (out.get(mark) or known[mark])
        return out

    def _ids(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts."""
        known = self.known
        ids = list(map(known.get, parts))
        holes = [i for i, one in enumerate(ids) if one is None]
        if holes:
            extra = self._found({parts[i] for i in holes})
            for i in holes:
                ids[i] = extra[parts[i]]
            known.update(itertools.islice(extra.items(), max(CACHE - len(known), 0)))
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null and empty give none."""
        plain, odd, parts, sizes = [], [], [], []
        usual: list[str] = []
        for i, text in enumerate(texts):
            if not text:
                continue
            cut = spaced(text)
            if cut is not None:
                plain.append(i)
                usual.append(cut)
            else:
                found = ["\t" + part for part in _PARTS.findall(text)]
                odd.append(i)
                parts += found
                sizes.append(len(found))
        split = pc.split_pattern(pa.array(usual, pa.large_string()), " ")
        every = pa.concat_arrays([split.flatten(), pa.array(parts, pa.large_string())]).dictionary_encode()
        ids = pa.array(self._ids(every.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(every.indices)
        ends = np.cumsum(np.concatenate((pc.list_value_length(split).to_numpy(), np.array(sizes, np.int64))))
        data = ids.buffers()[2].to_pybytes() if len(ids) else b""
        stops = np.frombuffer(ids.buffers()[1], np.int64)[ends].tolist() if len(ids) else []
        out = [b""] * len(texts)
        for i, a, b in zip(plain + odd, [0, *stops], stops, strict=False):
            out[i] = data[a:b]
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


#: What a worker keeps between tasks that encode texts.
KEPT = (encoder,)
