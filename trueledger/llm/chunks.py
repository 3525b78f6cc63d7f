"""Splitting text at single spaces into chunks whose token ids do not depend on their neighbours.

The word pattern of byte-level BPE lets a word take one space before it, and leaves the last white
space of a run to the word after it. So a space before anything but white space or the text's end always
starts a new match: text may be cut there, each chunk encoded by itself and the ids joined. Chunks repeat far
more often than texts do, so each distinct chunk of a task is encoded once.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable

import numpy as np
import regex

#: Distinct chunks a task remembers, half of them since the memory was last turned over (some 100 MB).
REMEMBERED = 800_000

#: Characters whose chunks are looked up together.
BLOCK_CHARS = 1_500_000

#: Tells quickly that there is nothing to look out for; it takes more for white space than the pattern does.
_RUN = re.compile(r" (?:\s|$)")
_CUT = regex.compile(r" (?=\S)")


def _keys(text: str) -> list[str]:
    """The chunks of ``text`` without the spaces they were cut at; the first one behind a space."""
    parts = _CUT.split(text) if _RUN.search(text) else text.split(" ")
    parts[0] = " " + parts[0]
    return parts


def chunks(text: str) -> list[str]:
    """Pieces that join to ``text``; all but the first begin with the space they were cut at."""
    first, *others = _keys(text)
    return [first[1:], *(" " + p for p in others)]


class Known(dict):
    """Ids by text. A text that only ``older`` knows is taken over; one that neither knows gets a place to be filled."""

    def __init__(self, older: dict[str, bytes]):
        self.older, self.asked = older, {}

    def __missing__(self, text: str) -> bytes | bytearray:
        found = self.older.get(text)
        if found is None:
            found = self.asked[text] = bytearray()
        self[text] = found
        return found


class Memory:
    """Ids by text, in two halves: when the newer is full it becomes the older, whose texts are taken over
    as they are met. So what is met often stays, and what is met once goes."""

    def __init__(self, size: int, encode: Callable[[list[str]], list[bytes]]):
        self.half, self.encode = size // 2, encode
        self.known = Known({})

    def joined(self, texts: list[list[str]]) -> list[bytes]:
        """For each list of texts their ids, one after the other; those not known are encoded together."""
        if len(self.known) > self.half:
            self.known.older = {}
            self.known = Known(self.known)
        known = self.known
        get = known.__getitem__
        found = [list(map(get, some)) for some in texts]
        if known.asked:
            new = list(known.asked)
            self.known = Known({})  # should encoding fail, no place is left that was not filled
            for text, ids in zip(new, self.encode(new), strict=True):
                known.asked[text][:] = ids
                known[text] = ids
            self.known, known.asked = known, {}
        return [b"".join(ids) for ids in found]


class WordIds:
    """Ids of chunks, each match of the word pattern by itself; remembers words."""

    #: Distinct words that are remembered (some 100 MB).
    REMEMBERED = 800_000

    def __init__(self, pattern: str, encode: Callable[[list[bytes]], list[bytes]]):
        self.find = regex.compile(pattern).findall
        # Where the pattern takes letters as they come, most chunks are one word; telling so is cheap.
        before, _, _ = pattern.partition(r" ?\p{L}+|")
        self.letters = before != pattern and all(p[:1] == "'" for p in before.split("|") if p)
        self.memory = Memory(self.REMEMBERED, lambda words: encode([w.encode() for w in words]))

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.letters:
            return self.memory.joined(list(map(self.find, texts)))
        return self.memory.joined([[t] if (t[1:] if t[:1] == " " else t).isalpha() else self.find(t) for t in texts])


class ChunkIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, by chunks.

    A chunk is remembered without the space it was cut at; the first of a text, which has none, with
    one more. No other chunk begins with a space, so the two cannot be taken for each other.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.memory = Memory(REMEMBERED, lambda keys: encode([k[1:] if k[:1] == " " else " " + k for k in keys]))

    def __call__(self, texts: list[str]) -> list[bytes]:
        # Lists of chunks come and go by the thousand and hold no cycles; looking for some takes a fifth of the time.
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._ids(texts)
        finally:
            if collects:
                gc.enable()

    def _ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        block: list[list[str]] = []
        size = 0
        for text in texts:
            block.append(_keys(text))
            size += len(text)
            if size >= BLOCK_CHARS:
                out += self.memory.joined(block)
                block, size = [], 0
        return out + self.memory.joined(block)


def as_ids(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and all ids of a batch of texts."""
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(b) // 4 for b in raw], out=offsets[1:])
    return offsets, np.frombuffer(b"".join(raw), "<u4")
