"""Byte-level BPE by dynamic programming over prefixes.

The ids of a word are found without replaying merges. Every prefix of a word has one last token in its
encoding: the token that ends there, leaves a prefix that is encoded itself, and is compatible with that
prefix's last token. An automaton over all tokens reports, for every prefix, the tokens that are its
suffixes; the compatible one is stored (the last byte, if no longer token is), and the ids are read off by
following the stored tokens back from the end of the word.

Two tokens are compatible if merging their joint bytes gives the two of them again, that is, if no merge
ever joins the right edge of the first to the left edge of the second. Both edges are followed back from
the whole tokens to single bytes, in the order in which their merges were made.

Added tokens of the tokenizer (such as an end-of-text mark) are found in the text first, the leftmost
and of those the longest, unless ``plain_specials``; each is one id and cuts the text.

Defined results: null text is encoded as empty text; an empty text has no ids; null ids decode to null;
ids outside the vocabulary are left out, bytes that are no UTF-8 become U+FFFD, both as the tokenizers
library does. Every text is encoded whole, however long. Other columns pass through; a column that has
the output's name is replaced. Repeated rows stay repeated, empty tables give empty tables.
"""

from __future__ import annotations

import json
from array import array
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from trueledger.llm import chunks
from trueledger.llm.common import add_column, texts_of

#: Stands between words where many are read by the automaton together; no byte has this code.
_BETWEEN = "Ā"

#: Token pairs whose compatibility a task remembers.
REMEMBERED_PAIRS = 500_000


@dataclass(frozen=True)
class Vocabulary:
    """Tokens of a byte-level BPE tokenizer, in bytes, its merges in rank order, and its added tokens."""

    tokens: dict[int, bytes]
    merges: list[tuple[int, int, int]]
    added: dict[str, int] = field(default_factory=dict)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the tokenizer's file: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str) -> Vocabulary:
    """Of a tokenizers JSON file; raises for options that this operator does not have."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, kind = file["model"], file.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += [k for k in ("normalizer", "post_processor") if file.get(k)]
    odd += [k for token in file["added_tokens"] for k in ("single_word", "lstrip", "rstrip") if token[k]]
    if odd or model["type"] != "BPE" or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space"):
        raise ValueError(f"not a plain byte-level BPE tokenizer: {odd or kind}")
    letters = _byte_letters()
    added = {token["content"]: token["id"] for token in file["added_tokens"]}
    tokens = {i: bytes(letters[c] for c in text) for text, i in model["vocab"].items() if text not in added}
    ids = {text: i for i, text in tokens.items()}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    sides = [[ids[bytes(letters[c] for c in side)] for side in pair] for pair in pairs]
    return Vocabulary(tokens, [(a, b, ids[tokens[a] + tokens[b]]) for a, b in sides], added)


class PrefixEncoder:
    """Encodes lists of words; each token but the bytes is made by one merge of the vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        tokens = vocabulary.tokens
        n = max(tokens) + 1
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(vocabulary.merges)}
        #: When a token comes to be, and of what; bytes are there from the start.
        self.born, self.left, self.right = [-1] * n, [-1] * n, [-1] * n
        for r, (a, b, made) in enumerate(vocabulary.merges):
            if self.born[made] >= 0 or max(self.born[a], self.born[b]) >= r:
                raise ValueError("a token is made twice, or before its parts")
            self.born[made], self.left[made], self.right[made] = r, a, b
        self.size = [len(tokens.get(i, b"")) for i in range(n)]
        self.ids = {text: i for i, text in tokens.items()}
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError("the vocabulary lacks a byte")
        self.byte = {chr(b): self.ids[bytes([b])] for b in range(256)}
        #: For each token, the tokens before it that were tested, and how many tests are remembered.
        self.tested: list[dict[int, bool]] = [{} for _ in range(n)]
        self.tests = 0
        self.automaton = ahocorasick.Automaton()
        for i, text in tokens.items():
            # A token that merging its own bytes does not give is never the last token of a prefix.
            if self.born[i] >= 0 and self.compatible(self.left[i], self.right[i], self.born[i]):
                self.automaton.add_word(text.decode("latin-1"), i)
        self.automaton.make_automaton()

    def compatible(self, a: int, b: int, until: int | None = None) -> bool:
        """Whether the bytes of ``a`` and ``b`` stay two tokens, up to the merge ``until`` if given.

        Each edge token lives from its own merge to the merge that swallows it. A merge across the border
        happens if it comes while both sides live; of equal merges the one further left comes first.
        """
        rank, born = self.rank, self.born
        end_a = end_b = len(rank) if until is None else until
        while True:
            across = rank.get((a, b))
            if across is not None and across < end_a and across <= end_b and across != until:
                return False
            if born[a] > born[b]:
                end_a, a = born[a], self.right[a]
            elif born[b] >= 0:
                end_b, b = born[b], self.left[b]
            else:
                return True

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit bytes."""
        if not words:
            return []
        size, byte, tested = self.size, self.byte, self.tested
        joined = _BETWEEN.join([w.decode("latin-1") for w in words])
        # last[p]: the last token of the prefix that ends with place p, -2 before a word. Where no token of
        # the automaton is it, which it reports in order of their ends, -1 stands for the byte itself.
        last = [-1] * (len(joined) + 1)
        starts, at = [], 0
        for word in words:
            starts.append(at)
            last[at - 1] = -2  # of the first word, the place behind the last one
            at += len(word) + 1
        for end, token in self.automaton.iter(joined):
            if last[end] == -1:
                place = end - size[token]
                before = last[place]
                if before == -2:
                    last[end] = token
                    continue
                if before == -1:
                    before = last[place] = byte[joined[place]]
                fits = tested[token].get(before)
                if fits is None:
                    fits = self._test(before, token)
                if fits:
                    last[end] = token
        out = []
        for word, start in zip(words, starts, strict=True):
            found, end = [], start + len(word) - 1
            while end >= start:
                token = last[end]
                if token < 0:
                    token = byte[joined[end]]
                found.append(token)
                end -= size[token]
            found.reverse()
            out.append(array("I", found).tobytes())
        return out

    def _test(self, before: int, token: int) -> bool:
        if self.tests >= REMEMBERED_PAIRS:
            self.tests = 0
            for some in self.tested:
                some.clear()
        self.tests += 1
        self.tested[token][before] = fits = self.compatible(before, token)
        return fits


class TextEncoder:
    """Ids of texts: added tokens first, then each match of the word pattern by itself."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, plain_specials: bool):
        self.ids_of = chunks.ChunkIds(chunks.WordIds(pattern, PrefixEncoder(vocabulary).encode))
        self.added = {} if plain_specials else {k: v.to_bytes(4, "little") for k, v in vocabulary.added.items() if k}
        by_length = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")").split if by_length else None

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.cut is None or not any(mark in text for text in texts for mark in self.added):
            return self.ids_of(texts)
        parts = [self.cut(text) for text in texts]  # odd places hold added tokens
        ids = iter(self.ids_of([part for some in parts for part in some[::2]]))
        return [b"".join(self.added[part] if i % 2 else next(ids) for i, part in enumerate(some)) for some in parts]


#: The encoder of this Python worker, kept from task to task.
_ENCODER: dict[tuple[str, str, bool], TextEncoder] = {}


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids", plain_specials: bool = False) -> DataFrame:
    """``df`` with ``out array<int>``: the ids of column ``text`` by the tokenizer in the JSON file ``path``.

    The file is read by each Python worker, so it lies at the same place on every machine. ``pattern`` is
    one after which a space that no white space follows always starts a new match (see ``chunks``).
    """
    read_vocabulary(path)  # a file that cannot be used raises here

    def make():
        key = (path, pattern, plain_specials)
        if key not in _ENCODER:
            _ENCODER.clear()
            _ENCODER[key] = TextEncoder(read_vocabulary(path), pattern, plain_specials)
        ids_of = _ENCODER[key]

        def batch(column: pa.Array) -> pa.Array:
            offsets, ids = chunks.as_ids(ids_of(texts_of(column)))
            return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))

        return batch

    return add_column(df, text, out, "array<int>", make)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out string``: the text of the ids in column ``ids``, added tokens included."""

    def make():
        vocabulary = read_vocabulary(path)
        tokens = vocabulary.tokens | {i: content.encode() for content, i in vocabulary.added.items()}
        known = [tokens.get(i, b"") for i in range(max(tokens) + 1)]

        def one(value: pa.ListScalar) -> str | None:
            if not value.is_valid:
                return None
            codes = value.values.to_numpy(zero_copy_only=False)
            inside = codes[(codes >= 0) & (codes < len(known))].astype(np.int64).tolist()
            return b"".join(map(known.__getitem__, inside)).decode("utf-8", "replace")

        return lambda column: pa.array(map(one, column), pa.string())

    return add_column(df, ids, out, "string", make)
