"""Byte-level BPE by corpus-level merge replay.

A task gathers the distinct words of its texts and replays the merges over all of them together: an
inverted index leads from a mergeable token pair to the places where it stands, the merges are taken
in rank order, and each one touches only its places and their neighbours. Which words there are
differs between tasks, their ids do not, so any partitioning gives the same result.

Defined results: null text is encoded as empty text; an empty text has no ids; null ids decode to
null; an id outside the ranks raises. Every text is encoded whole, however long. Other columns pass
through; a column that has the output's name is replaced. Repeated rows stay repeated.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trueledger.llm import chunks
from trueledger.llm.common import add_column, texts_of


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a ``.tiktoken`` file; its size is that of the vocabulary."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class MergeReplay:
    """Encodes lists of words against fixed ranks."""

    #: Stands where a word ends, and where a merged token has left its place.
    NONE = (1 << 20) - 1

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)])
        merges = sorted(
            ((ranks[token[:cut]] << 20) + ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        )
        self.pairs = np.array([*(pair for pair, _ in merges), 1 << 62])
        self.merged = np.array([*(rank for _, rank in merges), -1])

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair merges into, -1 where there is none."""
        pair = (left << 20) + right
        at = self.pairs.searchsorted(pair)
        return np.where(self.pairs[at] == pair, self.merged[at], -1)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit bytes."""
        whole = [self.ranks.get(w) for w in words]
        replayed = iter(self._replay([w for w, rank in zip(words, whole, strict=True) if rank is None and w]))
        return [rank.to_bytes(4, "little") if rank is not None else next(replayed) if w else b"" for w, rank in zip(words, whole, strict=True)]

    def _replay(self, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        # A token stands at the place of its first byte; each word ends in a place of its own.
        word_of_byte = np.repeat(np.arange(len(words)), sizes)
        n = len(word_of_byte) + len(words)
        ids = np.full(n, self.NONE)
        ids[np.arange(len(word_of_byte)) + word_of_byte] = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        places: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def index(found: np.ndarray, at: np.ndarray) -> None:
            """Adds to the places of each rank in ``found``."""
            order = found.argsort(kind="stable")
            found, at = found[order], at[order]
            cuts = [0, *(np.flatnonzero(found[1:] != found[:-1]) + 1).tolist(), len(found)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                rank = int(found[a])
                if rank in places:
                    places[rank].append(at[a:b])
                else:
                    places[rank] = [at[a:b]]
                    heapq.heappush(queue, rank)

        first = self.pair_ranks(ids[:-1], ids[1:])
        can = np.flatnonzero(first >= 0)
        if len(can):
            index(first[can], can)
        while queue:
            rank = heapq.heappop(queue)
            at = np.unique(np.concatenate(places.pop(rank)))
            right = after[at]
            valid = self.pair_ranks(ids[at], ids[right]) == rank
            at, right = at[valid], right[valid]
            if (at[1:] == right[:-1]).any():  # overlapping places: the left one of two goes first
                taken, free = [], -1
                for i, (a, r) in enumerate(zip(at.tolist(), right.tolist(), strict=True)):
                    if a != free:
                        taken.append(i)
                        free = r
                at, right = at[taken], right[taken]
            if not len(at):
                continue
            ids[at], ids[right] = rank, self.NONE
            follow = after[right]
            after[at], before[follow] = follow, at
            lead = before[at]
            new = np.concatenate([self.pair_ranks(ids[lead], ids[at]), self.pair_ranks(ids[at], ids[follow])])
            can = np.flatnonzero(new >= 0)
            if len(can):
                index(new[can], np.concatenate([lead, at])[can])
        stays = ids != self.NONE
        ends = np.cumsum(stays)[np.cumsum(sizes) + np.arange(len(words)) - 1 + 0].tolist()
        packed = ids[stays].astype("<u4").tobytes()
        return [packed[4 * a : 4 * b] for a, b in zip([0, *ends], ends, strict=False)]


#: The encoder of this Python worker, kept from task to task.
_ENCODER: dict[tuple[int, str], chunks.ChunkIds] = {}


def _encoder(ranks: dict[bytes, int], pattern: str) -> chunks.ChunkIds:
    key = (hash(frozenset(ranks.items())), pattern)
    if key not in _ENCODER:
        _ENCODER.clear()
        _ENCODER[key] = chunks.ChunkIds(chunks.WordIds(pattern, MergeReplay(ranks).encode))
    return _ENCODER[key]


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out array<int>``: the ids of column ``text``, each match of ``pattern`` by itself."""

    def make():
        ids_of = _encoder(ranks, pattern)

        def batch(column: pa.Array) -> pa.Array:
            offsets, ids = chunks.as_ids(ids_of(texts_of(column)))
            return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))

        return batch

    return add_column(df, text, out, "array<int>", make)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out binary``: the bytes of the tokens in column ``ids``."""

    def make():
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        known = np.zeros(size, bool)
        known[list(ranks.values())] = True
        lengths = np.array([len(t) for t in tokens], np.int64)
        starts = np.cumsum(lengths) - lengths
        blob = np.frombuffer(b"".join(tokens), np.uint8)

        def one(values: np.ndarray) -> bytes:
            if not len(values):
                return b""
            if values.min() < 0 or values.max() >= size or not known[values].all():
                raise ValueError("an id is outside the ranks")
            n = lengths[values]
            ends = np.cumsum(n)
            return blob[np.repeat(starts[values] - (ends - n), n) + np.arange(ends[-1])].tobytes()

        def batch(column: pa.Array) -> pa.Array:
            flat = column.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(column.offsets.to_numpy()) if column.null_count == 0 else np.array([len(x) if x.is_valid else 0 for x in column])
            ends = np.cumsum(sizes)
            texts = [one(flat[e - s : e]) for s, e in zip(sizes, ends, strict=True)]
            return pa.array([t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist(), strict=True)], pa.binary())

        return batch

    return add_column(df, ids, out, "binary", make)
