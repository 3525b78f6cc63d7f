"""Byte-level BPE against the tiktoken library, and packing against its definition."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from llm.conftest import odd_documents
from tokenizers import Tokenizer

from trueledger.llm import byte_bpe, chunks, packing

RANKS = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_chunks_join_to_the_text_and_stand_alone():
    rng = random.Random(5)
    for _ in range(3_000):
        text = "".join(rng.choice("ab 's\n\t  \x1c\x85é1²…") for _ in range(rng.randint(0, 14)))
        parts = chunks.chunks(text)
        assert "".join(parts) == text
        assert [i for p in parts for i in LIBRARY.encode_ordinary(p)] == LIBRARY.encode_ordinary(text)


def test_replay_equals_the_library():
    rng = random.Random(6)
    replay = byte_bpe.MergeReplay(RANKS)
    words = ["".join(rng.choice("aaabhotnig éñ日") for _ in range(rng.randint(1, 24))) for _ in range(1_500)] + ["a" * n for n in range(1, 40)]
    want = [LIBRARY._encode_single_piece(w) for w in words]
    assert [np.frombuffer(x, "<u4").tolist() for x in replay.encode([w.encode() for w in words])] == want


def test_round_trip_and_odd_rows(spark):
    df = odd_documents(spark)
    coded = byte_bpe.encode(df, RANKS, P.PATTERN)
    assert coded.columns == ["doc_id", "text", "key", "ids"]
    for row in byte_bpe.decode(coded, RANKS).collect():
        assert row.ids == LIBRARY.encode_ordinary(row.text or "")
        assert bytes(row.decoded).decode() == (row.text or "")
    assert byte_bpe.encode(df.limit(0), RANKS, P.PATTERN).count() == 0
    with pytest.raises(Exception, match="outside the ranks"):
        byte_bpe.decode(spark.createDataFrame([([60_000],)], "ids array<int>"), RANKS).collect()
    missing = byte_bpe.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), RANKS).collect()
    assert [r.decoded if r.decoded is None else bytes(r.decoded) for r in missing] == [None, b""]


def pieces(df, capacity):
    return packing.token_pieces(df, P.path("byte_bpe_50k.json"), P.PATTERN, capacity)


@pytest.mark.parametrize("partition_pieces", [40_000, 30])
def test_packing_is_gapless_whole_and_close_to_the_bound(spark, docs, partition_pieces):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    want = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.select("doc_id", "text").collect()}
    got = packing.pack(packing.with_crc32(pieces(docs, 2048)), 2048, partition_pieces).collect()
    sequences, parts = defaultdict(list), defaultdict(list)
    for r in got:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32 and len(ids) == r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id].append((r.piece, r.start, r.length))
    for doc, ids in want.items():
        cut = sorted(parts[doc])
        assert [p for p, _, _ in cut] == list(range(len(cut))) and sum(n for _, _, n in cut) == len(ids)
        assert all(n == 2048 for _, _, n in cut[1:]) and len(cut) == -(-len(ids) // 2048)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    bound = packing.lower_bound(np.array([r.length for r in got]), 2048)
    assert bound <= len(sequences) <= bound * 1.03 + 1


def test_bounds_and_best_fit():
    rng = np.random.default_rng(2)
    for _ in range(200):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        bins, offsets = packing.best_fit_decreasing(lengths, 100)
        used = np.bincount(bins, weights=lengths)
        assert used.max() <= 100 and packing.lower_bound(lengths, 100) <= len(used)
        for b in range(len(used)):
            inside = sorted(zip(offsets[bins == b], lengths[bins == b]))
            assert [o for o, _ in inside] == np.cumsum([0, *(n for _, n in inside)]).tolist()[:-1]
    assert packing.lower_bound(np.array([51] * 7), 100) == 7
    assert packing.lower_bound(np.array([60, 60, 40, 40]), 100) == 2


def test_packing_odd_rows(spark):
    df = odd_documents(spark)
    got = packing.pack(pieces(df, 64), 64)
    assert got.where("piece = 0").count() == df.count()
    assert packing.pack(pieces(df.limit(0), 64), 64).count() == 0
