"""Encoding by prefixes against the tokenizers library, and by replaying merges."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from conftest import rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import odd_documents
from trueledger.llm import chunks, prefix_bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = prefix_bpe.read_vocabulary(PATH)
MARK = "<|endoftext|>"


def library_ids(texts):
    return [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def ids(raw):
    return [np.frombuffer(r, "<u4").tolist() for r in raw]


def by_definition(encoder, word):
    """The merge of the smallest rank, leftmost first, until there is none."""
    found = [encoder.ids[bytes([b])] for b in word]
    while True:
        ranks = [(encoder.rank[p], i) for i, p in enumerate(zip(found, found[1:], strict=False)) if p in encoder.rank]
        if not ranks:
            return found
        r, i = min(ranks)
        found[i : i + 2] = [VOCABULARY.merges[r][2]]


def test_random_words_by_definition():
    draw, encoder = random.Random(5), prefix_bpe.PrefixEncoder(VOCABULARY)
    some = [b"a", b"aa", b"0", b"00", b"e", b"th", b"\xff", b"\xe3\x81", b"  ", b"=", b"==", b"ing", b"er"]
    words = [b"".join(draw.choices(some, k=draw.randint(1, 20))) for _ in range(3_000)] + [b"a" * n for n in range(1, 120)] + [b""]
    assert ids(encoder.encode(words)) == [by_definition(encoder, w) for w in words]


def test_every_token_is_its_own_encoding():
    encoder = prefix_bpe.PrefixEncoder(VOCABULARY)
    assert ids(encoder.encode(list(VOCABULARY.tokens.values()))) == [[i] for i in VOCABULARY.tokens]


def test_texts_and_marks_as_the_library():
    draw = random.Random(7)
    some = ["a", "the ", " ", "  ", "\n", "\t x", "é", "日本", "'s", "'LL", MARK, MARK[:-1], "<|", " " + MARK, "123", "__", "\x1c", "\x85", "\U0001f600", "́"]
    texts = ["".join(draw.choices(some, k=draw.randint(0, 25))) for _ in range(4_000)] + [MARK, MARK * 3, "", " "]
    assert ids(prefix_bpe.TextEncoder(VOCABULARY, public_tokenizers.PATTERN, False)(texts)) == library_ids(texts)
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert ids(prefix_bpe.TextEncoder(VOCABULARY, public_tokenizers.PATTERN, True)(texts)) == want


def test_whole_long_word_and_text():
    texts = ["ab" * 200_000, "word " * 100_000, "\n" * 50_000]
    assert ids(prefix_bpe.TextEncoder(VOCABULARY, public_tokenizers.PATTERN, False)(texts)) == library_ids(texts)


def test_small_memories_change_nothing(monkeypatch):
    monkeypatch.setattr(chunks, "REMEMBERED", 6)
    monkeypatch.setattr(chunks.WordIds, "REMEMBERED", 8)
    monkeypatch.setattr(chunks, "BLOCK_CHARS", 40)
    monkeypatch.setattr(prefix_bpe, "REMEMBERED_PAIRS", 3)
    draw = random.Random(2)
    texts = [" ".join(draw.choices(["some", "words", "", "that", "come", "back,", "x", "unlikely", " "], k=9)) for _ in range(200)]
    assert ids(prefix_bpe.TextEncoder(VOCABULARY, public_tokenizers.PATTERN, False)(texts)) == library_ids(texts)


def test_odd_documents_round_trip(spark):
    docs = odd_documents(spark).withColumn("decoded", F.lit(1))
    coded = prefix_bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    found = prefix_bpe.decode(coded, PATH).select("doc_id", "text", "ids", "decoded", "key").collect()
    assert len(found) == docs.count()
    for row, want in zip(found, library_ids([r["text"] or "" for r in found]), strict=True):
        assert row["ids"] == want
        assert row["decoded"] == (row["text"] or "") == LIBRARY.decode(want, skip_special_tokens=False)


def test_odd_ids(spark):
    data = [(1, None), (2, []), (3, [50256, 0, 70_000, -1]), (4, [188, 1, 233])]
    found = prefix_bpe.decode(spark.createDataFrame(data, "doc_id long, ids array<int>"), PATH)
    want = [(1, None), *((i, LIBRARY.decode([t for t in some if 0 <= t < 50257], skip_special_tokens=False)) for i, some in data[1:])]
    assert rows(found.select("doc_id", "decoded")) == want
    assert prefix_bpe.decode(spark.createDataFrame([], "ids array<int>"), PATH).count() == 0
    assert prefix_bpe.encode(spark.createDataFrame([], "text string"), PATH, public_tokenizers.PATTERN).count() == 0


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError):
        prefix_bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    with open(PATH, encoding="utf-8") as f:
        file = json.load(f)
    file["model"]["ignore_merges"] = True
    (tmp_path / "t.json").write_text(json.dumps(file))
    with pytest.raises(ValueError):
        prefix_bpe.read_vocabulary(str(tmp_path / "t.json"))


def test_query_as_the_library(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in queries.table(spark, sf_dir, "documents").collect()}
    want = {d: i for d, i in zip(texts, library_ids(list(texts.values())), strict=True)}
    for row in queries.QUERIES["op12_prefix_bpe"](spark, sf_dir).collect():
        assert row["n_tokens"] == len(want[row["doc_id"]])
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, want[row["doc_id"]])).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_chunks_are_cut_where_matches_start():
    draw, find = random.Random(3), regex.compile(public_tokenizers.PATTERN).findall
    for _ in range(2_000):
        text = "".join(draw.choices([" ", "  ", "a", "\n", "'s", "1", " ", ".", "\x1c"], k=draw.randint(0, 12)))
        assert [m for c in chunks.chunks(text) for m in find(c)] == find(text)


def test_letters_of_the_pattern_are_those_of_the_language():
    """Chunks of letters are taken for one word without asking the pattern."""
    letter = regex.compile(r"\p{L}").fullmatch
    assert all(letter(chr(c)) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha())
    asked = []
    words = chunks.WordIds(public_tokenizers.PATTERN, lambda new: asked.extend(new) or new)
    assert words.letters and not chunks.WordIds(r"\w| ?\p{L}+|\s+", lambda w: w).letters
    assert words([" abc", "'s", " a1", "abc", ""]) == [b" abc", b"'s", b" a1", b"abc", b""]
    assert sorted(asked) == [b" a", b" abc", b"'s", b"1", b"abc"]
