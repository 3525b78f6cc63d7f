"""Importance resampling against a plain version, and its radix sort against a sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tests.llm.conftest import odd_documents
from trueledger.llm import resampling

TARGET = [("one two THREE four", 1), ("é日本語 x", 2), (None, 3), ("", 4)]


def plain(docs, target, runs, percent, least):
    """(id, n_features, weight, score, rank) of each row by the definition; ranks of equal rows are interchangeable."""

    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in range(1, runs + 1) for i in range(len(words) - n + 1)]

    made = [(id, *features(text)) for id, text in docs]
    s, t = Counter(c for _, _, f in made for c in f), Counter(c for text, _ in target for c in features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for id, words, found in made:
        weight = sum(math.floor(1000 * math.log((t[c] + 1.0) * (s_all + 10_000) / ((s[c] + 1.0) * (t_all + 10_000)))) for c in found)
        h = int(hashlib.sha256(f"2024:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
        out.append((id, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = may[: percent * len(may) // 100]
    ranks = [(*r[:1], *r[2:], i) for i, r in enumerate(drawn, 1)]
    left = Counter(out) - Counter(drawn)
    return sorted(ranks + [(*r[:1], *r[2:], None) for r in left.elements()], key=repr)


@pytest.mark.parametrize(("runs", "percent", "least"), [(1, 50, 1), (2, 100, 0), (3, 10, 0), (1, 0, 0)])
def test_odd_documents_as_defined(spark, runs, percent, least):
    docs, target = odd_documents(spark), spark.createDataFrame(TARGET, "text string, item_id long")
    found = resampling.draw(resampling.scored(docs, target, runs=runs), percent, eligible=F.col("n_words") >= least)
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], TARGET, runs, percent, least)
    assert rows(found.select("doc_id", "n_features", "weight", "score", "rank")) == want


def test_columns_that_clash(spark):
    docs = odd_documents(spark).withColumns({n: F.lit("x") for n in ("rank", "score", "weight", "_may", "_at", "_text", "_digit", "_block", "Local", "n_words")})
    found = resampling.draw(resampling.scored(docs, docs), 50)
    assert found.count() == docs.count()
    assert {f.name: f.dataType.simpleString() for f in found.schema.fields}["_may"] == "string"
    assert found.where("_at = 'x' AND _text = 'x' AND local = 'x' AND key <=> key AND ids = 'clash'").count() == docs.count()


def test_pieces_of_a_text_give_what_the_text_gives(monkeypatch):
    text = "Über  words, AND more-words 123 x" * 50
    whole = [c for _, found in resampling.feature_cells(text, 3, 97) for c in found.tolist()]
    n = sum(words for words, _ in resampling.feature_cells(text, 3, 97))
    monkeypatch.setattr(resampling, "PIECE", 7)
    pieces = list(resampling.feature_cells(text, 3, 97))
    assert len(pieces) > 20 and sum(words for words, _ in pieces) == n
    assert sorted(c for _, found in pieces for c in found.tolist()) == sorted(whole)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.draw(resampling.scored(none, none), 10).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert rows(resampling.draw(resampling.scored(one, none), 100).select("rank")) == [(1,)]


@pytest.mark.parametrize("ids", [(0, 40), (-(1 << 63), (1 << 63) - 1), (-5_000_000, 5_000_000)])
def test_radix_sort_sorts(spark, monkeypatch, ids):
    """Blocks of sixteen places, so that every pass moves rows between blocks; ties, null ids and a hot score."""
    monkeypatch.setattr(resampling, "BLOCK_BITS", 4)
    draw = random.Random(1)
    data = [(None if draw.random() < 0.05 else draw.randint(*ids), 7 if draw.random() < 0.4 else draw.randint(-9_000, 9_000)) for _ in range(700)] + [(ids[0], 1), (ids[1], 1)]
    found = resampling.draw(spark.createDataFrame(data, "doc_id long, score long").repartition(5), 60).collect()
    order = sorted(data, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    n = 60 * len(data) // 100
    assert [(r["doc_id"], r["score"]) for r in sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])] == order[:n]
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, n + 1)) and len(found) == len(data)
